"""Toxicity: a weighted lexicon, found by Aho-Corasick in folded text, normalised by length.

Folding undoes what hides a word: capitals, letters of other scripts that look alike, invisible characters,
digits and signs that stand for letters. Entries of the lexicon are whole words or stems (``word*``);
their weights are log-odds learned from labelled texts, and words of the fixed list that are not seen there
keep a weight of their own. Hits inside an exception phrase do not count.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import keep_on_disk, per_text, slices, worker_cache
from refinery.llm.private import ALIKE
from refinery.llm.quality import held_out

# Words that insult, in English, German, French and Spanish; a star stands for any ending.
INSULTS = (
    "idiot* moron* stupid* imbecile* dumbass* loser losers pathetic worthless disgusting scum* trash clown clowns "
    "jerk jerks bastard* dimwit* halfwit* scumbag* lowlife* degenerate* vermin filth "
    "blödmann* dummkopf* trottel* vollidiot* depp deppen abschaum widerlich* erbärmlich* wertlos* versager* "
    "imbécile* crétin* abruti* débile* ordure* minable* connard* "
    "imbécil* estúpid* idiota* cretino* basura escoria patétic* asqueros* inútil"
).split()
# Phrases in which such a word means no harm.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bins", "trash bag", "trash bags", "trash collection", "trash day",
    "take out the trash", "class clown", "clown fish", "circus clown", "circus clowns", "rodeo clown", "pond scum",
    "soap scum", "jerk chicken", "jerk pork", "sore loser", "idiot proof", "idiot light", "cubo de basura", "camión de la basura",
    "bolsa de basura", "ordures ménagères", "bac à ordures",
)
# Digits and signs that stand for letters; a second reading where there are two.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
SECOND = {"1": "l", "!": "l", "|": "l"}

HITS = "array<struct<term:string,weight:double,start:int,end:int>>"
_HITS = pa.list_(pa.struct([("term", pa.string()), ("weight", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
FOUND = f"struct<score:double,n_words:int,hits:{HITS}>"
_FOUND = pa.struct([("score", pa.float64()), ("n_words", pa.int32()), ("hits", _HITS)])

_hidden = frozenset(c for c, plain in ALIKE.items() if not plain) | frozenset(map(chr, range(0x300, 0x370)))
_odd = {c: plain.lower() for c, plain in ALIKE.items() if plain} | {c.lower(): plain.lower() for c, plain in ALIKE.items() if plain}
# Marks beyond ASCII part words as those of ASCII do.
_odd |= {chr(o): " " for a, b in ((0xA0, 0xBF), (0x2000, 0x206F), (0x3000, 0x3020)) for o in range(a, b + 1) if chr(o) not in _odd}
for _letter in "ªµº":
    _odd.pop(_letter, None)
_strange = frozenset(_odd)
_plain = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_signs = re.compile(b"[" + re.escape("".join(SUBSTITUTES)).encode() + b"]+")
_first = bytes.maketrans("".join(SUBSTITUTES).encode(), "".join(SUBSTITUTES.values()).encode())
_second = bytes.maketrans("".join(SUBSTITUTES).encode(), "".join((SUBSTITUTES | SECOND).values()).encode())


def _in_word(data: bytes, at: int) -> bool:
    return 0 <= at < len(data) and (data[at] >= 0x80 or data[at] | 0x20 in range(0x61, 0x7B))


@dataclass
class Folded:
    """Readings of a text in small letters parted by spaces, as bytes, and the way back to its characters."""

    readings: list[bytes]
    kept: np.ndarray | None  # the characters that were not dropped, if any were

    def char(self, at: int) -> int:
        """The source character that the byte ``at`` of a reading belongs to."""
        data = np.frombuffer(self.readings[0][: at + 1], np.uint8)
        position = int(np.count_nonzero((data & 0xC0) != 0x80)) - 1
        return position if self.kept is None else int(self.kept[min(position, len(self.kept) - 1)])


def fold(text: str) -> Folded:
    kept = None
    if not text.isascii():
        # Most texts hold few different characters and none to fold, so these are looked up once each.
        if dropped := _hidden.intersection(text):
            kept = np.array([k for k, c in enumerate(text) if c not in dropped] + [len(text)])
            text = "".join(c for c in text if c not in dropped)
        lower = text.lower()
        text = lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for c in _strange.intersection(text):
            text = text.replace(c, _odd[c])
    data = text.encode()
    spans = [m.span() for m in _signs.finditer(data)]
    # A sign stands for a letter inside a word, or as a digit at the word's start or end, up to three together.
    worn = []
    for start, end in spans:
        before, after = _in_word(data, start - 1), _in_word(data, end)
        if end - start <= 3 and (before and after or (before or after) and data[start:end].isdigit()):
            worn.append((start, end))
    if not worn:
        return Folded([data.translate(_plain)], kept)
    readings = [bytearray(data)]
    if any(bytes([b]).decode() in SECOND for start, end in worn for b in data[start:end]):
        readings.append(bytearray(data))
    for reading, table in zip(readings, (_first, _second), strict=False):
        for start, end in worn:
            reading[start:end] = data[start:end].translate(table)
    return Folded([bytes(reading).translate(_plain) for reading in readings], kept)


@dataclass(frozen=True)
class Settings:
    """What is learned, and from how much.

    ``sample``: labelled rows that are read at most; their texts stay in Spark. ``terms``: how many terms
    come to the driver at most, and ``stem`` the lengths of stems. A learned term is in ``support`` toxic
    texts at least, and its log-odds are ``least`` or more; ``prior`` weakens what few texts say.
    """

    sample: int = 20_000
    terms: int = 20_000
    stem: tuple[int, int] = (3, 12)
    support: int = 3
    least: float = 1.5
    prior: float = 2.0
    unseen: float = 2.5


@dataclass(frozen=True)
class Term:
    """``word`` or ``stem*``, folded, with its weight and the toxic and clean labelled texts it was found in."""

    text: str
    weight: float
    toxic: int = 0
    clean: int = 0


@dataclass(frozen=True)
class Model:
    """The lexicon, and the logistic curve from what is found to a probability."""

    terms: tuple[Term, ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    toxic_texts: int = 0
    clean_texts: int = 0
    curve: tuple[float, ...] = (-4.0, 0.5, 1.5)
    settings: Settings = field(default_factory=Settings)

    @cached_property
    def key(self) -> str:
        """What tells models apart, short enough to compare for each text."""
        return hashlib.sha256(repr((self.terms, self.exceptions)).encode()).hexdigest()

    def matcher(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        entries = [(term.text, n) for n, term in enumerate(self.terms)] + [(phrase, -1) for phrase in self.exceptions]
        for text, number in entries:
            key = _key(text)
            found.add_word(key, (number, len(key)))
        found.make_automaton()
        return found


def _key(entry: str) -> str:
    """An entry as it stands in a folded text: a space before, and one behind unless it is a stem."""
    stem = entry.endswith("*")
    return f" {fold(entry.rstrip('*')).readings[0].decode()}{'' if stem else ' '}".encode().decode("latin-1")


Hit = tuple[int, int, int]


def hits_of(folded: Folded, matcher: ahocorasick.Automaton) -> list[Hit]:
    """(start, end, term number) in bytes of a reading; of the entries that begin at one word the longest counts.

    A stem's hit goes on to the end of the word.
    """
    best: dict[int, tuple[int, int, int]] = {}
    phrases = []
    for reading in folded.readings:
        for last, (number, length) in matcher.iter(f" {reading.decode('latin-1')} "):
            # One space stands before the text, and the entry begins with one: they make up for each other.
            start = last - length + 1
            if last > len(reading) or reading[last - 1] == 0x20:
                end = last - 1
            else:
                end = reading.find(b" ", last)
                end = len(reading) if end < 0 else end
            if number < 0:
                phrases.append((start, end))
            elif best.get(start, (0, 0, 0))[0] < length:
                best[start] = (length, end, number)
    return [
        (start, best[start][1], best[start][2]) for start in sorted(best) if not any(a <= start < b for a, b in phrases)
    ]


def _measures(weights: Iterable[float], words: int) -> tuple[float, float]:
    """What the curve takes: all weight found, and the weight found per hundred words."""
    total = sum(weights)
    return math.log1p(total), math.log1p(100 * total / (words + 10))


def _probability(curve: tuple[float, ...], measures: tuple[float, ...]) -> float:
    margin = curve[0] + sum(a * b for a, b in zip(curve[1:], measures, strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))


def find(text: str, model: Model, matcher: ahocorasick.Automaton) -> dict:
    """{score, n_words, hits}; hits in characters of the source, end exclusive."""
    folded = fold(text)
    words = len(folded.readings[0].split())
    found = hits_of(folded, matcher)
    hits = [
        {"term": model.terms[n].text, "weight": model.terms[n].weight, "start": folded.char(a), "end": folded.char(b - 1) + 1}
        for a, b, n in found
    ]
    return {"score": _probability(model.curve, _measures((h["weight"] for h in hits), words)), "n_words": words, "hits": hits}


def toxicity(text: Column, model: Model) -> Column:
    """FOUND for each text. NULL counts as empty."""

    key = ("toxicity", model.key)

    def run(content: str) -> dict:
        return find(content, model, worker_cache(key, model.matcher))

    return per_text(run, FOUND, _FOUND)(text)


def with_toxicity(docs: DataFrame, model: Model, *, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with score (0 to 1), number of words and hits of each whole text as column ``into``.

    The column replaces one of that name; others stay. NULL and empty texts get the score of a text
    without any hit. Texts of any length are read whole, and repeated rows get equal results. Nothing is shuffled; an empty
    table stays empty. Of two entries that begin at one word the longer counts, and the lexicon's order settles nothing else.
    """
    return docs.withColumn(into, toxicity(docs[text], model))


# Learning


def term_texts(folded: Folded, stem: tuple[int, int]) -> set[str]:
    """Whole words and stems of a text."""
    out: set[str] = set()
    for word in {w.decode() for reading in folded.readings for w in reading.split()}:
        out.add(word)
        out.update(f"{word[:k]}*" for k in range(stem[0], min(len(word), stem[1] + 1)))
    return out


def log_odds(toxic: float, clean: float, share: float, prior: float) -> float:
    return math.log((toxic + prior * share) / (clean + prior * (1 - share))) - math.log(share / (1 - share))


def chosen_terms(counts: Mapping[str, tuple[int, int]], toxic: int, clean: int, settings: Settings) -> tuple[Term, ...]:
    """The terms to keep of those counted (toxic and clean texts of each), and the fixed list's.

    The longest entry counts where several begin a word, so a stem stands for what its most frequent longer
    entry leaves of it. An entry gives way to a shorter one that tells as much.
    """
    share = (toxic + 0.5) / (toxic + clean + 1)

    def stems(term: str) -> list[str]:
        body = term.rstrip("*")
        return [f"{body[:k]}*" for k in range(1, len(body) + (not term.endswith("*")))]

    def weight(counted: tuple[int, int]) -> float:
        return log_odds(*counted, share, settings.prior) if counted[0] >= settings.support else 0.0

    telling = {term: counted for term, counted in counts.items() if weight(counted) >= settings.least}
    longer: dict[str, tuple[int, int]] = {}
    for term, counted in sorted(telling.items()):
        for stem in stems(term):
            longer[stem] = max(longer.get(stem, (0, 0)), counted)
    kept: dict[str, Term] = {}
    for term in sorted(telling, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        less = longer.get(term, (0, 0))
        left = (telling[term][0] - less[0], max(0, telling[term][1] - less[1]))
        own = weight(left)
        if own >= settings.least and not any(kept[s].weight >= own - 0.1 for s in stems(term) if s in kept):
            kept[term] = Term(term, own, *left)
    for word in INSULTS:
        known = counts.get(word, (0, 0))
        own = log_odds(*known, share, settings.prior) if sum(known) >= settings.support else settings.unseen
        if word not in kept and own > 0:
            kept[word] = Term(word, own, *known)
    return tuple(kept.values())


def without_own(term: Term, model: Model, label: int) -> float:
    """The weight that the term has without one text of this label, so that no text speaks for itself; 0 if it has none."""
    toxic, clean = term.toxic - label, term.clean - (1 - label)
    if term.toxic + term.clean == 0:
        return term.weight
    if toxic < model.settings.support:
        return 0.0
    share = (model.toxic_texts - label + 0.5) / (model.toxic_texts + model.clean_texts)
    return max(0.0, log_odds(toxic, max(0, clean), share, model.settings.prior))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method, slightly damped; slopes are never below zero."""
    design = np.column_stack([np.ones(len(x)), x])
    active = list(range(design.shape[1]))
    while True:
        part, curve = design[:, active], np.zeros(len(active))
        damp = np.diag([1e-6, *[ridge] * (len(active) - 1)])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(part @ curve, -30, 30)))
            step = np.linalg.solve(part.T @ (part * (p * (1 - p))[:, None]) + damp, part.T @ (y - p) - damp @ curve)
            curve += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        low = [k for k, value in zip(active, curve, strict=True) if k and value < 0]
        if not low:
            out = np.zeros(design.shape[1])
            out[active] = curve
            return tuple(out.tolist())
        active = [k for k in active if k not in low]


def likeness(text: str) -> int:
    """The least hash of its runs of three words; near copies mostly share it."""
    words = fold(text).readings[0].split()
    runs = zip(words, words[1:], words[2:], strict=False)
    return min((zlib.crc32(b" ".join(run)) for run in runs), default=zlib.crc32(b" ".join(words)))


def _counted(sample: DataFrame, settings: Settings) -> DataFrame:
    """(term, toxic, clean) over the texts of the sample, added up in map tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            terms = [*dict.fromkeys([*counts[1], *counts[0]])]
            for at in range(0, len(terms), 1 << 15):
                part = terms[at : at + (1 << 15)]
                yield pa.RecordBatch.from_pydict(
                    {"term": part, "toxic": [counts[1][t] for t in part], "clean": [counts[0][t] for t in part]}
                )
            for counter in counts:
                counter.clear()

        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 20)):
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                counts[label].update(term_texts(fold(text or ""), settings.stem))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield from flush()
        yield from flush()

    counted = sample.select("text", "label").mapInArrow(count, "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Learns lexicon and curve from labelled rows that are not held out, ``settings.sample`` of them at most.

    Which rows, if there are more, is settled by a hash of their ids. Of near copies with one label one counts. Terms are
    counted in Spark; ``settings.terms`` of them at most and two numbers per row of the sample come to the
    driver. Rows with a NULL id or label are not used; NULL texts are empty. Without labelled texts of both kinds
    the fixed list and a fixed curve are the model.
    """
    known = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("label"))
    chosen = (
        known.where(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(settings.sample)
    )
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    alike = per_text(likeness, "bigint", pa.int64())(F.col("text"))
    marked = keep_on_disk(texts.join(F.broadcast(chosen), "_id").withColumn("alike", alike), "toxic-sample")
    first = Window.partitionBy("alike", "label").orderBy("_id", F.xxhash64("text"))
    ranked = marked.withColumn("number", F.row_number().over(first)).where("number = 1").select("_id", "text", "label")
    sample = keep_on_disk(ranked.orderBy(F.xxhash64("_id"), "_id").limit(settings.sample), "toxic-leaders")
    # A limit leaves one part; learning from it takes longer than to deal it out again.
    sample = sample.repartition(32, "_id")
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not (toxic and clean):
        return Model(chosen_terms({}, 0, 0, settings), settings=settings)

    counted = _counted(sample, settings)
    ratio = F.col("toxic") / (F.col("clean") + 1)
    listed = F.col("term").isin(INSULTS)
    telling = counted.where(((F.col("toxic") >= settings.support) & (ratio * clean / toxic >= math.exp(settings.least) / 4)) | listed)
    best = telling.orderBy(listed.desc(), (ratio * F.sqrt("toxic")).desc(), "term").limit(settings.terms).collect()
    terms = chosen_terms({row["term"]: (row["toxic"], row["clean"]) for row in best}, toxic, clean, settings)
    model = Model(terms, toxic_texts=toxic, clean_texts=clean, settings=settings)
    return _with_curve(model, sample)


def _with_curve(model: Model, sample: DataFrame) -> Model:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                folded = fold(text)
                weights = [without_own(model.terms[n], model, label) for _, _, n in hits_of(folded, matcher)]
                rows.append(_measures(weights, len(folded.readings[0].split())))
            yield pa.RecordBatch.from_pydict({"x": [list(row) for row in rows], "label": batch["label"].to_pylist()})

    # A sum over rows depends on their order in its last digits, so they are put in order.
    rows = sample.select("text", "label").mapInArrow(measure, "x array<double>, label bigint").collect()
    rows.sort(key=lambda row: (row["label"], row["x"]))
    x, y = np.array([row["x"] for row in rows]), np.array([row["label"] for row in rows], dtype=float)
    return Model(
        model.terms, model.exceptions, model.toxic_texts, model.clean_texts, fit_curve(x, y), model.settings
    )
