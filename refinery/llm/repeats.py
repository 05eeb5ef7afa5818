"""Substring dedup: paragraphs that repeat, alike or nearly so, found by MinHash banding, and passages word for word.

The paragraphs of a document are its lines with enough words, and its runs of shorter lines. Paragraphs whose MinHash agrees in all
rows of a band collide, colliding ones are compared exactly, and the components of those that are
alike are the groups of which one paragraph stays.

Variants of one paragraph may collide in thousands without being alike enough. So a band's paragraphs
are compared with one of them only, and those that this leaves in different components are joined by
the rarest shingles of their sets, which variants do not share.

What repeats inside or across paragraphs is found by windows of words over the whole text, whatever
its lines are. The smallest hash of half a window names it (winnowing): a window that repeats has a
name that repeats, so only windows with such a name leave their task and are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import empty, free_name, keep_on_disk, slices
from refinery.llm.hashing import (
    BY_PUNCTUATION,
    Words,
    as_long,
    filter_bits,
    hash_filter,
    in_filter,
    mix,
    run_hashes,
    text_batches,
    words_of,
)
from refinery.llm.jaccard import Settings as JaccardSettings
from refinery.llm.jaccard import KEYS, jaccard_links
from refinery.llm.linking import ROUNDS, connected_components, link_to_leaders, shared_only, still_open


@dataclass(frozen=True)
class Settings:
    """Paragraphs of ``least_words`` or more are compared by shingles of ``n`` words, at ``percent`` Jaccard.
    Passages of ``passage_words`` (an even number) or more repeat word for word.

    ``recall`` is the share of pairs at the threshold that must collide, ``stray`` the share of
    pairs at a similarity of 0.3 that may.
    """

    n: int = 5
    percent: int = 80
    least_words: int = 20
    recall: float = 0.995
    stray: float = 0.2
    passage_words: int = 50


@lru_cache
def tune_bands(threshold: float, recall: float, stray: float) -> tuple[int, int]:
    """Bands and rows with the fewest hash functions that reach the recall and keep strays low."""
    found = []
    for rows in range(1, 17):
        bands = ceil(log(1 - recall) / log(1 - threshold**rows))
        if 1 - (1 - 0.3**rows) ** bands <= stray:
            found.append((bands * rows, bands, rows))
    return min(found)[1:] if found else (bands, rows)


@dataclass
class Paragraphs:
    """The paragraphs of a batch of texts, with the hashes of their shingles end to end."""

    row: list[int]
    number: list[int]
    start: list[int]
    texts: list[str]
    keys: np.ndarray
    shingles: np.ndarray
    bounds: np.ndarray


def paragraphs(texts: list[str | None], settings: Settings) -> Paragraphs:
    """Lines with enough words; shorter lines in a row, up to one without words, are a paragraph together."""
    row, number, start, lines = [], [], [], []
    for k, text in enumerate(texts):
        at = 0
        for j, line in enumerate((text or "").split("\n")):
            row.append(k)
            number.append(j)
            start.append(at)
            lines.append(line)
            at += len(line) + 1
    w = words_of(lines, BY_PUNCTUATION)
    least = max(settings.least_words, settings.n)
    counts = np.diff(w.first)
    short = (counts > 0) & (counts < least)
    joins = np.zeros(len(lines), dtype=bool)
    joins[1:] = short[1:] & short[:-1] & (np.diff(np.array(row, dtype=np.int64)) == 0)
    heads = np.flatnonzero(~joins)
    tails = np.append(heads[1:], len(lines)) - 1 if len(heads) else heads
    counts = w.first[tails + 1] - w.first[heads]
    keep = np.flatnonzero(counts >= least)
    heads, tails = heads[keep], tails[keep]
    runs = run_hashes(w.hashes, settings.n)
    size = counts[keep] - settings.n + 1
    bounds = np.append(0, np.cumsum(size))
    shingles = runs[np.repeat(w.first[heads] - bounds[:-1], size) + np.arange(bounds[-1])]
    # The order of the words counts for the key, so that only equal paragraphs share it.
    place = mix(np.arange(bounds[-1], dtype=np.uint64) - np.repeat(bounds[:-1], size).astype(np.uint64))
    keys = np.add.reduceat(mix(shingles ^ place), bounds[:-1]) if len(keep) else shingles[:0]
    pick = heads.tolist()
    held = ["\n".join(lines[a : b + 1]) for a, b in zip(pick, tails.tolist(), strict=True)]
    return Paragraphs(
        [row[k] for k in pick], [number[k] for k in pick], [start[k] for k in pick], held,
        mix(keys), shingles, bounds,
    )


def bands_of(p: Paragraphs, bands: int, rows: int) -> np.ndarray:
    """A hash per band for each paragraph."""
    out = np.empty((len(p.keys), bands), dtype=np.uint64)
    for band in range(bands):
        total = np.full(len(p.keys), band + 1, dtype=np.uint64)
        for k in range(rows):
            salt = np.uint64(2 * (band * rows + k) + 1)
            turned = (p.shingles ^ (p.shingles >> np.uint64(31))) * mix(np.array([salt]))[0]
            total = mix(total + np.minimum.reduceat(turned ^ (turned >> np.uint64(29)), p.bounds[:-1]))
        out[:, band] = total
    return out


SIGNED = "doc_id long, paragraph int, start int, end int, node long, bands array<long>"
_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("paragraph", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("node", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """A row per paragraph: where it is, the hash of its words, and its bands."""
    bands, rows = tune_bands(settings.percent / 100, settings.recall, settings.stray)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"), dtype=np.int64)
            for first, texts in text_batches(batch, "text"):
                p = paragraphs(texts, settings)
                if not len(p.keys):
                    continue
                starts = np.array(p.start, dtype=np.int32)
                listed = pa.ListArray.from_arrays(
                    np.arange(len(p.keys) + 1, dtype=np.int32) * bands, as_long(bands_of(p, bands, rows).ravel())
                )
                columns = [
                    ids[first + np.array(p.row)],
                    np.array(p.number, dtype=np.int32),
                    starts,
                    starts + np.array([len(line) for line in p.texts], dtype=np.int32),
                    as_long(p.keys),
                    listed,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, _SIGNED, strict=True)], schema=_SIGNED
                )

    return docs.where("doc_id IS NOT NULL").mapInArrow(sign, SIGNED)


def paragraph_texts(docs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """(node, text) of the paragraphs whose hash is among the nodes, and of few others."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(nodes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_batches(batch, "text"):
                p = paragraphs(texts, settings)
                wanted = in_filter(sent.value, p.keys)
                once = dict(zip(as_long(p.keys[wanted]).tolist(), np.flatnonzero(wanted).tolist(), strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": pa.array(once.keys(), pa.int64()),
                        "text": pa.array([p.texts[k] for k in once.values()], pa.string()),
                    }
                )

    found = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(pick, "node long, text string")
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))


def alike(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose sets of shingles reach the threshold, counted exactly."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "a_text", 1 << 20)):
            sides = []
            for name in ("a_text", "b_text"):
                p = paragraphs(batch.column(name).to_pylist(), settings)
                sides.append([np.unique(p.shingles[a:b]) for a, b in zip(p.bounds[:-1], p.bounds[1:], strict=True)])
            good = []
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= settings.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"]
            )

    sides = [texts.select(F.col("node").alias(s), F.col("text").alias(f"{s}_text")) for s in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(check, "a long, b long")


@dataclass
class Windows:
    """The words of a batch of texts and, by first word, its windows: their names and whether they lie in one text."""

    half: int
    words: Words
    starts: np.ndarray  # of the words, in code points of their text
    ends: np.ndarray
    halves: np.ndarray
    names: np.ndarray
    inside: np.ndarray

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """Of the windows at these words; a window is two halves."""
        return mix(mix(self.halves[at]) + self.halves[at + self.half])


def windows_of(texts: list[str], settings: Settings) -> Windows:
    half = settings.passage_words // 2
    w = words_of(texts, BY_PUNCTUATION)
    points = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
    offsets = np.cumsum([0, *(len(text.encode()) + 1 for text in texts)])
    before = points[offsets[w.text]]
    halves = run_hashes(w.hashes, half)
    # The least of half + 1 hashes in a row, from those of 1, 2, 4, ... in a row.
    names, reach = halves, 1
    while 2 * reach <= half + 1:
        names = np.minimum(names[:-reach], names[reach:])
        reach *= 2
    if rest := half + 1 - reach:
        names = np.minimum(names[:-rest], names[rest:])
    at = np.arange(len(names))
    inside = w.text[at] == w.text[at + 2 * half - 1]
    names = mix(names)  # the least of many have few upper parts, which the filter goes by
    return Windows(half, w, points[w.starts] - before, points[w.ends] - before, halves, names, inside)


def passage_names(texts: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, sum, name, n): the names of each text's windows and in how many places each stands. On shared disk.

    Windows that lie wholly in a span of ``gone`` have none. A name is the least hash of half a window, so it holds
    for about as many windows in a row as half a window has words.
    """
    reach, size = settings.passage_words // 2 + 1, settings.passage_words

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in text_batches(batch, "text"):
                w = windows_of([text or "" for text in some], settings)
                at = _left(w, batch["gone"].slice(first, len(some)).to_pylist(), size)
                text, names = w.words.text[at], w.names[at]
                # Windows in a row with one name are one place, unless there are more than can hold it.
                new = np.ones(len(at), dtype=bool)
                new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)
                firsts = np.flatnonzero(new)
                places = -(-np.diff(np.append(firsts, len(at))) // reach)
                order = np.lexsort((names[firsts], text[firsts]))
                text, names, places = text[firsts][order], names[firsts][order], places[order]
                heads = np.ones(len(text), dtype=bool)
                heads[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
                heads = np.flatnonzero(heads)
                counts = np.add.reduceat(places, heads) if len(heads) else places
                rows = first + text[heads]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": np.asarray(batch["doc_id"])[rows],
                        "sum": np.asarray(batch["sum"])[rows],
                        "name": as_long(names[heads]),
                        "n": counts.astype(np.int32),
                    }
                )

    kind = "doc_id long, sum long, name long, n int"
    return keep_on_disk(texts.select("doc_id", "sum", "text", "gone").mapInArrow(name, kind), "passage-names")


def _met(texts: DataFrame, found: DataFrame, keys: list[str], how: str) -> tuple[DataFrame, DataFrame]:
    """``texts`` in two parts: those surely without a row of ``found`` by its keys, left in place, and the others joined
    with it. A filter sized by ``found``, a written table, tells them apart."""
    hashed = F.xxhash64(*keys)
    table = hash_filter(found.select(hashed), filter_bits(found.count()))
    sent = texts.sparkSession.sparkContext.broadcast(table)

    def among(hashes: pa.Array) -> pa.Array:
        return pa.array(in_filter(sent.value, np.asarray(hashes, dtype=np.int64).view(np.uint64)))

    among.__annotations__ = {"hashes": pa.Array, "return": pa.Array}
    marked = texts.withColumn("maybe", F.arrow_udf(among, "boolean")(hashed))
    return marked.where("NOT maybe").drop("maybe"), marked.where("maybe").drop("maybe").join(found, keys, how)


def _left(w: Windows, spans: list[list[dict] | None], size: int) -> np.ndarray:
    """The windows that do not lie wholly in spans of their text."""
    taken = np.append(0, np.cumsum(_gone(w, spans)))
    at = np.flatnonzero(w.inside)
    return at[taken[at + size] - taken[at] < size]


def _covered(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges, whose ends count."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + 1, -1)
    return np.cumsum(steps)[:size] > 0


def _gone(w: Windows, spans: list[list[dict] | None]) -> np.ndarray:
    """Which words lie in a span of their text."""
    out = np.zeros(len(w.starts), dtype=bool)
    for k, listed in enumerate(spans):
        a, b = w.words.first[k], w.words.first[k + 1]
        for span in listed or ():
            low, high = np.searchsorted(w.starts[a:b], [span["start"], span["end"]])
            out[a + low : a + high] = True
    return out


PASSAGES = "doc_id long, paragraph int, start int, end int, keep boolean, link long, names array<long>"


def repeated_passages(texts: DataFrame, gone: DataFrame, settings: Settings) -> DataFrame:
    """A row per passage of ``settings.passage_words`` words or more that stands elsewhere too, word for word.

    ``gone`` has the spans (doc_id, start, end) that are dropped already; their words are not reported
    again. Of the windows with the same words one stays: one that touches no such span if there is,
    and the first by (doc_id, start) of these. A passage is a run of words in windows that stay, or
    of words in others only, so every window that is dropped stays whole elsewhere. Passages with a common
    name of a window are one component, which may keep several passages.

    Copies within one text that overlap by more than half are not looked for. Names are counted exactly,
    one in about a quarter of a window's words; windows are listed only where their text has a name
    that stands elsewhere too. Only texts with dropped spans, or with such a name, are shuffled.
    """
    size = settings.passage_words
    texts = texts.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("sum"))
    dropped = keep_on_disk(gone.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("gone")), "dropped")
    whole, cut_up = _met(texts, dropped, ["doc_id"], "left")
    cut_up = keep_on_disk(cut_up.select("doc_id", "text", "sum", "gone"), "texts-cut-up")
    known = whole.withColumn("gone", F.lit(None).cast(dropped.schema["gone"].dataType)).unionByName(cut_up)

    named = passage_names(known, settings)
    twice = named.groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name")
    shared = named.join(twice, "name").groupBy("doc_id", "sum").agg(F.collect_set("name").alias("shared"))
    _, held = _met(known, keep_on_disk(shared, "shared-names"), ["doc_id", "sum"], "inner")
    held = held.withColumn("row", F.monotonically_increasing_id())
    held = keep_on_disk(held.select("row", "doc_id", "text", "gone", "shared"), "texts-with-passages")
    empty(named)

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_batches(batch, "text"):
                w = windows_of([text or "" for text in part], settings)
                spans = batch["gone"].slice(first, len(part)).to_pylist()
                at = _left(w, spans, size)
                lists = batch["shared"].slice(first, len(part))
                bounds = np.searchsorted(w.words.text[at], np.arange(len(part) + 1))
                pieces = [
                    run[np.isin(w.names[run], np.asarray(lists[k].values, dtype=np.int64).view(np.uint64))]
                    for k in range(len(part))
                    if len(run := at[bounds[k] : bounds[k + 1]])
                ]
                at = np.concatenate([at[:0], *pieces])
                taken = np.append(0, np.cumsum(_gone(w, spans)))
                text = w.words.text[at]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": np.asarray(batch["row"])[first + text],
                        "doc_id": np.asarray(batch["doc_id"])[first + text],
                        "at": (at - w.words.first[text]).astype(np.int32),
                        "hash": as_long(w.hashes(at)),
                        "touched": taken[at + size] > taken[at],
                    }
                )

    shown = held.mapInArrow(show, "row long, doc_id long, at int, hash long, touched boolean")
    shown = keep_on_disk(shown, "windows")
    groups = (
        shown.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min(F.struct("touched", "doc_id", "at")).alias("first"))
        .where("n > 1")
    )
    stays = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("at") == F.col("first.at"))
    hits = shown.join(groups, "hash").groupBy("row").agg(F.collect_list(F.struct("at", stays.alias("keep"))).alias("hits"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("doc_id", "paragraph", "start", "end", "keep", "link", "names")}
            for n in range(batch.num_rows):
                text = batch["text"][n].as_py()
                w = windows_of([text], settings)
                marks = batch["hits"][n].values
                at, keep = np.asarray(marks.field("at")), marks.field("keep").to_numpy(zero_copy_only=False)
                words = len(w.starts)
                free = ~_gone(w, [batch["gone"][n].as_py()])
                stay = _covered(words, at[keep], at[keep] + size - 1)
                state = np.where(free & _covered(words, at, at + size - 1), 1 + stay, 0)
                # Words that windows cover without a break have one link.
                order = np.sort(at)
                chains = np.split(order, np.flatnonzero(np.diff(order) > size - 1) + 1)
                opens = np.array([chain[0] for chain in chains])
                linked = [np.unique(as_long(w.names[chain])) for chain in chains]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], state, [0]])))
                begins = np.unique(np.concatenate([edges, opens]))
                for a, b in zip(begins, np.append(begins[1:], words), strict=True):
                    if a < words and state[a]:
                        chain = linked[int(np.searchsorted(opens, a, side="right")) - 1]
                        out["doc_id"].append(batch["doc_id"][n].as_py())
                        out["paragraph"].append(text.count("\n", 0, int(w.starts[a])))
                        out["start"].append(int(w.starts[a]))
                        out["end"].append(int(w.ends[b - 1]))
                        out["keep"].append(bool(state[a] == 2))
                        out["link"].append(int(chain[0]))
                        out["names"].append(chain.tolist())
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    found = keep_on_disk(held.join(hits, "row").select("doc_id", "text", "gone", "hits").mapInArrow(cut, PASSAGES), "passages")
    linked = connected_components(found.select(F.col("link").alias("a"), F.explode("names").alias("b")))
    return found.join(linked, F.col("link") == F.col("node"), "left").select(
        "doc_id", "paragraph", "start", "end", F.coalesce("component", "link").alias("component_id"), "keep"
    )


def cut_spans(text: str, spans: list[dict]) -> str:
    """The text without the spans; lines that lie in one are left out, with their ends."""
    out, at = [], 0
    for line in text.split("\n"):
        end, left, done, whole = at + len(line), [], at, False
        for a, b in sorted((s["start"], s["end"]) for s in spans):
            if b <= at or a >= end:
                whole |= a < at and end < b
                continue
            whole |= a <= at and end <= b
            if a > done:
                left.append(text[done:a])
            done = max(done, min(b, end))
        if not whole:
            out.append("".join([*left, text[done:end]]))
        at = end + 1
    return "\n".join(out)


def repeated_paragraphs(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """A row per paragraph or passage that occurs elsewhere too: ``doc_id``, ``paragraph`` (the line it starts
    in), ``start``, ``end``, ``component_id`` and ``keep``.

    Of the paragraphs of a component the first by (doc_id, start) is kept. Passages follow, see
    :func:`repeated_passages`; they may lie in a paragraph that is kept, never in one that is not.

    Equal paragraphs are one node from the start, however many there are. Nodes that share a band
    meet the band's leader and are compared on their whole texts; bands whose nodes are in several
    components then go through the exact join of :mod:`jaccard`. No group gives all its pairs. MinHash may miss a pair at the threshold
    with the probability that ``settings.recall`` leaves; equal paragraphs are never missed.

    ``start`` and ``end`` are code points of the text. NULL and empty texts have no paragraphs; rows
    without id are left out. A row that occurs twice has its paragraphs twice. An empty table gives
    no rows. Other columns are left out.
    """
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = keep_on_disk(signatures(texts, settings), "paragraphs")
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    postings = shared_only(nodes.select(F.explode("bands").alias("key"), "node"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = keep_on_disk(pairs, "candidates")
        met = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        return alike(pairs, paragraph_texts(texts, met, settings), settings)

    sure = link_to_leaders(postings, verify)
    placed = still_open(postings, connected_components(sure, rounds=ROUNDS))
    unsettled = keep_on_disk(paragraph_texts(texts, placed.select("node").distinct(), settings), "unsettled")
    # One match a pair: with more, the places of a shared shingle rule out less, and variants share single ones.
    exact = JaccardSettings(n=settings.n, percent=settings.percent, by_punctuation=True, most_matches=1)
    sets, classes, more = jaccard_links(unsettled, id="node", text="text", settings=exact)
    equal = sets.select(*KEYS, F.col("node").alias("a")).join(classes.select(*KEYS, F.col("node").alias("b")), KEYS)
    linked = connected_components(sure.union(more).union(equal.select("a", "b").where("a <> b")))
    placed = signed.drop("bands").join(linked, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    placed = placed.select("doc_id", "paragraph", "start", "end", "component_id")
    groups = (
        placed.groupBy("component_id")
        .agg(F.count("*").alias("members"), F.min(F.struct("doc_id", "start")).alias("first"))
        .where("members > 1")
    )
    found = placed.join(groups, "component_id").select(
        "doc_id",
        "paragraph",
        "start",
        "end",
        "component_id",
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))).alias("keep"),
    )
    found = keep_on_disk(found, "repeated-paragraphs")
    return found.unionByName(repeated_passages(texts, found.where("NOT keep"), settings))


def without_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the paragraphs and passages that do not stay cut from the texts, all columns as they were."""
    gone = repeated_paragraphs(docs, id=id, text=text, **options).where(~F.col("keep"))
    name = free_name(docs, "_gone")
    spans = gone.groupBy(F.col("doc_id").alias(name + "id")).agg(F.collect_set(F.struct("start", "end")).alias(name))
    joined = docs.join(spans, docs[id].cast("long") == spans[name + "id"], "left")

    def batch(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
        return pa.array([cut_spans(t, s) if t and s else t for t, s in pairs], type=pa.string())

    batch.__annotations__ = {"texts": pa.Array, "spans": pa.Array, "return": pa.Array}
    cut = F.when(F.col(name).isNull(), docs[text]).otherwise(F.arrow_udf(batch, "string")(docs[text], F.col(name)))
    return joined.select(*(cut.alias(c) if c == text else docs[c] for c in docs.columns))
