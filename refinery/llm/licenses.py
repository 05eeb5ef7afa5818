"""License scan: phrases, and an exact set-similarity join of license passages with blocks of text.

A passage and a block are sets of words. Their words are put in one global order, the rarest
first, by the number of documents they occur in. If a block holds at least ``need`` of a passage's
n words, then one of the first ``n - need + 1`` of the passage's words is in the block (prefix
filter), the block has at least ``need`` words of passages at all (length filter), and behind the
first shared word enough words are left on both sides (positional filter). What passes is counted.
Short passages are then looked for word by word, and passages that two licenses share by the words in which they differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import per_text
from refinery.llm.templates import LICENSES

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
CONTAINMENT = 0.8
PASSAGE_WORDS = 32

# A-Z in lower case; all other ASCII but digits and letters separates words. Bytes from 0x80 on
# belong to words, so the words of the UTF-8 bytes are those of the text.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Passage:
    label: str
    words: frozenset[bytes]
    sequence: tuple[bytes, ...] = ()


def passages(licenses: Mapping[str, Sequence[str]], most: int = PASSAGE_WORDS) -> list[Passage]:
    """Each license's texts in passages of at most ``most`` words, which fit into half a block."""
    found = []
    for label, texts in licenses.items():
        for text in texts:
            words = words_of(text)
            parts = ceil(len(words) / most)
            for k in range(parts):
                part = words[k * len(words) // parts : (k + 1) * len(words) // parts]
                found.append(Passage(label, frozenset(part), tuple(part)))
    return found


# Passages with fewer words are common turns of phrase as sets, so they are taken as they stand.
IN_ORDER_BELOW = 12
# Of the words that tell a passage from another license's texts, the share that a block must hold.
TELLING = 0.6


class PassageIndex:
    """Passages with their words as ranks in the global order, and an index of their prefixes.

    Passages of fewer than ``in_order_below`` words have to be in a block word by word. With ``telling``, a block must
    also hold that share of the words in which a passage differs from the texts of any other license that
    would reach the threshold by what both have in common; a passage that differs in no word tells nothing.
    """

    def __init__(
        self,
        found: Sequence[Passage],
        frequency: Mapping[bytes, int],
        containment: float,
        *,
        in_order_below: int = 0,
        telling: float = 0.0,
    ):
        vocabulary = {word for p in found for word in p.words}
        order = sorted(vocabulary, key=lambda word: (frequency.get(word, 0), word))
        self.rank = {word: n for n, word in enumerate(order)}
        self.labels = [p.label for p in found]
        self.ranks = [sorted(self.rank[word] for word in p.words) for p in found]
        self.phrases = [b" " + b" ".join(p.sequence) + b" " if len(p.sequence) < in_order_below else None for p in found]
        self.need = [
            len(p.words) if phrase else max(1, ceil(containment * len(p.words) - 1e-9))
            for p, phrase in zip(found, self.phrases, strict=True)
        ]
        said: dict[str, set[bytes]] = {}
        for p in found:
            said.setdefault(p.label, set()).update(p.words)
        self.telling: list[list[tuple[int, set[int]]]] = [
            [
                (max(1, ceil(telling * len(p.words - other) - 1e-9)), {self.rank[word] for word in p.words - other})
                for label, other in said.items()
                if telling and label != p.label and len(p.words & other) >= need
            ]
            for p, need in zip(found, self.need, strict=True)
        ]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for k, ranks in enumerate(self.ranks):
            for i, rank in enumerate(ranks[: len(ranks) - self.need[k] + 1]):
                self.prefixes.setdefault(rank, []).append((k, i))
        self.first_words = {order[rank] for rank in self.prefixes}

    def match(self, block: list[int]) -> dict[int, float]:
        """Containment by passage, of those met by a block given as its sorted ranks."""
        met: dict[int, float] = {}
        tried = set()
        inside = set(block)
        for j, rank in enumerate(block):
            for k, i in self.prefixes.get(rank, ()):
                need, ranks = self.need[k], self.ranks[k]
                if k in tried:
                    continue
                # Of the shared words this is the first in order, so no more than these can follow.
                tried.add(k)
                if len(block) < need or 1 + min(len(ranks) - i - 1, len(block) - j - 1) < need:
                    continue
                shared = sum(r in inside for r in ranks)
                if shared >= need and all(len(own & inside) >= least for least, own in self.telling[k]):
                    met[k] = shared / len(ranks)
        return met


class Hit(NamedTuple):
    """A phrase, or with its number a passage: first word of the text, whether it is a phrase, share of its words."""

    label: str
    word: int
    base: bool
    containment: float
    passage: int | None = None


def license_hits(
    text: str, index: PassageIndex, phrases: Mapping[str, str] = PHRASES, half: int = PASSAGE_WORDS
) -> tuple[int, list[Hit]]:
    """The number of words, and each phrase and passage met.

    A passage has one hit for each run of adjacent blocks that meet it: the first of those with the
    highest containment.
    """
    words = words_of(text)
    hits: list[Hit] = []
    line = b" " + b" ".join(words) + b" "
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            hits.append(Hit(label, line.count(b" ", 0, at), True, 1.0))
            at = line.find(wanted, at + 1)
    if not index.first_words.isdisjoint(words):
        # Blocks are windows of two halves; a passage of up to one half is whole in one of them.
        places = [n for n, word in enumerate(words) if word in index.rank]
        by_half: dict[int, set[int]] = {}
        for n in places:
            by_half.setdefault(n // half, set()).add(index.rank[words[n]])
        runs: dict[int, list[list]] = {}  # by passage: last block, highest containment, its first block
        for h in sorted(by_half.keys() | {h - 1 for h in by_half}):
            block = sorted(by_half.get(h, set()) | by_half.get(h + 1, set()))
            for k, share in index.match(block).items():
                if (phrase := index.phrases[k]) and phrase not in b" %b " % b" ".join(words[max(0, h) * half : (h + 2) * half]):
                    continue
                of = runs.setdefault(k, [])
                if not of or of[-1][0] < h - 1:
                    of.append([h, share, h])
                else:
                    of[-1][0] = h
                    if share > of[-1][1]:
                        of[-1][1:] = share, h
        met = [Hit(index.labels[k], max(0, h) * half, False, share, k) for k, of in runs.items() for _, share, h in of]
        hits += sorted(met, key=lambda hit: (hit.word, hit.passage))
    return len(words), hits


def find_licenses(
    text: str, index: PassageIndex, phrases: Mapping[str, str] = PHRASES, half: int = PASSAGE_WORDS
) -> tuple[int, list[tuple[str, int, bool, float]]]:
    """:func:`license_hits` without the numbers of passages."""
    n_words, hits = license_hits(text, index, phrases, half)
    return n_words, [hit[:4] for hit in hits]


FOUND = "struct<n_words:long,hits:array<struct<label:string,word:long,base:boolean,containment:double,passage:int>>>"
FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        (
            "hits",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("word", pa.int64()),
                        ("base", pa.bool_()),
                        ("containment", pa.float64()),
                        ("passage", pa.int32()),
                    ]
                )
            ),
        ),
    ]
)


def word_frequencies(docs: DataFrame, words: frozenset[bytes], *, text: str = "text") -> dict[bytes, int]:
    """In how many documents each of ``words`` occurs, over all documents; at most one row per word comes back."""
    seen = per_text(
        lambda value: sorted(w.decode() for w in words.intersection(words_of(value))),
        "array<string>",
        pa.list_(pa.string()),
    )
    rows = docs.select(F.explode(seen(docs[text])).alias("word")).groupBy("word").count().collect()
    return {row["word"].encode(): row["count"] for row in rows}


def with_licenses(
    docs: DataFrame,
    *,
    text: str = "text",
    into: str = "licenses",
    licenses: Mapping[str, Sequence[str]] = LICENSES,
    phrases: Mapping[str, str] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``docs`` with a struct ``into``: the number of words, and the phrases and passages met.

    Every place of a phrase is a hit, and so is every run of adjacent blocks that meet a passage;
    ``passage`` is its number among :func:`passages`, NULL for phrases.

    Reads the documents twice: once for the frequencies of the passages' words, which set the
    global order, and once to match. The passages come from the caller's memory, and so does
    their index; it does not grow with the documents. Nothing but those counts is shuffled.

    NULL and empty texts have no words and no hits; very long texts are scanned whole, and an empty table stays empty. Repeated rows each get the same struct. A
    column named ``into`` is replaced, all others are kept.
    """
    found = passages(licenses)
    vocabulary = frozenset(word for p in found for word in p.words)
    frequency = word_frequencies(docs, vocabulary, text=text)
    index = PassageIndex(found, frequency, containment, in_order_below=IN_ORDER_BELOW, telling=TELLING)

    def scan(value: str) -> dict:
        n_words, hits = license_hits(value, index, phrases)
        return {"n_words": n_words, "hits": [hit._asdict() for hit in hits]}

    return docs.withColumn(into, per_text(scan, FOUND, FOUND_ARROW)(docs[text]))
