"""Benchmark decontamination by templates: passages of benchmark items, with other numbers or names too.

Texts become canonical tokens: numbers, names and units are replaced by typed placeholders, and what
stood there is kept as the value of a slot. Windows of canonical tokens are joined by hash with
those of the benchmark, and for windows in the same alignment the slots must be consistent: one
value of the item always stands for one value of the document, and the other way round. Windows that hold a
value of which this is not true do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import keep_on_disk
from refinery.llm.hashing import BY_PUNCTUATION, as_long, hash_filter, in_filter, mix, run_hashes, text_batches, words_of
from refinery.llm.rows import without_ids

# Units behind a number, and numbers in words.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre metres kilometer kilometers "
    "mg g kg gram grams kilogram kilograms lb lbs oz pound pounds ounce ounces ton tons ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent usd eur gbp dollar dollars euro euros cent cents mph kmh kph hz khz mhz ghz w kw mw v a j kj cal kcal pa"
)
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)
LITERAL, NUMBER, NAME, UNIT = range(4)
_MARKS = mix(np.arange(1, 5, dtype=np.uint64))
_SENTENCE_END = np.isin(np.arange(256), list(b".!?:;\n\"|"))


def _known(words: str) -> np.ndarray:
    return np.sort(words_of([words]).hashes)


_units, _numbers = _known(UNITS), _known(NUMBERS)


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


PLAIN, OPENERS, WORDS = range(3)  # the readings
_SALTS = mix(np.arange(3, dtype=np.uint64)) * np.array([0, 1, 1], dtype=np.uint64)
_CAPITALS = np.array([0x80 <= c < 0x10000 and chr(c).isupper() for c in range(0x10000)])


@dataclass
class Canonical:
    """Canonical tokens of a batch of texts: hash, kind, value of the slot, number of the text, word of the text."""

    hashes: np.ndarray
    kinds: np.ndarray
    values: np.ndarray
    text: np.ndarray
    word: np.ndarray


def _capital(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that start with a capital and go on, not with another one of ASCII."""
    head, second, third = (data[np.minimum(starts + k, len(data) - 1)].astype(np.int64) for k in range(3))
    size = np.where(head >= 0xF0, 4, np.where(head >= 0xE0, 3, np.where(head >= 0xC0, 2, 1)))
    point = np.where(size == 2, (head & 31) << 6 | second & 63, (head & 15) << 12 | (second & 63) << 6 | third & 63)
    capital = ((head >= 0x41) & (head <= 0x5A)) | (((size == 2) | (size == 3)) & _CAPITALS[point])
    after = data[np.minimum(starts + size, len(data) - 1)]
    return capital & (ends - starts > size) & ~((after >= 0x41) & (after <= 0x5A))


def readings(texts: list[str | None]) -> list[Canonical]:
    """Placeholders for numbers, for units behind one, and for capitalised words inside a sentence; in the
    second reading for those that open a sentence too, in the third for nothing.

    Numbers in a row are one slot, and so are names in a row.
    """
    w = words_of(texts, BY_PUNCTUATION, split_digits=True, all_letters=True)
    n = len(w.starts)
    place = np.arange(n) - w.first[w.text]
    literal = Canonical(w.hashes, np.zeros(n, dtype=np.uint8), w.hashes, w.text, place)
    if not n:
        return [literal, literal, literal]
    opening = np.ones(n, dtype=bool)
    opening[1:] = w.text[1:] != w.text[:-1]
    head = w.data[w.starts]
    capital = _capital(w.data, w.starts, w.ends)
    sentence = opening.copy()
    sentence[1:] |= _SENTENCE_END[w.data[w.ends[:-1]]] | _SENTENCE_END[w.data[w.starts[1:] - 1]]
    number = ((head >= 0x30) & (head <= 0x39)) | _in(w.hashes, _numbers)
    behind = np.flatnonzero(number) + 1
    behind = behind[behind < n]
    behind = behind[~opening[behind] & ~number[behind]]
    unit = behind[_in(w.hashes[behind], _units)]

    out = []
    for named in (capital & ~sentence, capital):
        kinds = np.zeros(n, dtype=np.uint8)
        kinds[named] = NAME
        kinds[number] = NUMBER
        kinds[unit] = UNIT
        same = np.zeros(n, dtype=bool)
        same[1:] = ((kinds[1:] == NUMBER) | (kinds[1:] == NAME)) & (kinds[1:] == kinds[:-1]) & ~opening[1:]
        if named is capital:  # a name that opens a sentence is another one than the name before it
            same &= ~(sentence & (kinds == NAME))
        firsts = np.flatnonzero(~same)
        lasts = np.append(firsts[1:], n) - 1
        kinds, values = kinds[firsts], w.hashes[firsts]
        hashes = np.where(kinds == LITERAL, values, _MARKS[kinds])
        for k in np.flatnonzero((lasts > firsts) & (kinds != LITERAL)):
            values[k] = mix(run_hashes(w.hashes[firsts[k] : lasts[k] + 1], int(lasts[k] - firsts[k] + 1)))[0]
        out.append(Canonical(hashes, kinds, values, w.text[firsts], place[firsts]))
    return [*out, literal]


def canonical(texts: list[str | None]) -> Canonical:
    """The first reading."""
    return readings(texts)[PLAIN]


@dataclass(frozen=True)
class Settings:
    """Windows of ``window`` tokens with ``literals`` words at least, or as many as there are read word for word.

    Items with fewer tokens, but ``least`` or more, are one window. An item is leaked if
    ``windows`` of its windows or a ``coverage`` of them are found with consistent slots.
    """

    window: int = 8
    least: int = 4
    literals: int = 5
    windows: int = 6
    coverage: float = 0.5
    filter_bits: int = 23


WINDOWS = "id long, size int, reading int, position long, word long, hash long, slots array<long>"
_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("size", pa.int32()),
        ("reading", pa.int32()),
        ("position", pa.int64()),
        ("word", pa.int64()),
        ("hash", pa.int64()),
        ("slots", pa.list_(pa.int64())),
    ]
)


def _windows(tokens: Canonical, size: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of the windows that lie in one text and hold enough words."""
    hashes = run_hashes(tokens.hashes, size)
    at = np.arange(len(hashes))
    plain = np.append(0, np.cumsum(tokens.kinds == LITERAL))
    good = (tokens.text[at] == tokens.text[at + size - 1]) & (plain[at + size] - plain[at] >= literals)
    return at[good], hashes[good]


def _rows(
    ids: np.ndarray, tokens: Canonical, reading: int, at: np.ndarray, hashes: np.ndarray, size: int
) -> pa.RecordBatch:
    opening = np.searchsorted(tokens.text, tokens.text[at])
    slots = [as_long(tokens.values[a : a + size][tokens.kinds[a : a + size] != LITERAL]) for a in at]
    columns = [
        ids[tokens.text[at]], np.full(len(at), size), np.full(len(at), reading),
        at - opening, tokens.word[at], as_long(hashes), slots,
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
    )


def _read(
    tokens: Canonical, reading: int, size: int, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of a reading's windows."""
    least = 0 if reading == WORDS else -(-settings.literals * size // settings.window)
    at, hashes = _windows(tokens, size, least)
    return at, hashes ^ _SALTS[reading]


def _identified(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, Canonical]]:
    ids = np.asarray(batch.column("id"), dtype=np.int64)
    for start, texts in text_batches(batch, "text"):
        for reading, tokens in enumerate(readings(texts)):
            yield ids[start : start + len(texts)], reading, tokens


def item_windows(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """All windows of the items, which have columns id and text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, reading, tokens in _identified(batch):
                counts = np.bincount(tokens.text, minlength=len(ids))
                for size in range(settings.least, settings.window + 1):
                    at, hashes = _read(tokens, reading, size, settings)
                    short = counts[tokens.text[at]] == size
                    keep = short if size < settings.window else np.ones(len(at), dtype=bool)
                    if keep.any():
                        yield _rows(ids, tokens, reading, at[keep], hashes[keep], size)

    return benchmark.mapInArrow(windows, WINDOWS)


def document_windows(docs: DataFrame, sizes: list[int], bits: np.ndarray, settings: Settings) -> DataFrame:
    """The windows of the documents whose bit is set in the filter; docs have columns id and text."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for ids, reading, tokens in _identified(batch):
                for size in sizes:
                    at, hashes = _read(tokens, reading, size, settings)
                    hit = in_filter(table, hashes)
                    if hit.any():
                        yield _rows(ids, tokens, reading, at[hit], hashes[hit], size)

    return docs.mapInArrow(windows, WINDOWS)


def _consistent(met: DataFrame) -> DataFrame:
    """The windows met whose slots say nothing that others of the same alignment contradict.

    A value of the item that stands for two values of the document, or the other way round, takes the windows with it
    that hold it, and no others: one changed number does not hide the rest of a passage. Read word for
    word there are no slots, so windows that agree always count.
    """
    place = ["doc_id", "item_id", "reading", "shift"]
    window = [*place, "size", "item_position"]
    paired = F.arrays_zip(F.col("said").alias("a"), F.col("slots").alias("b"))
    slots = met.select(*window, F.explode(paired).alias("slot"))
    torn = (
        slots.groupBy(*place)
        .agg(
            F.countDistinct("slot").alias("pairs"),
            F.countDistinct("slot.a").alias("theirs"),
            F.countDistinct("slot.b").alias("ours"),
        )
        .where("pairs <> theirs OR pairs <> ours")
        .select(*place)
    )
    # Few alignments are torn; only theirs are looked at slot by slot.
    said = keep_on_disk(slots.join(torn, place, "left_semi").select(*window, "slot.a", "slot.b").distinct(), "torn-slots")
    gone = [
        said.join(
            said.groupBy(*place, one).agg(F.countDistinct(other).alias("values")).where("values > 1").select(*place, one),
            [*place, one],
            "left_semi",
        ).select(*window)
        for one, other in (("a", "b"), ("b", "a"))
    ]
    return met.join(gone[0].union(gone[1]).distinct(), window, "left_anti")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds a passage of.

    Gives ``doc_id``, ``item_id``, ``windows`` (different ones found), ``coverage`` (of the item's
    windows) and ``verbatim`` (whether all slots have the item's own values), by the first of the
    :func:`readings` that shows the leak.

    Documents are read once, in place. A filter of fixed size keeps windows that no item has from
    leaving their task; what passes it is joined with the items' windows by hash, so the result is
    exact for any number of items. A passage that very many documents hold is a hot key of that
    join, which adaptive execution splits.

    Rows without id are left out; NULL and empty texts hold nothing, nor do items with fewer than
    ``settings.least`` tokens. Repeated rows of one id count as one document. An empty table on
    either side gives no rows. Other columns are left out.
    """
    items = benchmark.select(F.col(item).cast("long").alias("id"), F.col(item_text).alias("text"))
    theirs = keep_on_disk(item_windows(items.where("id IS NOT NULL"), settings), "benchmark-windows")
    sizes = sorted(row["size"] for row in theirs.select("size").distinct().collect())
    bits = hash_filter(theirs.select("hash"), settings.filter_bits)
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    # The windows that pass the filter are read by several steps below; documents are read once.
    ours = keep_on_disk(document_windows(texts, sizes, bits, settings), "document-windows")

    totals = theirs.groupBy(F.col("id").alias("item_id"), "reading").agg(
        F.countDistinct("size", "position").alias("total")
    )
    named = theirs.select(
        F.col("id").alias("item_id"), "size", "reading", F.col("position").alias("item_position"),
        "hash", F.col("slots").alias("said"),
    )
    met = ours.withColumnRenamed("id", "doc_id").join(named, ["hash", "size", "reading"])
    met = met.select(
        "doc_id",
        "item_id",
        "reading",
        "size",
        "item_position",
        (F.col("position") - F.col("item_position")).alias("shift"),
        "slots",
        "said",
    )
    found = (
        _consistent(met)
        .groupBy("doc_id", "item_id", "reading")
        .agg(F.countDistinct("item_position").alias("windows"), F.min(F.expr("said = slots")).alias("verbatim"))
        .join(totals, ["item_id", "reading"])
        .withColumn("coverage", F.col("windows") / F.col("total"))
        .where((F.col("windows") >= settings.windows) | (F.col("coverage") >= settings.coverage))
    )
    best = found.groupBy("doc_id", "item_id").agg(
        F.min_by(F.struct("windows", "coverage", "verbatim"), "reading").alias("best")
    )
    return best.select("doc_id", "item_id", "best.windows", "best.coverage", "best.verbatim")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with their columns as they were.

    Rows without id cannot be named by a pair, so they stay.
    """
    return without_ids(docs, leaks(docs, benchmark, id=id, **options).select("doc_id").distinct(), id=id)
