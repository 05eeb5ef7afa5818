"""Words of many texts at once, as 64-bit hashes, and hashes of runs of words.

A word's hash is a polynomial of its bytes, taken as a difference of running sums, so that no
Python code runs per word. All arithmetic wraps at 64 bits; numpy warns only for scalars.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import release_worker_cache

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)
_BLOCK = 1 << 18

# 0 parts words, 1 is part of one, 2 is a digit.
_blank = [0 if b == 0x20 or 0x09 <= b <= 0x0D else 1 for b in range(256)]
BY_BLANKS = np.array(_blank, dtype=np.uint8)
BY_PUNCTUATION = np.array(
    [
        2 if 0x30 <= b <= 0x39 else 1 if b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 0
        for b in range(256)
    ],
    dtype=np.uint8,
)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly; one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(of: int, n: int) -> np.ndarray:
    out = np.full(n, of, dtype=_U)
    out[:1] = 1
    return np.multiply.accumulate(out)


_up, _down = _powers(_BASE, _BLOCK + 1), _powers(_INVERSE, _BLOCK + 1)


def word_hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``lower[start:end]`` for each word, over blocks of some hundred kilobytes."""
    out = np.empty(len(starts), dtype=_U)
    first = 0
    while first < len(starts):
        base = starts[first]
        stop = max(first + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
        size = int(ends[stop - 1] - base)
        up, down = (_up, _down) if size <= _BLOCK else (_powers(_BASE, size + 1), _powers(_INVERSE, size + 1))
        sums = np.zeros(size + 1, dtype=_U)
        np.cumsum((lower[base : base + size].astype(_U) + _U(1)) * up[:size], out=sums[1:])
        a, b = starts[first:stop] - base, ends[first:stop] - base
        out[first:stop] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(_U))
        first = stop
    return out


@dataclass
class Words:
    """Words of a batch of texts: where they are in ``data``, which text they belong to, their hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # per text, the number of its first word; one more entry than texts


def folded(text: str) -> bytes:
    """The text in lower case, byte for byte: letters whose lower case has another length stay."""
    data = text.lower().encode()
    if len(data) == len(text.encode()):
        return data
    return "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in text).encode()


def words_of(
    texts: Sequence[str | None],
    classes: np.ndarray = BY_BLANKS,
    *,
    split_digits: bool = False,
    all_letters: bool = False,
) -> Words:
    """The words of all texts, in lower case: A-Z, or with ``all_letters`` those of other scripts too.

    ``split_digits`` parts a digit from a letter behind it.
    """
    encoded = [(text or "").encode() for text in texts]
    data = np.frombuffer(b"\n".join([*encoded, b""]), dtype=np.uint8)
    if all_letters:
        lower = np.frombuffer(b"\n".join([*(folded(text or "") for text in texts), b""]), dtype=np.uint8)
    else:
        lower = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    kind = classes[data]
    inside = kind > 0
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = inside & ~before
    end = before & ~inside
    if split_digits:
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (kind[1:] == 1) & (kind[:-1] == 2)
        start |= cut
        end |= cut
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    offsets = np.cumsum([0, *(len(part) + 1 for part in encoded)])
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(encoded)), np.diff(first))
    return Words(data, starts, ends, text, word_hashes(lower, starts, ends), first)


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n hashes in a row; the order counts."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, dtype=_U)
    total = hashes[:size].copy()
    for k in range(1, n):
        total = total * _STEP + hashes[k : k + size]
    return mix(total)


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def text_batches(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch in slices of about ``most`` bytes, with the number of the first row."""
    release_worker_cache()
    column = batch.column(text)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, column.slice(start, stop - start).to_pylist()
        start = stop


def filter_bits(rows: int, most: int = 28) -> int:
    """The size of a :func:`hash_filter` that lets one in about twenty strangers pass: 16 bits a row, 32 MB at most."""
    return min(most, max(16, (16 * rows).bit_length()))


def hash_filter(hashes: DataFrame, bits: int = 23) -> np.ndarray:
    """Which upper parts occur among the hashes of a one-column frame: ``2 ** bits`` bits, however many rows.

    The bits come to the driver as 64-bit words, 1 MB at 23 bits, and can be sent to all tasks to
    leave out rows that would find no partner. What passes still has to be joined.
    """
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    words = hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))).alias("bits")
    )
    out = np.zeros(max(1, 2**bits // 64), dtype=np.int64)
    found = words.toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def in_filter(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether its bit is set in a table of :func:`hash_filter`."""
    bits = (len(table) * 64).bit_length() - 1
    slot = hashes >> _U(64 - bits)
    return (table.view(_U)[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) > 0
