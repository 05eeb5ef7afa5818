"""Fill-in-middle: a text's prefix, middle and suffix put in the order a model learns to fill gaps from.

A text is cut into lines, and at two of their borders into three sections. Sections leave as pieces of
whole lines, keyed by document and place in the output. One shuffle brings a document's pieces
together and sorts them within their partition, so that they stream by in output order, into a digest or a
text, whatever the document's length. Restoring sorts the same partition once more, by where
each section belongs in the source.

Sorting within partitions after a shuffle by key is what ``repartitionAndSortWithinPartitions`` does for pair
RDDs; ``repartition`` and ``sortWithinPartitions`` are that for DataFrames, without a Python object per piece.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import slices

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
# What each form writes, in order; and where each section belongs in the source.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PLACE = {MARKS["prefix"]: 0, MARKS["middle"]: 1, MARKS["suffix"]: 2}
END = 9


@dataclass(frozen=True)
class Settings:
    """``rate`` and ``spm``: percent of texts that are transformed, and of these in suffix-first form.

    ``piece_bytes`` is how large a piece may get before it ends at a line, and where a longer line is cut.
    """

    seed: int = 7
    rate: int = 100
    spm: int = 50
    piece_bytes: int = 64 << 10


@dataclass
class Cut:
    """A text's form, sections as byte ranges by name, and the borders of its lines."""

    data: bytes
    n: int
    form: str
    sections: dict[str, tuple[int, int]]
    ends: np.ndarray = field(repr=False)

    def chars(self, section: str) -> int | None:
        """Code points of a section; None in a plain text."""
        if self.form == "plain":
            return None
        start, end = self.sections[section]
        return len(self.data[start:end].decode())


def cut(doc_id: int | None, text: str | None, settings: Settings = Settings()) -> Cut:
    """Where a document's text is cut, settled by a hash of the seed and its id (nothing if NULL)."""
    data = (text or "").encode()
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if data and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    name = f"{settings.seed}:{'' if doc_id is None else doc_id}"
    h = [int(part, 16) for part in _groups(hashlib.sha256(name.encode()).hexdigest())]
    if not data or any(mark.encode() in data for mark in MARKS.values()) or h[2] % 100 >= settings.rate:
        return Cut(data, n, "plain", {"prefix": (0, len(data))}, ends)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    sections = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(data))}
    return Cut(data, n, "spm" if h[3] % 100 < settings.spm else "psm", sections, ends)


def _groups(digest: str) -> list[str]:
    return [digest[k : k + 8] for k in range(0, 32, 8)]


def pieces_of(made: Cut, most: int) -> Iterator[tuple[str | None, bytes]]:
    """(mark, piece) in output order; the mark stands before a section's first piece, None before others."""
    plain = made.form == "plain"
    for section in ("prefix",) if plain else FORMS[made.form]:
        start, end = made.sections[section]
        mark = None if plain else MARKS[section]
        while True:
            stop = min(end, start + most)
            if stop < end:
                border = int(np.searchsorted(made.ends, stop, side="right")) - 1
                if border >= 0 and made.ends[border] > start:
                    stop = int(made.ends[border])
            yield mark, made.data[start:stop]
            mark, start = None, stop
            if start >= end:
                break


_ABOUT = [("copies", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
_ABOUT += [("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema([("key", pa.binary()), ("position", pa.int64()), ("mark", pa.string()), ("piece", pa.binary()), *_ABOUT])
PIECES = (
    "key binary, position bigint, mark string, piece binary, "
    "copies bigint, id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
)
# Pieces on their way back; the document's last row brings the digest of its output.
_BACK = pa.schema([("key", pa.binary()), ("place", pa.int64()), ("position", pa.int64()), ("piece", pa.binary()), *_ABOUT])
BACK = PIECES.replace("position bigint, mark string", "place bigint, position bigint")
ABOUT = "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _batches(rows: Iterable[tuple], schema: pa.Schema, payload: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of some megabytes; ``payload`` is the column that makes a row large."""
    kept, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(zip(*kept, strict=True), schema.types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in columns], schema=schema)

    for row in rows:
        kept.append(row)
        size += len(row[payload] or b"")
        if size >= most or len(kept) >= 8192:
            yield batch()
            kept, size = [], 0
    if kept:
        yield batch()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), 1024):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, 1024).columns), strict=True)


def pieces(docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """PIECES of all documents: key and position say where they go, ``about`` a document is on its first piece.

    The key is a digest of id and text, so rows that are alike throughout share one; they are counted
    in ``copies`` before anything is shuffled.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in (part for whole in batches for part in slices(whole, "text", 8 << 20)):
            documents = Counter(zip(batch["id"].to_pylist(), ((t or "") for t in batch["text"].to_pylist()), strict=True))
            for (doc_id, content), copies in documents.items():
                made = cut(doc_id, content, settings)
                key = hashlib.blake2b(f"{doc_id}:".encode() + made.data, digest_size=16).digest()
                about = (copies, doc_id, made.n, made.form, made.chars("prefix"), made.chars("middle"))
                for position, (mark, piece) in enumerate(pieces_of(made, settings.piece_bytes)):
                    yield key, position, mark, piece, *(about if position == 0 else (None,) * len(about))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(emit(batches), _PIECES, 3)

    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def in_output_order(parts: DataFrame) -> DataFrame:
    """A document's pieces in one partition, one after the other as the output has them."""
    return parts.repartition("key").sortWithinPartitions("key", "position")


def _documents(rows: Iterator[tuple]) -> Iterator[tuple[list, Iterator[tuple]]]:
    """(about, pieces) for each document of a sorted stream; pieces must be used up before the next is asked for.

    Pieces of rows that are alike come in several copies side by side: one is kept, and ``copies`` added up.
    """
    row = next(rows, None)
    while row is not None:
        key, about = row[0], list(row[4:])

        def own(first=row, key=key, about=about) -> Iterator[tuple]:
            nonlocal row
            seen, current = None, first
            while current is not None and current[0] == key:
                if current[1:3] != seen:
                    seen = current[1:3]
                    yield current
                elif current[4] is not None:
                    about[0] += current[4]
                current = next(rows, None)
            row = current

        yield about, own()


def transformed(docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``; see ``digests`` for odd rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple]:
            for about, parts in _documents(_rows(batches)):
                output = b"".join(part for row in parts for part in ((row[2] or "").encode(), row[3]))
                for _ in range(about[0]):
                    yield *about[1:], output.decode()

        return _batches(texts(), pa.schema([*_ABOUT[1:], ("output", pa.string())]), 5)

    return in_output_order(pieces(docs, id=id, text=text, settings=settings)).mapInArrow(run, f"{ABOUT}, output string")


def restored(output: Column, form: Column) -> Column:
    """The source text of an output."""
    parts = F.split(output, "<[PSM]>")
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row of ``docs``.

    The output's digest is taken as its pieces stream by; then they are sorted back, by the marks that
    the output holds and nothing else, and the restored text's digest is taken likewise. No task holds
    more of a text than a piece.

    NULL and empty texts are plain, with no lines. A NULL id hashes as no digits; rows that share an
    id are documents of their own, and rows alike in id and text give one row each. Very long texts and
    lines travel in pieces of ``settings.piece_bytes``. An empty table gives no rows, and
    other columns play no part.
    """

    def outwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            nothing = (None,) * len(_ABOUT)
            for about, parts in _documents(_rows(batches)):
                digest, place, key, last = hashlib.sha256(), 0, b"", 0
                for key, position, mark, piece, *_ in parts:
                    digest.update((mark or "").encode() + piece)
                    place, last = PLACE.get(mark, place), position
                    yield key, place, position, piece, *nothing
                yield key, END, last + 1, digest.digest(), *about

        return _batches(rows(), _BACK, 3)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            digest = hashlib.sha256()
            for _, place, _, piece, copies, *about in _rows(batches):
                if place < END:
                    digest.update(piece)
                    continue
                for _ in range(copies):
                    yield *about, piece.hex(), digest.hexdigest()
                digest = hashlib.sha256()

        return _batches(rows(), pa.schema([*_ABOUT[1:], ("output_sha256", pa.string()), ("restored_sha256", pa.string())]), 5)

    ordered = in_output_order(pieces(docs, id=id, text=text, settings=settings)).mapInArrow(outwards, BACK)
    returned = ordered.sortWithinPartitions("key", "place", "position")
    return returned.mapInArrow(back, f"{ABOUT}, output_sha256 string, restored_sha256 string")
