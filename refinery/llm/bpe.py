"""Byte-level BPE by backtracking: longest matches first, neighbours checked for compatibility.

A sequence of tokens is the one that the merges produce if every two neighbours are what the
merges make of their joint bytes. So the encoder takes the longest token at each place and steps
back to a shorter one where two neighbours would have been merged otherwise; places without a way
on are marked, which keeps the work linear in the number of bytes. The matcher wants characters,
so bytes go through it as the Latin-1 characters of the same number.
"""

from __future__ import annotations

import base64
import re
import zlib
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import per_text, worker_cache

NONE = -1
# What the caches of a worker may hold; they are emptied beyond it, results do not depend on it.
MOST_CHUNKS, MOST_PAIRS = 200_000, 300_000
MARKS = frozenset(".,;:!?")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Merges:
    """Tokens in the order of their merges, and what the encoder looks up."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        lengths = [len(t) for t in ranks]
        if sum(n == 1 for n in lengths) != 256:
            raise ValueError("every single byte must be a token")
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.most = max(lengths)
        self.matcher = ahocorasick.Automaton()
        # The matcher tells how far a text goes along any token; from there, the longest whole token.
        self.longest: dict[str, int] = {}
        for token in sorted(ranks):
            text = token.decode("latin-1")
            self.matcher.add_word(text, ranks[token])
            rank = NONE
            for end in range(1, len(text) + 1):
                rank = ranks.get(token[:end], rank)
                self.longest[text[:end]] = rank
        self.shorter = {rank: self._prefix(token) for token, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            self._split(token, rank)
        self.fits: dict[int, bool] = {}

    def _prefix(self, token: bytes) -> int:
        """The longest token that this one starts with, itself aside."""
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.ids.get(token[:end])) is not None:
                return rank
        return NONE

    def _split(self, token: bytes, rank: int) -> None:
        """Finds the two tokens whose merge made this one."""
        left = self.shorter[rank]
        while left != NONE:
            right = self.ids.get(token[self.length[left] :])
            if right is not None and left < rank and right < rank and self.compatible(left, right):
                self.parts[rank] = (left, right)
                self.merged[left, right] = rank
                return
            left = self.shorter[left]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between the two tokens as it is.

        Undoes the merges inside the two, the latest first, down to the two bytes at the border. At
        each step the two parts that touch must not form a token that would have come earlier.
        """
        limit = 1 << 62
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            undo_left = left > right
            for side_left in (undo_left, not undo_left):
                if side_left and left in self.parts:
                    limit, left = left, self.parts[left][1]
                    break
                if not side_left and right in self.parts:
                    limit, right = right + 1, self.parts[right][0]
                    break
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece of text."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        size, text = len(piece), piece.decode("latin-1")
        length, fits, longest, most, along = self.length, self.fits, self.longest, self.most, self.matcher.longest_prefix
        shorter, compatible = self.shorter, self.compatible
        closed: set[int] = set()
        out: list[int] = []
        ahead = text[:most]
        at, token, last = 0, longest[ahead[: along(ahead)]], NONE
        while True:
            end = at + length[token]
            if last == NONE:
                good = True
            else:
                good = fits.get(pair := last << 32 | token)
                if good is None:
                    if len(fits) >= MOST_PAIRS:
                        fits.clear()
                    good = fits[pair] = compatible(last, token)
            if good and end not in closed:
                out.append(token)
                if end == size:
                    return out
                ahead = text[end : end + most]
                at, last, token = end, token, longest[ahead[: along(ahead)]]
                continue
            token = shorter[token]
            while token == NONE:
                closed.add(at)
                out.pop()
                at -= length[last]
                token, last = shorter[last], out[-1] if out else NONE


class Chunks(dict):
    """Ids, as bytes, of chunks of text between spaces; the frequent ones survive a full cache.

    ``lead`` is what stands before every chunk: nothing at the start of a text, else the space.

    With ``plain`` the pattern takes letters with a space in front as one piece, and parts them from
    a mark behind, which spares most chunks the pattern.
    """

    def __init__(self, merges: Merges, pattern: regex.Pattern, plain: bool, lead: str):
        self.merges, self.find, self.plain, self.lead, self.old = merges, pattern.findall, plain, lead, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= 64:
            if len(self) >= MOST_CHUNKS:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, chunk: str) -> bytes:
        encode, whole = self.merges.encode, self.lead + chunk
        if self.plain and chunk[-1:] in MARKS and chunk[-2:-1].isalpha():
            return self[chunk[:-1]] + pack("<I", *encode(chunk[-1].encode()))
        if self.plain and chunk.isalpha():
            found = encode(whole.encode())
        else:
            found = [i for piece in self.find(whole) for i in encode(piece.encode())]
        return pack(f"<{len(found)}I", *found)


# Where white space is followed by a space and then by white space or the end, a split at the space
# could part what the pattern takes as one piece.
_tangled = re.compile(r" (?=\s|\Z)(?<=\s )")


class Encoder:
    """Encodes and decodes whole texts.

    A space with something visible behind it always begins a piece of its own in this pattern,
    so texts are split at spaces, and each chunk's ids are looked up or found once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = Merges(ranks)
        self.pattern = regex.compile(pattern)
        find = self.pattern.findall
        words = ["ab", " ab", "é", " ß"]
        plain = all(find(x) == [x] and find(x + mark) == [x, mark] for x in words for mark in MARKS)
        self.opening = Chunks(self.merges, self.pattern, plain, "")
        self.chunks = Chunks(self.merges, self.pattern, plain, " ")
        probe = [" a", " 1", " .", "a b", "a", "\n", " a\n", "a\n b", " \n"]
        self.by_chunks = all(
            self.pattern.findall(x + " " + y) == self.pattern.findall(x) + self.pattern.findall(" " + y)
            for x in probe
            for y in ("a", "1", ".", "\nb", "é")
            if not _tangled.search(x + " " + y)
        )

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_chunks or _tangled.search(text):
            encode = self.merges.encode
            found = [i for piece in self.pattern.findall(text) for i in encode(piece.encode())]
            return pack(f"<{len(found)}I", *found)
        first, *rest = text.split(" ")
        return self.opening[first] + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _ranks_of(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, lines.splitlines()))}


def encoder_of(lines: bytes, pattern: str) -> Encoder:
    """The encoder of a rank file's content."""
    return Encoder(_ranks_of(lines), pattern)


class Decoder:
    """The bytes of each id: all that decoding needs, without the encoder's matcher and caches."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = {rank: token for token, rank in ranks.items()}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Vocabulary:
    """A rank file, read once on the driver and broadcast; its size does not depend on the data."""

    def __init__(self, df: DataFrame, path: str, pattern: str):
        with open(path, "rb") as file:
            self.lines = df.sparkSession.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """The ids of a text as little-endian unsigned 32-bit numbers; NULL counts as empty."""
        lines, pattern = self.lines, self.pattern
        return per_text(lambda value: _cached(lines, pattern).encode(value), "binary", pa.binary())(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        lines, pattern = self.lines, self.pattern
        return per_text(lambda value: _decoder(lines).decode(value or b""), "binary", pa.binary())(ids)


_known: list = [None, None]


def _content(lines) -> tuple[int, int]:
    # The content is summed up once per broadcast; tasks of later stages may bring the same content anew.
    if _known[0] is not lines:
        _known[:] = [lines, (zlib.crc32(lines.value), len(lines.value))]
    return _known[1]


def _cached(lines, pattern: str) -> Encoder:
    return worker_cache((_content(lines), pattern), lambda: encoder_of(lines.value, pattern))


def _decoder(lines) -> Decoder:
    return worker_cache((_content(lines), Decoder), lambda: Decoder(_ranks_of(lines.value)))


def with_ids(docs: DataFrame, path: str, pattern: str, *, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as a binary column ``into``, which replaces one of that name.

    The same ids as the reference library's encoder without special tokens. NULL and empty texts
    have none. Nothing is shuffled; repeated rows each get the same ids.
    """
    return docs.withColumn(into, Vocabulary(docs, path, pattern).encode(docs[text]))


def with_decoded(docs: DataFrame, path: str, pattern: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each row's ids as a binary column ``into``; NULL ids give none.

    Spark chains a Python function whose argument is another one, and then runs the inner one again for it; the
    ids are read through ``coalesce`` (NULL ids decode as empty either way), so that ids made by ``with_ids`` are
    encoded once and decoded from the column.
    """
    return docs.withColumn(into, Vocabulary(docs, path, pattern).decode(F.coalesce(F.col(ids), F.lit(b""))))
