"""Stupid-backoff scores from n-gram counts of the whole corpus.

An n-gram's score is its count over its context's count; if it does not occur, the next shorter
one's score times ``alpha``. A document is scored with its own n-grams taken off the counts, as
otherwise every n-gram would occur.

The n-grams of a batch of documents are sorted by hash, so a range of hashes is a bucket. Each batch
sends its distinct n-grams and their counts to their buckets; a bucket adds them up and answers
with the totals; the answers of all buckets, in order, are the totals of the batch's n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import free_name, keep_on_disk
from refinery.llm.hashing import BY_PUNCTUATION, mix, run_hashes, words_of


@dataclass(frozen=True)
class Settings:
    """``batch_bytes`` of text make a batch; ``bucket_grams`` n-grams, counted once per batch, a bucket."""

    order: int = 2
    alpha: float = 0.4
    batch_bytes: int = 8 << 20
    bucket_grams: int = 1 << 20


@dataclass
class Grams:
    """Per order from 1 on, the hashes of the n-grams that end at each word; those that would cross texts are out."""

    first: np.ndarray
    text: np.ndarray
    ends: list[np.ndarray]
    hashes: list[np.ndarray]


def grams(texts: list[str | None], order: int) -> Grams:
    w = words_of(texts, BY_PUNCTUATION)
    ends, hashes = [], []
    for n in range(1, order + 1):
        found = mix(run_hashes(w.hashes, n) + np.uint64(n))
        at = np.arange(len(found)) + n - 1
        inside = w.text[at] == w.text[at - n + 1]
        ends.append(at[inside])
        hashes.append(found[inside])
    return Grams(w.first, w.text, ends, hashes)


def distinct(g: Grams) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(g.hashes), return_counts=True)


REQUEST = "bucket int, batch int, hashes binary, counts binary"
REPLY = "batch int, bucket int, totals binary"


def ask(buckets: int, order: int):
    """A batch's distinct n-grams, a row per bucket."""
    width = (1 << 64) // buckets + 1

    def request(docs: pa.Table) -> pa.Table:
        hashes, counts = distinct(grams(docs["text"].to_pylist(), order))
        edges = np.array([min(width * k, (1 << 64) - 1) for k in range(1, buckets)], dtype=np.uint64)
        cuts = np.append(np.append(0, np.searchsorted(hashes, edges)), len(hashes))
        used = np.flatnonzero(np.diff(cuts))
        counts = counts.astype(np.int32)
        return pa.table(
            {
                "bucket": pa.array(used, pa.int32()),
                "batch": pa.array([docs["batch"][0].as_py()] * len(used), pa.int32()),
                "hashes": pa.array([hashes[cuts[k] : cuts[k + 1]].tobytes() for k in used], pa.binary()),
                "counts": pa.array([counts[cuts[k] : cuts[k + 1]].tobytes() for k in used], pa.binary()),
            }
        )

    return request


def answer(rows: pa.Table) -> pa.Table:
    """The totals of a bucket's n-grams, for each row in the order of its hashes."""
    parts = [np.frombuffer(h.as_buffer(), np.uint64) for h in rows["hashes"]]
    counts = np.concatenate([np.frombuffer(c.as_buffer(), np.int32) for c in rows["counts"]])
    _, place = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(place, weights=counts).astype(np.int64)[place]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    answers = [part.tobytes() for part in np.split(totals, cuts)]
    return pa.table({"batch": rows["batch"], "bucket": rows["bucket"], "totals": pa.array(answers, pa.binary())})


def score(texts: list[str | None], totals: np.ndarray, words: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of words and the sum of the logarithms of their scores.

    ``totals`` are the corpus counts of the batch's distinct n-grams by hash, ``words`` the number
    of words of the corpus.
    """
    g = grams(texts, settings.order)
    known, _ = distinct(g)
    n = len(g.text)
    left = []  # per order, what is left of the count of the n-gram that ends at each word; -1 for none
    for ends, hashes in zip(g.ends, g.hashes, strict=True):
        place = np.searchsorted(known, hashes)
        # A text's own count of an n-gram: equal (text, n-gram) pairs stand side by side once sorted.
        _, back, own = np.unique(g.text[ends] * len(known) + place, return_inverse=True, return_counts=True)
        column = np.full(n, -1, dtype=np.int64)
        column[ends] = totals[place] - own[back]
        left.append(column)
    lengths = np.diff(g.first)
    rest = (words - lengths)[g.text]
    # A word that no other text has counts as one of one more than all words.
    value = np.where(left[0] > 0, left[0] / np.maximum(rest, 1), 1 / (rest + 1.0))
    for n_gram, context in zip(left[1:], left[:-1], strict=True):
        before = np.append(-1, context[:-1])
        seen = n_gram > 0
        longer = n_gram / np.where(seen, before, 1)
        value = np.where(seen, longer, np.where(n_gram < 0, value, settings.alpha * value))
    sums = np.bincount(g.text, weights=np.log(value), minlength=len(lengths))
    return lengths, sums


def with_backoff_scores(
    docs: DataFrame, *, text: str = "text", into: str = "lm", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with a struct ``into`` of ``words`` and ``log_score``, the sum over the document's words.

    Words are runs of letters, digits and all that is not ASCII, A-Z in lower case. The first words of
    a text have shorter contexts, which costs no ``alpha``. Counts cover all documents.

    Documents are dealt into batches, n-grams into buckets, both even by hash and both more in number
    as the corpus grows, so no task holds a group that grows with it. An n-gram that is in every
    document is one entry per batch in its bucket.

    NULL and empty texts have no words and a sum of 0. Each of several equal rows is scored by what
    all others hold. An empty table gives no rows. A column named ``into`` is replaced.
    """
    row = free_name(docs, "_row")
    names = [name for name in docs.columns if name != into]
    size = docs.select(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    batches = max(1, -(-size // settings.batch_bytes))
    dealt = docs.select(
        F.struct(*(docs[name] for name in names)).alias(row),
        docs[text].alias("text"),
        F.pmod(F.xxhash64(*(docs[name] for name in names if docs.schema[name].dataType.typeName() != "map")), F.lit(batches))
        .cast("int")
        .alias("batch"),
    )
    grouped = dealt.select("batch", "text").groupBy("batch")
    buckets = max(1, -(-size * settings.order // (6 * settings.bucket_grams)))
    asked = grouped.applyInArrow(ask(buckets, settings.order), REQUEST)
    replies = keep_on_disk(asked.groupBy("bucket").applyInArrow(answer, REPLY), "ngram-totals")
    words = docs.select(F.sum(count_words(docs[text]))).first()[0] or 0
    schema = dealt.select(row).schema.add("words", "long").add("log_score", "double")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(right["bucket"]))
        parts = right["totals"].to_pylist()
        totals = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(parts[k], np.int64) for k in order)])
        lengths, sums = score(left["text"].to_pylist(), totals, words, settings)
        return left.select([row]).append_column("words", pa.array(lengths, pa.int64())).append_column(
            "log_score", pa.array(sums, pa.float64())
        )

    scored = dealt.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(finish, schema)
    return scored.select(*(F.col(row)[name].alias(name) for name in names), F.struct("words", "log_score").alias(into))


def count_words(text):
    """The number of words of a text, by compiled expressions."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    trimmed = F.trim(plain)
    return F.when(F.length(trimmed) == 0, 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "))) + 1)
