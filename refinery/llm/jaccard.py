"""N-gram Jaccard join with adaptive multi-match prefixes.

The shingles of all documents are put in one global order, the rarest first. Two sets that reach
the threshold share at least m of the first ``n - need + m`` shingles of each, for any m. A larger
m makes the prefixes longer but asks more of a candidate; each document takes the m that is
estimated to cost least, and a pair has to share as many as the smaller of its two.

The order comes from a sketch of document counts of fixed size. Any order that is the same for all
documents gives the same result; a coarser sketch only makes prefixes less selective.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import arrow_bytes, keep_on_disk, slices
from refinery.llm.rows import first_of_ids, without_ids
from refinery.llm.hashing import BY_BLANKS, BY_PUNCTUATION, as_long, hash_filter, in_filter, mix, run_hashes, text_batches, words_of
from refinery.llm.linking import connected_components, link_by_keys, shared_only


@dataclass(frozen=True)
class Settings:
    """Link at ``percent`` of the union or more. ``most_matches`` bounds m, the matches a prefix is made for.

    ``by_punctuation`` parts words at all ASCII marks, not at blanks only. ``verify_cost`` is what checking a pair costs, in units of finding one shared shingle.
    """

    n: int = 3
    percent: int = 90
    by_punctuation: bool = False
    most_matches: int = 4
    verify_cost: float = 50.0
    sketch_bits: int = 20
    bitmap_words: int = 16


def shingle_sets(texts: list[str | None], settings: Settings) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles of n words; of all its words, if they are fewer."""
    n = settings.n
    w = words_of(texts, BY_PUNCTUATION if settings.by_punctuation else BY_BLANKS)
    runs = run_hashes(w.hashes, n)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        else:
            yield run_hashes(w.hashes[a:b], int(b - a)) if b > a else runs[:0]


SKETCH_CHUNK = 1 << 14
# Rows of pairs bring two whole texts each: ten thousand of them at a time could take gigabytes in a Python worker.
BATCH_BYTES = 16 << 20


def sketch(docs: DataFrame, settings: Settings) -> np.ndarray:
    """In how many documents the shingles of each slot occur, over all documents.

    Every task counts into a table of ``2 ** sketch_bits`` slots; the tables are added up chunk by
    chunk, in two steps, and the sum of 8 MB (at 20 bits) comes to the driver.
    """
    slots, shift = 1 << settings.sketch_bits, np.uint64(64 - settings.sketch_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            for _, texts in text_batches(batch, "text"):
                hashes = np.concatenate([np.empty(0, np.uint64), *shingle_sets(texts, settings)])
                counts += np.bincount((hashes >> shift).astype(np.int64), minlength=slots)
        chunks = counts.reshape(-1, min(slots, SKETCH_CHUNK))
        used = [k for k, chunk in enumerate(chunks) if chunk.any()]
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(used, pa.int32()), "counts": [zlib.compress(chunks[k], 1) for k in used]}
        )

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(min(slots, SKETCH_CHUNK), dtype=np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(zlib.decompress(counts.as_buffer()), np.int64)
        return pa.table({"chunk": rows["chunk"][:1], "counts": [zlib.compress(total, 1)]})

    kind = "chunk int, counts binary"
    part = docs.mapInArrow(count, kind).withColumn("part", F.spark_partition_id() % 64)
    step = part.groupBy("chunk", "part").applyInArrow(lambda t: add(t), kind)
    out = np.zeros((slots // min(slots, SKETCH_CHUNK), min(slots, SKETCH_CHUNK)), dtype=np.int64)
    for row in step.groupBy("chunk").applyInArrow(lambda t: add(t), kind).collect():
        out[row["chunk"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return out.ravel()


def matches_to_ask(costs: np.ndarray, size: int, need: int, settings: Settings) -> int:
    """The m with the least estimated cost for a set whose ordered shingles have these candidate counts.

    A prefix meets as many shared shingles as its counts add up to. A candidate takes up m of them,
    so at most that sum divided by m are verified.
    """
    most = min(settings.most_matches, need)
    shared = np.cumsum(costs[: size - need + most])[size - need :]
    asked = np.arange(1, most + 1)
    return int(np.argmin(shared + settings.verify_cost * shared / asked)) + 1


SIGNED = "node long, size int, key1 long, key2 long, matches int, prefix array<long>, bits array<long>"
_SIGNED = pa.schema(
    [
        ("node", pa.int64()),
        ("size", pa.int32()),
        ("key1", pa.int64()),
        ("key2", pa.int64()),
        ("matches", pa.int32()),
        ("prefix", pa.list_(pa.int64())),
        ("bits", pa.list_(pa.int64())),
    ]
)


def parity_bits(hashes: np.ndarray, words: int) -> np.ndarray:
    """Each shingle turns one bit over; two sets differ in at least as many shingles as in bits."""
    counts = np.bincount((mix(hashes) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def signatures(docs: DataFrame, counts: np.ndarray, settings: Settings) -> DataFrame:
    """Per document the size and key of its set, its prefix, and its parity bits."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    shift = np.uint64(64 - settings.sketch_bits)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        load = int(table.mean())
        for batch in batches:
            ids = batch.column("node").to_pylist()
            for start, texts in text_batches(batch, "text"):
                rows = []
                for node, s in zip(ids[start:], shingle_sets(texts, settings), strict=False):
                    size, need = len(s), -(-settings.percent * len(s) // 100)
                    held = table[(s >> shift).astype(np.int64)]
                    order = np.lexsort((s, held))[: size - need + settings.most_matches]
                    # What other shingles put into the slot is taken off.
                    others = np.maximum(held[order] - load, 2) - 1
                    matches = matches_to_ask(others, size, need, settings) if size else 0
                    keys = [np.add.reduce(mix(s + np.uint64(k))) for k in (1, 2)]
                    rows.append(
                        (
                            node,
                            size,
                            *(int(k.view(np.int64)) for k in keys),
                            matches,
                            as_long(s[order[: size - need + matches]]),
                            parity_bits(s, settings.bitmap_words),
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _SIGNED, strict=True)],
                    schema=_SIGNED,
                )

    return docs.mapInArrow(sign, SIGNED)


def verify_pairs(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the threshold, counted exactly."""
    percent = settings.percent

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Texts of some thousand pairs come at a time; their words and shingles take many times their size.
        for batch in (part for whole in batches for part in slices(whole, "a_text", 1 << 20)):
            left, right = (list(shingle_sets(batch.column(c).to_pylist(), settings)) for c in ("a_text", "b_text"))
            good = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"]
            )

    sides = [texts.select(F.col("node").alias(s), F.col("text").alias(f"{s}_text")) for s in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(check, "a long, b long").distinct()


KEYS = ["key1", "key2", "size"]


def jaccard_links(
    docs: DataFrame, *, id: str, text: str, settings: Settings
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures by row, classes of equal sets by smallest node, and links (a, b) of the classes' nodes.

    See :func:`jaccard_classes`; the links connect what all links would connect.
    """
    texts = docs.select(F.col(id).cast("long").alias("node"), F.col(text).alias("text"))
    counts = sketch(texts.select("text"), settings)
    signed = keep_on_disk(signatures(texts, counts, settings), "signatures")
    able = signed.where("size > 0 AND node IS NOT NULL")
    classes = keep_on_disk(
        able.groupBy(*KEYS).agg(F.min("node").alias("node"), F.first("bits").alias("bits")), "classes"
    )
    shared = shared_only(able.select(F.posexplode("prefix").alias("at", "key"), "node", "size", "matches"))
    stands_for = able.select(*KEYS, F.col("node").alias("member")).join(classes.select(*KEYS, "node"), KEYS)
    stands_for = stands_for.select("member", F.col("node").alias("class"))
    postings = keep_on_disk(
        shared.join(stands_for, F.col("node") == F.col("member"))
        .groupBy("key", F.col("class").alias("node"))
        .agg(F.min("size").alias("size"), F.min("matches").alias("matches"), F.min("at").alias("at")),
        "class-postings",
    )
    percent = F.lit(settings.percent)
    matches = F.least("a_matches", "b_matches")
    # One of the first ``matches`` shared shingles has as many before it at most, and all others behind it.
    most = matches - 1 + F.least(F.col("a_size") - F.col("a_at"), F.col("b_size") - F.col("b_at"))
    near = (100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size")) & (
        (100 + percent) * most >= percent * (F.col("a_size") + F.col("b_size"))
    )

    apart = sum(
        (F.bit_count(F.col("a_bits")[k].bitwiseXOR(F.col("b_bits")[k])) for k in range(settings.bitmap_words)),
        F.lit(0),
    )
    total = F.col("a_n") + F.col("b_n")
    # With d shingles not shared of a total of t, the Jaccard similarity is (t - d) / (t + d).
    possible = 100 * (total - apart) >= percent * (total + apart)
    details = classes.select("node", F.col("size").alias("n"), "bits")

    def verify(pairs: DataFrame) -> DataFrame:
        sides = [details.select(*[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in details.columns]) for s in ("a", "b")]
        left = pairs.join(sides[0], "a").join(sides[1], "b").where(possible).select("a", "b").distinct()
        left = keep_on_disk(left, "candidates")
        nodes = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
        table = texts.sparkSession.sparkContext.broadcast(hash_filter(nodes.select(F.xxhash64("node"))))

        def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = np.asarray(batch.column("hash"), dtype=np.int64).view(np.uint64)
                yield batch.select(["node", "text"]).filter(pa.array(in_filter(table.value, hashes)))

        some = texts.where("node IS NOT NULL").withColumn("hash", F.xxhash64("node"))
        found = some.mapInArrow(needed, "node long, text string")
        return verify_pairs(left, found, settings)

    # Of near copies, those with few shingles of their own meet a shared one early; they lead.
    turn = F.shiftleft(F.col("at").cast("long"), 32) + F.pmod(F.xxhash64("node", "key"), F.lit(1 << 32))
    enough = F.col("shared") >= matches
    links = link_by_keys(postings, verify, near=near, enough=enough, turn=turn, details=details, alike=possible)
    return signed, classes, links


def jaccard_classes(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links).

    Documents with equal sets form a class at once, by a key of the set, and only one of a class goes
    on. Prefix shingles that one class alone has are dropped, the others are linked through leaders
    first and then between components. Pairs whose sizes or the places of a shared shingle rule a
    link out do not come up, candidates whose parity bits do are dropped before their texts are
    fetched, and the rest are counted on whole texts.

    No link between different texts is lost: all filters are exact. NULL and empty texts have no
    shingles and are their own component. Rows without id keep their size, take no part in links and
    get a NULL component. Rows of one id are one node. An empty table gives no rows. Other columns
    are left out.
    """
    # All that goes through Python is written before this returns: the links' components are on disk.
    with arrow_bytes(docs.sparkSession, BATCH_BYTES):
        signed, classes, links = jaccard_links(docs, id=id, text=text, settings=settings)
        components = connected_components(links)
    named = classes.select(*KEYS, "node").join(components, "node", "left")
    named = named.select(*KEYS, F.coalesce("component", "node").alias("component_id"))
    return (
        signed.select(F.col("node").alias("doc_id"), *KEYS)
        .join(named, KEYS, "left")
        .select(
            "doc_id",
            F.col("size").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
    )


def one_per_class(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with one row of each class of :func:`jaccard_classes`, that of the smallest id; columns stay.

    Of rows with that same id the one with the smallest text stays. Rows without id or without
    shingles stay.
    """
    found = jaccard_classes(docs, id=id, text=text, settings=settings).where("doc_id IS NOT NULL")
    found = keep_on_disk(found.where("n_shingles > 0"), "classes-of-documents")
    kept = without_ids(docs, found.where("doc_id <> component_id").select("doc_id").distinct(), id=id)
    twice = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    return first_of_ids(kept, twice, id=id, order=text)
