"""How far the words of a source differ from those of the other sources of its language.

Texts are cut at white space. Equal chunks are counted per document first, every globally distinct
chunk is taken apart into terms once, and the terms are joined back to the counts: text is never
tokenized twice. A chunk that is in enough documents of a language settles that its terms are kept,
and one whose chunks add up to too few settles that a term is not; only terms in between need their
documents told apart, and those have few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import empty, keep_on_disk, slices

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``least_docs``: documents of a language a kept term is in. ``top``: terms reported of a group.

    The others say how work is cut and change no result: bytes of text counted at a time, and the
    sources and terms of one tile of comparisons.
    """

    least_docs: int = 10
    top: int = 10
    slice_bytes: int = 32 << 20
    sources: int = 64
    terms: int = 2048


COUNTS = "lang string, chunk string, df bigint, docs array<bigint>, uses array<struct<source:string,n:bigint>>"
_COUNTS = pa.schema(
    [
        ("lang", pa.string()),
        ("chunk", pa.string()),
        ("df", pa.int64()),
        ("docs", pa.list_(pa.int64())),
        ("uses", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))),
    ]
)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def count_chunks(batch: pa.RecordBatch, least_docs: int) -> pa.RecordBatch:
    """Chunks of the documents (id, lang, source, text): in how many they are, in which, and how often per source.

    ``docs`` is NULL where there are ``least_docs`` or more.
    """
    pieces = pc.ascii_split_whitespace(batch["text"])
    sizes = np.diff(pieces.offsets.to_numpy())
    coded = pc.dictionary_encode(pieces.flatten())
    langs, sources = pc.dictionary_encode(batch["lang"]), pc.dictionary_encode(batch["source"])
    width = max(1, len(coded.dictionary))
    # Every document's chunks, counted.
    doc = np.repeat(np.arange(len(batch), dtype=np.int64), sizes)
    pairs, times = np.unique(doc * width + coded.indices.to_numpy(), return_counts=True)
    doc, code = pairs // width, pairs % width
    lang, source = langs.indices.to_numpy()[doc].astype(np.int64), sources.indices.to_numpy()[doc].astype(np.int64)

    # The same by language and chunk, and within these by source.
    order = np.lexsort((source, code, lang))
    key, doc, source, times = (lang * width + code)[order], doc[order], source[order], times[order]
    starts = _runs(key)
    df = np.diff(np.append(starts, len(key)))
    few = df < least_docs
    named = np.repeat(few, df)
    docs = pa.ListArray.from_arrays(
        np.concatenate([[0], np.cumsum(np.where(few, df, 0))]).astype(np.int32),
        pa.array(batch["id"].to_numpy()[doc[named]]),
        mask=pa.array(~few),
    )
    uses = _runs(key * max(1, len(sources.dictionary)) + source)
    counts = np.add.reduceat(times, uses) if len(uses) else np.zeros(0, np.int64)
    entries = pa.StructArray.from_arrays(
        [sources.dictionary.take(pa.array(source[uses])), pa.array(counts.astype(np.int64))], ["source", "n"]
    )
    bounds = np.append(np.searchsorted(uses, starts), len(uses)).astype(np.int32)
    columns = [
        langs.dictionary.take(pa.array(key[starts] // width)),
        coded.dictionary.take(pa.array(key[starts] % width)),
        pa.array(df.astype(np.int64)),
        docs,
        pa.ListArray.from_arrays(bounds, entries),
    ]
    return pa.RecordBatch.from_arrays(
        [column.cast(kind) for column, kind in zip(columns, _COUNTS.types, strict=True)], schema=_COUNTS
    )


def chunk_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """COUNTS of all documents, a row per slice of them, language and chunk. On shared disk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", settings.slice_bytes):
                counted = count_chunks(part, settings.least_docs)
                for at in range(0, len(counted), 1 << 15):
                    yield counted.slice(at, 1 << 15)

    numbered = docs.select(F.monotonically_increasing_id().alias("id"), "lang", "source", "text")
    return keep_on_disk(numbered.mapInArrow(count, COUNTS), "chunk-counts", compression="zstd")


def terms_of(chunk: Column) -> Column:
    """The distinct terms of a chunk with how often each is in it; only A-Z are lower-cased."""
    found = F.regexp_extract_all(F.translate(chunk, UPPER, LOWER), F.lit(f"({TERM})"))
    once = F.array_distinct(found)
    return F.transform(
        once, lambda term: F.struct(term.alias("term"), F.size(F.filter(found, lambda t: t == term)).cast("long").alias("times"))
    )


def kept_chunks(counts: DataFrame, settings: Settings) -> DataFrame:
    """(lang, chunk, term, times) for the terms of each language that are in enough of its documents. On shared disk."""
    per_chunk = keep_on_disk(counts.groupBy("lang", "chunk").agg(F.sum("df").alias("df")), "chunks")
    # Equal chunks of several languages share one row, so that each is taken apart once.
    distinct = per_chunk.select("chunk").distinct().select("chunk", F.inline(terms_of(F.col("chunk"))))
    parts = keep_on_disk(per_chunk.join(distinct, "chunk"), "chunk-terms", compression="zstd")
    empty(per_chunk)
    bounds = parts.groupBy("lang", "term").agg(F.max("df").alias("least"), F.sum("df").alias("most"))
    alive = keep_on_disk(bounds.where(F.col("most") >= settings.least_docs), "terms")
    sure = alive.where(F.col("least") >= settings.least_docs).select("lang", "term")

    # Terms of several rare chunks, which may share documents: fewer than ``least_docs`` for each chunk.
    open_terms = alive.where(F.col("least") < settings.least_docs).select("lang", "term")
    rare = parts.join(open_terms, ["lang", "term"]).select("lang", "chunk", "term")
    # Hints: the counts are many times the chunks they meet, and sorting them is most of the work.
    listed = counts.where(F.col("docs").isNotNull()).select("lang", "chunk", "docs")
    places = listed.join(rare.hint("shuffle_hash"), ["lang", "chunk"])
    found = places.select("lang", "term", F.explode("docs").alias("doc")).groupBy("lang", "term")
    counted = found.agg(F.count_distinct("doc").alias("df")).where(F.col("df") >= settings.least_docs)
    kept = sure.unionByName(counted.select("lang", "term"))
    chunks = parts.join(kept, ["lang", "term"]).select("lang", "chunk", "term", "times")
    chunks = keep_on_disk(chunks, "kept-chunks", compression="zstd")
    empty(parts, alive)
    return chunks


def term_counts(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n): how often kept terms occur in each group, where they do. On shared disk."""
    uses = counts.select("lang", "chunk", "uses").join(kept.hint("shuffle_hash"), ["lang", "chunk"])
    each = uses.select("lang", "term", "times", F.inline("uses"))
    return keep_on_disk(each.groupBy("lang", "source", "term").agg(F.sum(F.col("n") * F.col("times")).alias("n")), "term-counts")


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in parts of 10^9, in whole numbers: 1 + floor(10^9 (count + 2) / (total + 2 terms))."""
    whole = "decimal(38,0)"
    above = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = F.greatest(total + 2 * terms, F.lit(1)).cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", above.cast(whole), below)).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _numbered(groups: DataFrame, lang_totals: DataFrame, settings: Settings) -> DataFrame:
    """The groups with a number within their language, and what comparing them takes."""
    by_source = Window.partitionBy("lang").orderBy("source")
    return groups.join(lang_totals.select("lang", "v"), "lang", "left").select(
        "lang",
        "source",
        (F.row_number().over(by_source) - 1).alias("number"),
        F.coalesce("v", F.lit(0)).alias("v"),
        F.coalesce("total", F.lit(0)).alias("total"),
        F.greatest(F.ceil(F.coalesce("v", F.lit(0)) / settings.terms), F.lit(1)).alias("blocks"),
    )


def pair_values(counts: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """(lang, a, b, value) for pairs of sources of a language: the gaps of all kept terms, added up.

    The shares are a matrix of sources by terms, most of it filled. It is cut into tiles, and each
    task takes the tiles of two ranges of sources and one block of terms and gives one number per pair;
    what is in neither of two sources is the same for each term and multiplied.
    """
    tile = (F.col("number") / settings.sources).cast("int")
    tiles = F.ceil(F.col("sources") / settings.sources).cast("int")
    sized = groups.withColumn("sources", F.count("*").over(Window.partitionBy("lang"))).withColumns(
        {"tile": tile, "tiles": tiles, "absent": F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(0)}
    )
    sized = keep_on_disk(sized, "groups")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    some = counts.join(sized, ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", "absent", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), block.alias("block")
    )
    # One row without term for each block, so that a source without its terms takes part.
    empty = sized.select(
        "lang", "source", "tile", "tiles", "absent", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"),
        F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    rows = some.unionByName(empty).select("*", other)
    rows = rows.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    keys = ["lang", "block", "low", "high"]
    summed = rows.groupBy(*keys).applyInPandas(
        _tile, "lang string, a string, b string, value bigint, seen bigint, absent_a bigint, absent_b bigint"
    )
    total = summed.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.first("absent_a").alias("p"), F.first("absent_b").alias("q")
    )
    neither = F.when(F.col("p") + F.col("q") > 0, gap(F.col("p"), F.col("q"))).otherwise(0)
    size = groups.groupBy("lang").agg(F.max("v").alias("v"))
    return total.join(size, "lang").select(
        "lang", "a", "b", (F.col("value") + (F.col("v") - F.col("seen")) * neither).cast("long").alias("value")
    )


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    lang, low, high = rows["lang"].iat[0], rows["low"].iat[0], rows["high"].iat[0]
    marks = rows[rows["term"].isna()].sort_values("source")
    cells = rows[rows["term"].notna()]
    term, terms = pd.factorize(cells["term"])
    p = np.repeat(marks["absent"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    p[np.searchsorted(marks["source"].to_numpy(), cells["source"].to_numpy()), term] = cells["p"].to_numpy(np.int64)
    names, absent, tile = (marks[c].to_numpy() for c in ("source", "absent", "tile"))
    left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    out = []
    for i in left:
        others = right[right > i] if low == high else right
        if len(others):
            d, s = p[others] - p[i], np.maximum(p[others] + p[i], 1)
            out.append(
                pd.DataFrame(
                    {
                        "lang": lang, "a": names[i], "b": names[others], "value": (d * d // s).sum(axis=1),
                        "seen": len(terms), "absent_a": absent[i], "absent_b": absent[others],
                    }
                )
            )
    columns = ["lang", "a", "b", "value", "seen", "absent_a", "absent_b"]
    return pd.concat(out) if out else pd.DataFrame(columns=columns)


def source_divergence(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", settings: Settings = Settings()
) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    Part ``pair``: every other source of the language with the sum, over the language's kept terms, of
    floor((p - q)^2 / (p + q)) for the two smoothed shares p and q in parts of 10^9; largest first.
    Part ``term``: the ``settings.top`` terms of the source that it uses more than the language does,
    by the same gap. Ties go to the smaller item in UTF-8 order.

    NULL text, lang and source count as empty ones. Every row is a document, repeated rows too. A
    source without any kept term takes part with the share of a term it lacks; where a language keeps no
    term, its pairs have the value 0. An empty table gives no rows. Texts are worked through whole,
    ``settings.slice_bytes`` at a time, a longer one by itself. Other columns play no part.

    Counts come together in map tasks before they are shuffled; no task holds all of a source, a
    language or a term's documents.
    """
    clean = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    counts = chunk_counts(clean, settings)
    kept = kept_chunks(counts, settings)
    found = term_counts(counts, kept)
    empty(counts, kept)
    in_lang = keep_on_disk(found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "lang-terms")
    lang_totals = in_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = clean.groupBy("lang", "source").agg(F.count("*").alias("docs")).join(totals, ["lang", "source"], "left")
    groups = keep_on_disk(_numbered(groups, lang_totals, settings), "numbered")

    pairs = pair_values(found, groups, settings)
    both = pairs.select(
        "lang",
        F.inline(
            F.array(
                F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
            )
        ),
        "value",
    )
    return _ranked(both, "pair", None).unionByName(_ranked(_typical(found, in_lang, lang_totals, groups), "term", settings.top))


def _typical(found: DataFrame, in_lang: DataFrame, lang_totals: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms that a source uses more than its language."""
    shared = in_lang.join(lang_totals, "lang").select(
        "lang", "term", share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")
    )
    own = found.join(groups.select("lang", "source", "total", "v"), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p")
    )
    more = own.join(shared, ["lang", "term"]).where("p > q")
    return more.select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked if top is None else ranked.where(F.col("rank") <= top)
