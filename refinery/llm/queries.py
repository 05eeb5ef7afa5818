"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import (
    bpe,
    decontaminate,
    divergence,
    fill_middle,
    jaccard,
    language_model,
    licenses,
    private,
    quality,
    repeats,
    secrets,
    topk,
    toxicity,
)
from refinery.llm.common import base_spans, count_kind, join_spans

Run = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _span_digests(spans: str, kinds: list[str]) -> list:
    base = base_spans(F.col(spans))
    return [
        "doc_id",
        *(count_kind(F.col(spans), kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(join_spans(base).cast("binary"), 256).alias("base_sha256"),
        join_spans(F.col(spans)).alias("spans"),
    ]


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.with_secrets(docs).drop("text")
    return found.select(*_span_digests("secrets", ["assign", "access", "hex"]))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.with_licenses(docs).select("doc_id", "licenses.n_words", "licenses.hits")
    base = F.filter("hits", lambda h: h["base"])
    places = F.transform(base, lambda h: h["word"])

    def names(hits) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["containment"])), F.lit(0.0)).alias("score"),
    )


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_inner_products(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op4_private_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = private.with_private_data(docs).drop("text")
    return found.select(*_span_digests("private", ["email", "ip", "card", "phone"]))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents").select("doc_id", "text"))


def _mean_scores(spark: SparkSession, folder: str, settings: language_model.Settings) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = language_model.with_backoff_scores(docs, settings=settings).drop("text")
    mean = F.col("lm.log_score") / F.greatest(F.col("lm.words"), F.lit(1))
    return scored.select("doc_id", F.col("lm.words").alias("n_words"), F.round(mean, 6).alias("mean_log_score"))


def op6_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _mean_scores(spark, folder, language_model.Settings())


def op6_backoff_scores_trigrams(spark: SparkSession, folder: str) -> DataFrame:
    return _mean_scores(spark, folder, language_model.Settings(order=3))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.with_ids(docs, RANKS, PATTERN).drop("text")
    return bpe.with_decoded(coded, RANKS, PATTERN).select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_repeated_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_paragraphs(table(spark, folder, "documents").select("doc_id", "text"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.with_quality(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, folder, "benchmark"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.with_toxicity(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Run] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_topk_search": op3_topk_search,
    "op4_private_data": op4_private_data,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_backoff_scores": op6_backoff_scores,
    "op6_backoff_scores_trigrams": op6_backoff_scores_trigrams,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_repeated_paragraphs": op8_repeated_paragraphs,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "op11_fill_middle": op11_fill_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_toxicity": op13_toxicity,
}

# The scores are whole numbers far below 2^53, so the double sums are exact.
OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
) WHERE rank <= 10
"""

OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (
  SELECT doc_id, i, words[i] AS word, CASE WHEN i > 1 THEN words[i - 1] END AS before
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)
), one AS (SELECT word, count(*) AS n FROM t GROUP BY word),
own_one AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY doc_id, word),
two AS (SELECT before, word, count(*) AS n FROM t WHERE before IS NOT NULL GROUP BY before, word),
own_two AS (SELECT doc_id, before, word, count(*) AS n FROM t WHERE before IS NOT NULL GROUP BY doc_id, before, word),
all_words AS (SELECT count(*) AS n FROM t), own_words AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (
  SELECT t.doc_id, t.i, t.before,
    one.n - own_one.n AS left_one, two.n - own_two.n AS left_two, c.n - own_c.n AS left_before, all_words.n - own_words.n AS rest
  FROM t JOIN one USING (word) JOIN own_one USING (doc_id, word) JOIN own_words USING (doc_id) CROSS JOIN all_words
  LEFT JOIN two ON two.before = t.before AND two.word = t.word
  LEFT JOIN own_two ON own_two.doc_id = t.doc_id AND own_two.before = t.before AND own_two.word = t.word
  LEFT JOIN one c ON c.word = t.before
  LEFT JOIN own_one own_c ON own_c.doc_id = t.doc_id AND own_c.word = t.before
), v AS (
  SELECT doc_id, CASE
    WHEN before IS NOT NULL AND left_two > 0 THEN left_two::DOUBLE / left_before
    ELSE (CASE WHEN before IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END)
       * (CASE WHEN left_one > 0 THEN left_one::DOUBLE / rest ELSE 1.0::DOUBLE / (rest + 1) END) END AS value
  FROM s
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, round(coalesce(x.total, 0) / greatest(len(w.words), 1), 6) AS mean_log_score
FROM w LEFT JOIN (SELECT doc_id, sum(ln(value)) AS total FROM v GROUP BY doc_id) x USING (doc_id)
"""

OP6_TRIGRAMS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (
  SELECT doc_id, i, words[i] AS c, CASE WHEN i > 1 THEN words[i - 1] END AS b, CASE WHEN i > 2 THEN words[i - 2] END AS a
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)
), own_one AS (SELECT doc_id, c, count(*) AS n FROM t GROUP BY ALL),
own_two AS (SELECT doc_id, b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY ALL),
own_three AS (SELECT doc_id, a, b, c, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY ALL),
one AS (SELECT doc_id, c, sum(n) OVER (PARTITION BY c) - n AS n FROM own_one),
two AS (SELECT doc_id, b, c, sum(n) OVER (PARTITION BY b, c) - n AS n FROM own_two),
three AS (SELECT doc_id, a, b, c, sum(n) OVER (PARTITION BY a, b, c) - n AS n FROM own_three),
all_words AS (SELECT count(*) AS n FROM t), own_words AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
v AS (
  SELECT t.doc_id, CASE
    WHEN three.n > 0 THEN three.n::DOUBLE / two_before.n
    ELSE (CASE WHEN t.a IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END) * (CASE
      WHEN two.n > 0 THEN two.n::DOUBLE / one_before.n
      ELSE (CASE WHEN t.b IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END)
         * (CASE WHEN one.n > 0 THEN one.n::DOUBLE / (all_words.n - own_words.n)
            ELSE 1.0::DOUBLE / (all_words.n - own_words.n + 1) END) END) END AS value
  FROM t JOIN own_words USING (doc_id) CROSS JOIN all_words
  JOIN one ON one.doc_id = t.doc_id AND one.c = t.c
  LEFT JOIN one one_before ON one_before.doc_id = t.doc_id AND one_before.c = t.b
  LEFT JOIN two ON two.doc_id = t.doc_id AND two.b = t.b AND two.c = t.c
  LEFT JOIN two two_before ON two_before.doc_id = t.doc_id AND two_before.b = t.a AND two_before.c = t.b
  LEFT JOIN three ON three.doc_id = t.doc_id AND three.a = t.a AND three.b = t.b AND three.c = t.c
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, round(coalesce(x.total, 0) / greatest(len(w.words), 1), 6) AS mean_log_score
FROM w LEFT JOIN (SELECT doc_id, sum(ln(value)) AS total FROM v GROUP BY doc_id) x USING (doc_id)
"""

# p and q stay below 2^31 and their sums below 2^63; only counts times 10^9 need more than 64 bits.
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
g AS (
  SELECT groups.lang, groups.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM groups LEFT JOIN size USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v))::BIGINT AS p
  FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v))::BIGINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN size USING (lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked
) WHERE part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_topk_search": OP3_SQL,
    "op6_backoff_scores": OP6_SQL,
    "op6_backoff_scores_trigrams": OP6_TRIGRAMS_SQL,
    "op12_source_divergence": OP12_SQL,
}
