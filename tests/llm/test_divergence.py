"""The divergence audit against plain counting over a small, hostile table."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from refinery.llm import divergence

rnd = random.Random(3)
WORDS = ["the", "The,", "the-the", "THE", "été", "Été", "é t", "x1y", "42", "_", "zoo", "Zoo.", "zoo;", "a's", "ß", "naïve", "no no", "\tq\n"]
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def table():
    rows = []
    for k in range(160):
        lang, source = rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", "s4", "s5", "", None, "é"])
        rows.append((k, " ".join(rnd.choices(WORDS, k=rnd.randint(0, 12))), lang, source))
    # Each chunk is in fewer documents than it takes, their term in just enough, or in one too few.
    for k in range(10):
        rows.append((200 + k, f"Edge{',' * (k % 3)} {'edge.' * (k % 2)}", "en", f"s{k % 4}"))
        rows.append((300 + k, "Under under. UNDER" if k < 9 else "other", "en", f"s{k % 4}"))
    rows += [(400, "word", "xx", "only"), (401, "word", "xx", "two"), (402, None, "yy", "s1"), (403, "", "en", "silent")]
    rows += [(404, "big " * 5000, "en", "s1")] + [(405, "twice the same zoo", "de", "s2")] * 12
    return rows


ROWS = table()


def defined(rows, least, top=10):
    """(lang, source, part, item, value, rank), by the definition."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda item: (-item[1], item[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return Counter(out)


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["term", "chunk", "df", "n", "id", "v", "total", "block", "tile", "part"]
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3)
    return frame.select("*", *(F.lit("own").alias(c) for c in clash))


@pytest.mark.parametrize(
    "settings",
    [
        divergence.Settings(),
        divergence.Settings(slice_bytes=40, sources=2, terms=3),
        divergence.Settings(least_docs=1, sources=3, terms=2, slice_bytes=500),
        divergence.Settings(least_docs=4, top=2, sources=1),
    ],
)
def test_against_the_definition(docs, settings):
    got = divergence.source_divergence(docs, settings=settings)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == defined(ROWS, settings.least_docs, settings.top)


def test_empty_table(docs):
    assert divergence.source_divergence(docs.where("false")).count() == 0


def test_shares_of_very_frequent_terms(spark):
    counts = [(0, 0, 1), (1, 1, 1), (5 * 10**9, 6 * 10**9, 3), (10**15, 10**16, 10**6)]
    got = spark.createDataFrame(counts, "n long, total long, v long").select(
        "n", "total", "v", divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")
    )
    assert {tuple(r) for r in got.collect()} == {(n, t, v, 1 + 10**9 * (n + 2) // (t + 2 * v)) for n, t, v in counts}
