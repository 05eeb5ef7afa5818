"""Fill-in-middle against its definition, piece by piece and over whole tables."""

import hashlib
import os
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from refinery.llm import fill_middle
from refinery.llm.queries import QUERIES, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def defined(doc_id, text, spm=50):
    """The row of one document, by plain string handling."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = sha("7:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, _, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if h4 % 100 < spm:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), sha(output), sha(text))


def texts():
    rnd = random.Random(11)
    alphabet = ["a", "é", "\n", "\n", "😀", " ", "\r", " "]
    some = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(150)]
    return some + ["", None, "\n", "\n\n", "no line end", "<P>", "a<S>\nb", "a\n<M", "x" * 5000 + "\n" + "y" * 9, "line\n" * 3000]


ROWS = [(k, text) for k, text in enumerate(texts())]
ROWS += [(None, "a\nb\n"), (None, None), (5, "other text\nof id 5"), (6, "twice\nsame\n"), (6, "twice\nsame\n"), (6, "twice\nsame\n")]


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["id", "key", "position", "piece", "form", "n", "copies", "text_"]
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).select("*", *(F.lit("own").alias(c) for c in clash))


@pytest.mark.parametrize("piece_bytes", [1, 7, 64 << 10])
def test_digests(docs, piece_bytes):
    got = fill_middle.digests(docs, settings=fill_middle.Settings(piece_bytes=piece_bytes))
    assert Counter(map(tuple, got.collect())) == Counter(defined(*row) for row in ROWS)


def test_outputs_restore(docs):
    out = fill_middle.transformed(docs, settings=fill_middle.Settings(piece_bytes=5))
    back = out.select("id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"), F.sha2("output", 256)).collect()
    assert Counter((r[0], r[1]) for r in back) == Counter((i, text or "") for i, text in ROWS)
    assert Counter((r[0], r[2]) for r in back) == Counter((r[0], r[5]) for r in (defined(*row) for row in ROWS))


def test_rates(docs):
    one_form = fill_middle.digests(docs, settings=fill_middle.Settings(spm=100))
    assert {r["form"] for r in one_form.collect()} == {"plain", "spm"}
    assert Counter(map(tuple, one_form.collect())) == Counter(defined(*row, spm=100) for row in ROWS)
    none = fill_middle.digests(docs, settings=fill_middle.Settings(rate=0))
    assert {r["form"] for r in none.collect()} == {"plain"}


def test_pieces_end_at_lines():
    made = fill_middle.cut(1, "ab\ncd\nefghij\nk", fill_middle.Settings())
    for most in range(1, 20):
        got = list(fill_middle.pieces_of(made, most))
        assert b"".join((mark or "").encode() + piece for mark, piece in got) == b"".join(
            fill_middle.MARKS[s].encode() + made.data[slice(*made.sections[s])] for s in fill_middle.FORMS[made.form]
        )
        assert all(len(piece) <= most for _, piece in got)
        whole = [piece for _, piece in got if piece.endswith(b"\n") or piece.endswith(b"k")]
        assert most < 7 or len(whole) >= len([piece for _, piece in got if piece])


def test_empty_table(docs):
    assert fill_middle.digests(docs.where("false")).count() == 0
    assert fill_middle.transformed(docs.where("false")).count() == 0


def test_one_shuffle(docs):
    plan = fill_middle.digests(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_query_over_the_whole_table(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    got = QUERIES["op11_fill_middle"](spark, FOLDER)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(defined(*row) for row in rows)
