"""The lexicon's folding, matching and learning, and how well held-out labels are told."""

import math
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from refinery.llm import quality, toxicity
from refinery.llm.queries import QUERIES, table
from refinery.llm.toxicity import Model, Term, find, fold, hits_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODEL = Model((Term("idiot", 4.0), Term("idiot*", 3.0), Term("scum*", 2.0), Term("été", 1.0), Term("loser", 2.5), Term("trash", 2.0)))


def found(text, model=MODEL):
    out = find(text, model, model.matcher())
    return [(text[h["start"] : h["end"]], h["term"]) for h in out["hits"]]


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("You IDIOT!", [("IDIOT", "idiot")]),
        ("idiots, idiotic", [("idiots", "idiot*"), ("idiotic", "idiot*")]),
        ("idiot idiot\nidiot", [("idiot", "idiot")] * 3),
        ("an 1d10t and a l0s3r", [("1d10t", "idiot"), ("l0s3r", "loser")]),
        ("1oser or !diot, id!ot", [("1oser", "loser"), ("id!ot", "idiot")]),
        ("$cum and s¢um", []),
        ("іdіоt", [("іdіоt", "idiot")]),
        ("“ｉｄｉｏｔ”—𝐢𝐝𝐢𝐨𝐭", [("ｉｄｉｏｔ", "idiot"), ("𝐢𝐝𝐢𝐨𝐭", "idiot")]),
        ("😀 id​i­ot é idiot", [("id​i­ot", "idiot"), ("idiot", "idiot")]),
        ("ÉTÉ été étés", [("ÉTÉ", "été"), ("été", "été")]),
        ("videoidiot, antiscum, 2024 10 5", []),
        ("scum2 scumbag", [("scum", "scum*"), ("scumbag", "scum*")]),
        ("take the Trash can; trash", [("trash", "trash")]),
        ("trash cannot, trash  can", [("Trash".lower(), "trash"), ("trash", "trash")]),
        ("108.51.216.133 to idiot's", [("idiot", "idiot")]),
        ("", []),
        ("   ", []),
    ],
)
def test_hits(text, hits):
    assert found(text) == hits


def test_folding_keeps_places():
    rnd = random.Random(5)
    for _ in range(500):
        text = "".join(rnd.choices(["a", "É", "ß", "İ", "і", "😀", "​", "0", "1", "@", " ", "-", "́", "ﬁ"], k=rnd.randint(0, 15)))
        folded = fold(text)
        assert len({len(reading) for reading in folded.readings}) == 1
        for at, byte in enumerate(folded.readings[0]):
            if byte != 0x20 and byte & 0xC0 != 0x80:
                assert 0 <= folded.char(at) < len(text)
        # Characters that are left are as many as those of the source without the dropped ones.
        left = sum(byte & 0xC0 != 0x80 for byte in folded.readings[0])
        assert left == (len(text) if folded.kept is None else len(folded.kept) - 1)


def test_longest_entry_counts_and_plain_search_agrees():
    rnd = random.Random(6)
    terms = {"".join(rnd.choices("ab", k=rnd.randint(1, 4))) + rnd.choice(["", "*"]) for _ in range(12)}
    model = Model(tuple(Term(t, 1.0) for t in sorted(terms)), exceptions=())
    matcher = model.matcher()
    for _ in range(300):
        words = ["".join(rnd.choices("abc", k=rnd.randint(1, 6))) for _ in range(rnd.randint(0, 8))]
        want = []
        for word in words:
            fits = [t for t in terms if (word.startswith(t[:-1]) if t.endswith("*") else word == t)]
            if fits:
                want.append(max(fits, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"))))
        assert [model.terms[n].text for _, _, n in hits_of(fold(" ".join(words)), matcher)] == want


def test_score_grows_with_density_and_not_with_length():
    matcher = MODEL.matcher()
    few, many = "good words " * 500 + "idiot", "idiot scum " * 5
    assert find("good words", MODEL, matcher)["score"] < 0.05
    assert find(few, MODEL, matcher)["score"] < 0.5 < find(many, MODEL, matcher)["score"]


def test_chosen_terms():
    counts = {"low*": (30, 0), "lowe*": (30, 0), "lowea": (14, 0), "the": (30, 300), "pat*": (20, 90), "pathetic": (15, 0), "rare": (2, 0)}
    terms = {t.text: t for t in toxicity.chosen_terms(counts, 40, 400, toxicity.Settings())}
    assert {"lowe*", "pathetic"} <= terms.keys() and not {"low*", "the", "pat*", "rare"} & terms.keys()
    assert terms["stupid*"].weight == toxicity.Settings().unseen
    assert math.isclose(terms["pathetic"].weight, toxicity.log_odds(15, 0, 40.5 / 441, 2.0))


def test_curve_against_a_grid():
    x = toxicity.np.array([[0.0, 0.1], [0.5, 0.2], [1.0, 0.0], [1.5, 0.3], [2.0, 0.1], [0.2, 0.0]])
    y = toxicity.np.array([0, 0, 1, 1, 1, 1.0])

    def loss(c):
        p = 1 / (1 + toxicity.np.exp(-(c[0] + x @ toxicity.np.array(c[1:]))))
        return -(y * toxicity.np.log(p) + (1 - y) * toxicity.np.log(1 - p)).sum() + 0.005 * sum(v * v for v in c[1:])

    best = toxicity.fit_curve(x, y)
    assert all(v >= 0 for v in best[1:])
    for k in range(3):
        for step in (-0.01, 0.01):
            moved = [v + step * (j == k) for j, v in enumerate(best)]
            assert loss(best) <= loss(moved) + 1e-9 or (k and moved[k] < 0)


def test_learns_stems_from_labels(spark):
    rnd = random.Random(8)
    rows = []
    for k in range(400):
        words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(60)]
        if k % 4 == 0:
            for _ in range(4):
                words[rnd.randrange(60)] = "zwux" + "".join(rnd.choices("abcd", k=3))
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    frame = spark.createDataFrame([*rows, (None, "no id", 1), (900, None, 0)], "doc_id long, text string, toxic int")
    frame = frame.select("*", *(F.lit("own").alias(c) for c in ("label", "_id", "alike", "number", "term", "score")))
    model = toxicity.train(frame, frame.select("doc_id", "toxic"))
    assert any(t.text.startswith("zwux") and t.text.endswith("*") for t in model.terms)
    out = toxicity.with_toxicity(frame, model)
    assert out.columns == [*frame.columns, "toxicity"]
    told = out.where("doc_id < 400").select("toxic", (F.col("toxicity.score") >= 0.5).cast("int").alias("p")).collect()
    assert sum(r["toxic"] == r["p"] for r in told) >= 390


def test_odd_tables(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (None, "idiot " * 20), (3, "idiot " * 20_000), (3, "idiot " * 20_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(frame, none)
    assert toxicity.train(frame.where("false"), none) == model
    one_kind = toxicity.train(frame, spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int"))
    assert one_kind.curve == model.curve
    rows = toxicity.with_toxicity(frame, model).select("doc_id", "toxicity.*").collect()
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[1] == scores[2] < 0.05 and scores[None] > 0.9 and scores[3] > 0.9
    assert {len(r["hits"]) for r in rows if r["doc_id"] == 3} == {20_000}
    assert toxicity.with_toxicity(frame.where("false"), model).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_held_out_labels_are_told(spark):
    folder = str(Path(FOLDER).with_name("sf0.01"))
    got = QUERIES["op13_toxicity"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(spark, folder, "labels"), "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert all(r["held_out"] for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.03 * len(rows)
