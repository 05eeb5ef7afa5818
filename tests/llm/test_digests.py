"""Counts and digests of the contract's queries against plain patterns and the tokenizer's own library, over the small tables."""

import hashlib
import os
import re
from pathlib import Path

import numpy as np
import pytest
import tiktoken

from refinery.llm import bpe, quality
from refinery.llm.queries import PATTERN, QUERIES, RANKS, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def number(text):
    return re.sub("[^0-9]", "", text)


SECRETS = {
    "assign": (
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        lambda m: len(m[2]) >= 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}
PRIVATE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(part) <= 255 for part in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(number(m[0])) <= 19 and luhn(number(m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(number(m[0])) <= 15),
}


def base_of(text, kinds):
    found = []
    for place, (kind, (pattern, holds)) in enumerate(kinds.items()):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if holds(m)]
    spans = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))
    counts = [sum(kind == k for _, _, k, _ in found) for kind in kinds]
    return (*counts, hashlib.sha256(spans.encode()).hexdigest()), set(spans.split(",")) - {""}


@tables
@pytest.mark.parametrize(("query", "kinds"), [("op1_secret_scan", SECRETS), ("op4_private_data", PRIVATE)])
def test_base_spans(spark, query, kinds):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}
    rows = QUERIES[query](spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == texts.keys()
    for row in rows:
        want, spans = base_of(texts[row["doc_id"]], kinds)
        assert tuple(row[f"n_{kind}"] for kind in kinds) + (row["base_sha256"],) == want
        assert spans <= set(row["spans"].split(","))


@tables
def test_license_columns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for row in QUERIES["op2_license_scan"](spark, FOLDER).collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (k, label)
            for phrase, label in phrases.items()
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in places]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


@tables
def test_token_digests(spark):
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}
    for row in QUERIES["op7_byte_bpe"](spark, FOLDER).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_scores_are_sums_of_table_entries():
    """Against a loop over rows, tables and bins."""
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(200, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality.fit(x, y, quality.Settings(rounds=5, pair_rounds=5, pairs=3))
    for row, score in zip(x, model.score(x), strict=True):
        total = model.intercept
        for value, edges, entries in zip(row, model.edges, model.tables, strict=True):
            total += entries[sum(edge <= value for edge in edges)]
        for i, j, entries in model.pairs:
            a, b = (sum(edge <= row[f] for edge in model.pair_edges[f]) for f in (i, j))
            total += entries[a, b]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_one_boosting_step_is_the_best_cut():
    """A tree of depth one against trying all cuts."""
    rnd = np.random.default_rng(5)
    for _ in range(50):
        gradient, weight = rnd.normal(size=9), rnd.uniform(0.1, 1, size=9)
        got = quality.interval_tree(gradient, weight, 1.0, depth=1)

        def gain(part, gradient=gradient, weight=weight):
            return gradient[part].sum() ** 2 / (weight[part].sum() + 1.0)

        best = max(range(1, 9), key=lambda cut: gain(slice(None, cut)) + gain(slice(cut, None)))
        if gain(slice(None, best)) + gain(slice(best, None)) > gain(slice(None)) + 1e-9:
            parts = [slice(None, best), slice(best, None)]
        else:
            parts = [slice(None)]
        want = np.concatenate([np.full(len(gradient[p]), gradient[p].sum() / (weight[p].sum() + 1.0)) for p in parts])
        assert np.allclose(got, want)
