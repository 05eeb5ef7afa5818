"""Ids are made once per text, and decoded from the column, not by encoding the text again."""

from refinery.llm import bpe
from refinery.llm.queries import PATTERN, RANKS


def _python_steps(frame) -> list[str]:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "ArrowEvalPython" in line]


def test_decoding_does_not_encode_again(spark):
    docs = spark.createDataFrame([(1, "Hello world, twice."), (2, None), (3, "")], "doc_id long, text string")
    coded = bpe.with_ids(docs, RANKS, PATTERN)
    frame = bpe.with_decoded(coded, RANKS, PATTERN)
    steps = _python_steps(frame)
    # One step encodes the texts and one decodes the ids; none runs a function on another's result in itself.
    assert len(steps) == 2
    assert not any("batch(batch(" in step for step in steps)
    rows = {r["doc_id"]: bytes(r["decoded"]) for r in frame.collect()}
    assert rows == {1: b"Hello world, twice.", 2: b"", 3: b""}
