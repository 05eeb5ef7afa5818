"""Arrow batches to Python stay small in bytes where rows bring whole texts."""

from collections.abc import Iterator

import pyarrow as pa

from refinery.llm import jaccard
from refinery.llm.common import ARROW_BYTES, arrow_bytes

WORDS = " ".join(f"w{k}" for k in range(40_000))


def _largest_batch(frame) -> int:
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    return max(r["rows"] for r in frame.coalesce(1).mapInArrow(sizes, "rows long").collect())


def test_batches_of_long_texts_are_small(spark):
    docs = spark.createDataFrame([(k, WORDS) for k in range(20)], "doc_id long, text string")
    assert _largest_batch(docs) == 20
    with arrow_bytes(spark, 1 << 20):
        assert _largest_batch(docs) <= 4


def test_near_copies_of_long_texts_keep_the_session(spark):
    before = spark.conf.get(ARROW_BYTES, None)
    rows = [(k, WORDS + f" tail{k}") for k in range(12)] + [(99, "something else entirely")]
    out = dict(jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert {out[k] for k in range(12)} == {0} and out[99] == 99
    assert spark.conf.get(ARROW_BYTES, None) == before
