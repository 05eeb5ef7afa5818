"""Operators: frames in, frames out."""

from refinery.operators.aggregate import bucket_columns, bucket_pivot, count_children, line_sum, rollup_lines
from refinery.operators.ancestry import ancestry
from refinery.operators.deltas import additive_rollup, apply_deltas, rollup_deltas
from refinery.operators.differences import apply_difference, snapshot_difference
from refinery.operators.hierarchy import flatten_tree
from refinery.operators.history import merge_history, rewritten_history
from refinery.operators.incremental import incremental, next_watermark, scd2, upsert
from refinery.operators.latest import latest_per_key
from refinery.operators.nested import explode_children
from refinery.operators.project import project, recent, rekey, require, stamp, with_context
from refinery.operators.references import Relation, orphan_report, orphan_rows, orphans
from refinery.operators.relate import has_children, lookup_join, with_parent
from refinery.operators.setops import align, distinct_rows, union_all, union_distinct

__all__ = [
    "Relation",
    "additive_rollup",
    "align",
    "ancestry",
    "apply_deltas",
    "apply_difference",
    "bucket_columns",
    "bucket_pivot",
    "count_children",
    "distinct_rows",
    "explode_children",
    "flatten_tree",
    "has_children",
    "incremental",
    "latest_per_key",
    "line_sum",
    "lookup_join",
    "merge_history",
    "next_watermark",
    "orphan_report",
    "orphan_rows",
    "orphans",
    "project",
    "recent",
    "rekey",
    "require",
    "rewritten_history",
    "rollup_deltas",
    "rollup_lines",
    "scd2",
    "snapshot_difference",
    "stamp",
    "union_all",
    "union_distinct",
    "upsert",
    "with_context",
    "with_parent",
]
