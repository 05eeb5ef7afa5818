"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and so have a few pairs of features. The
tables are learned by cyclic boosting: round by round, feature by feature, a shallow tree is fitted
to the gradient and its leaves are added to the table, a little at a time. A score is the sum of
one table entry per feature and pair, so scoring is an addition of looked-up columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations
from operator import eq, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import free_name

FEATURES = (
    "log_words",
    "word_bytes",
    "distinct_words",
    "repeated_neighbours",
    "letters",
    "upper_case",
    "digits",
    "stops",
    "symbols",
    "lines",
    "repeated_lines",
    "byte_entropy",
    "lone_symbols",
    "symbol_ends",
)
_byte = np.arange(256)
_upper, _lower = (_byte >= 65) & (_byte <= 90), (_byte >= 97) & (_byte <= 122)
_digit, _stop = (_byte >= 48) & (_byte <= 57), np.isin(_byte, list(b".,;:?!'\"()-"))
_letter = _upper | _lower | (_byte >= 128)
_symbol = ~(_letter | _digit | _stop) & (_byte > 32)
_last = itemgetter(-1)
_ALPHANUMERIC_END = frozenset(np.flatnonzero(_letter | _digit | _stop).tolist())


def features_of(text: str) -> tuple[float, ...]:
    """Numbers in the order of FEATURES; all zero for a text without words."""
    data = text.encode()
    words = data.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts[counts > 0] / len(data)
    visible = int(counts[33:].sum()) or 1
    latin = int(counts[_upper].sum() + counts[_lower].sum()) or 1
    lines = [line for line in data.split(b"\n") if line]
    return (
        float(np.log1p(n)),
        visible / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        counts[_letter].sum() / visible,
        counts[_upper].sum() / latin,
        counts[_digit].sum() / visible,
        counts[_stop].sum() / visible,
        counts[_symbol].sum() / visible,
        len(lines) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(-(shares * np.log2(shares)).sum()),
        sum(len(word) == 1 for word in words) / n,
        sum(map(eq, words, [b"|"] * n)) / n
        + sum(last not in _ALPHANUMERIC_END for last in map(_last, words)) / n,
    )


@dataclass(frozen=True)
class Settings:
    """``sample``: how many labelled rows are fitted at most; they pass through the driver as features only."""

    sample: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 8
    rounds: int = 300
    pair_rounds: int = 100
    rate: float = 0.1
    smoothing: float = 5.0


def quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(gradient: np.ndarray, weight: np.ndarray, smoothing: float) -> np.ndarray:
    return gradient * gradient / (weight + smoothing)


def interval_tree(gradient: np.ndarray, weight: np.ndarray, smoothing: float, depth: int = 2) -> np.ndarray:
    """Leaf values, per bin, of the tree of this depth that cuts the bins into intervals greedily."""
    total, mass = gradient.sum(), weight.sum()
    leaf = np.full(len(gradient), total / (mass + smoothing))
    if depth == 0 or len(gradient) < 2:
        return leaf
    g, w = gradient.cumsum()[:-1], weight.cumsum()[:-1]
    gains = _gain(g, w, smoothing) + _gain(total - g, mass - w, smoothing)
    cut = int(gains.argmax()) + 1
    if gains[cut - 1] <= _gain(total, mass, smoothing) + 1e-9:
        return leaf
    sides = (slice(None, cut), slice(cut, None))
    return np.concatenate([interval_tree(gradient[s], weight[s], smoothing, depth - 1) for s in sides])


def quadrant_tree(gradient: np.ndarray, weight: np.ndarray, smoothing: float) -> tuple[np.ndarray, float]:
    """Leaf values of the best cut of a table into four quadrants, and its gain."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    total, mass = g[-1, -1], w[-1, -1]
    corners = [
        (g[:-1, :-1], w[:-1, :-1]),
        (g[:-1, -1:] - g[:-1, :-1], w[:-1, -1:] - w[:-1, :-1]),
        (g[-1:, :-1] - g[:-1, :-1], w[-1:, :-1] - w[:-1, :-1]),
    ]
    corners.append((total - sum(c[0] for c in corners), mass - sum(c[1] for c in corners)))
    if not corners[0][0].size:
        return np.zeros_like(gradient), 0.0
    gains = sum(_gain(*corner, smoothing) for corner in corners)
    a, b = np.unravel_index(int(gains.argmax()), gains.shape)
    leaves = [corner[0][a, b] / (corner[1][a, b] + smoothing) for corner in corners]
    table = np.empty_like(gradient)
    table[: a + 1, : b + 1], table[: a + 1, b + 1 :], table[a + 1 :, : b + 1], table[a + 1 :, b + 1 :] = leaves
    return table, float(gains[a, b] - _gain(total, mass, smoothing))


@dataclass(frozen=True)
class Model:
    intercept: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pair_edges: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for column, edges, table in zip(x.T, self.edges, self.tables, strict=True):
            total += table[np.searchsorted(edges, column, side="right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.pair_edges[i], x[:, i], side="right")
            total += table[a, np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Model:
    """Learns the tables. Without rows every score is one half; with one label only, near that label."""
    width = x.shape[1]
    edges = tuple(quantile_edges(column, settings.bins) if len(x) else np.empty(0) for column in x.T)
    coarse = tuple(quantile_edges(column, settings.pair_bins) if len(x) else np.empty(0) for column in x.T)
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = (y.sum() + 0.5) / (len(y) + 1)
    margin = np.full(len(y), np.log(share / (1 - share)))
    intercept = float(np.log(share / (1 - share)))
    if not len(x):
        return Model(intercept, edges, tuple(tables), coarse, ())

    def slope(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)

    fine_bins = [np.searchsorted(e, column, side="right") for e, column in zip(edges, x.T, strict=True)]
    for _ in range(settings.rounds):
        for f in range(width):
            gradient, weight = slope(margin)
            sums = [np.bincount(fine_bins[f], v, len(tables[f])) for v in (gradient, weight)]
            step = settings.rate * interval_tree(*sums, settings.smoothing)
            tables[f] += step
            margin += step[fine_bins[f]]

    bins = [np.searchsorted(e, column, side="right") for e, column in zip(coarse, x.T, strict=True)]
    sizes = [len(e) + 1 for e in coarse]

    def sums_of(i: int, j: int) -> list[np.ndarray]:
        cell = bins[i] * sizes[j] + bins[j]
        return [np.bincount(cell, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in slope(margin)]

    gains = {(i, j): quadrant_tree(*sums_of(i, j), settings.smoothing)[1] for i, j in combinations(range(width), 2)}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[: settings.pairs]
    pair_tables = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in chosen}
    for _ in range(settings.pair_rounds):
        for i, j in chosen:
            step = settings.rate * quadrant_tree(*sums_of(i, j), settings.smoothing)[0]
            pair_tables[i, j] += step
            margin += step[bins[i], bins[j]]
    return Model(intercept, edges, tuple(tables), coarse, tuple((i, j, t) for (i, j), t in pair_tables.items()))


def feature_rows(texts: Sequence[str | None]) -> np.ndarray:
    return np.array([features_of(text or "") for text in texts], dtype=float).reshape(-1, len(FEATURES))


def features(text: Column) -> Column:
    def batch(texts: pa.Array) -> pa.Array:
        rows = feature_rows(texts.to_pylist())
        return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES), rows.ravel())

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "array<double>")(text)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is a multiple of ``folds``. False without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: Settings = Settings(),
) -> Model:
    """Fits the model to labelled rows that are not held out, ``settings.sample`` of them at most.

    Which rows, if there are more, is settled by a hash of their ids. Only their ids (bounded by
    the setting, so they are broadcast) and their features travel. Rows with a NULL id or label
    are not used; a repeated label row counts once.
    """
    known = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
    chosen = (
        known.where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(settings.sample)
    )
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", features(F.col("_text")).alias("_x"))
    rows = joined.orderBy(F.xxhash64("_id"), "_id", "_label", "_x").limit(settings.sample).collect()
    x = np.array([row["_x"] for row in rows], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([row["_label"] for row in rows], dtype=float), settings)


def quality(text: Column, model: Model) -> Column:
    """The model's probability of label 1 for a text; NULL counts as empty."""

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(feature_rows(texts.to_pylist())), pa.float64())

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "double")(text)


def with_quality(docs: DataFrame, model: Model, *, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as column ``into``, which replaces one of that name.

    Nothing is shuffled. NULL and empty texts get the score of a text without words; repeated
    rows each get the same score.
    """
    return docs.withColumn(into, quality(docs[text], model))


def accepted(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose score is ``threshold`` or more, with their columns as they were."""
    name = free_name(docs, "_score")
    return with_quality(docs, model, text=text, into=name).where(F.col(name) >= threshold).drop(name)
