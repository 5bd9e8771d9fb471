"""Extremely randomised trees, grown level by level for all trees at once.

Every node draws some features and one threshold for each between the lowest and highest value in the node, and keeps
the one that lowers the Gini impurity most. Draws are an arithmetic hash of (tree, node, feature), so they depend neither on
partitions nor on the engine. A level takes two aggregations over the rows, one for the ranges of the drawn features and
one for the counts beside their thresholds; both serve all trees.

Rows are never exploded or moved: a task holds a block of rows by column, splits it node by node down each tree grown so far, and gives
one row per tree and node. The values of a node are read together, feature by feature, so that ranges and counts are plain loops.
What is shuffled, sent to the driver and broadcast depends on trees, depth and drawn features alone.

Null and NaN values count as ``missing``. A node whose drawn features do not vary, or whose label does not, is a leaf. Of equal
splits the feature that comes first wins. Any label but 1 is negative.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize, ship_package

MODULUS = 2147483647
_FACTOR = 48271
# Values that a task holds at once, 64 MB, and twice that while it turns them.
_BLOCK_VALUES = 1 << 23


def _mixed(v):
    return (v * ((v * v + 7) % MODULUS) + 3) % MODULUS


def draw(seed, tree, node, feature):
    """A whole number below ``MODULUS`` from numbers or arrays; all steps stay within a long."""
    v = _mixed((seed * _FACTOR + tree) % MODULUS)
    v = _mixed((v * _FACTOR + node) % MODULUS)
    return _mixed((v * _FACTOR + feature) % MODULUS)


@dataclass
class Forest:
    """``feature`` and ``threshold`` by tree and node; node 1 is the root, 2n and 2n + 1 the children of n, feature -1 a leaf."""

    columns: list
    feature: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    splits: list = field(default_factory=list)

    def importances(self) -> np.ndarray:
        """Gain shares of the columns, averaged over the trees that split at all."""
        total = np.zeros((len(self.feature), len(self.columns)))
        for tree, node in zip(*np.nonzero(self.feature >= 0)):
            total[tree, self.feature[tree, node]] += self.gain[tree, node]
        sums = total.sum(axis=1)
        return (total[sums > 0] / sums[sums > 0, None]).mean(axis=0) if (sums > 0).any() else np.zeros(len(self.columns))


def drawn_features(seed, trees, nodes, n_columns, per_node) -> np.ndarray:
    """[tree, node, k]: the ``per_node`` features with the smallest draws, in the order of the columns."""
    draws = draw(seed, np.arange(trees)[:, None, None], nodes[None, :, None], np.arange(n_columns)[None, None, :])
    return np.sort(np.argsort(draws, axis=2, kind="stable")[:, :, :per_node], axis=2)


def _at_level(table, first_rows, feature, threshold, level):
    """The nodes of one tree at ``level`` that have rows, with those rows in ascending order. ``table`` holds a column in each row."""
    waiting = [(1, 0, first_rows)]
    while waiting:
        node, depth, rows = waiting.pop()
        if depth == level:
            yield node, rows
        elif feature[node] >= 0:
            right = table[feature[node]].take(rows) > threshold[node]
            for child, side in ((2 * node, rows[~right]), (2 * node + 1, rows[right])):
                if len(side):
                    waiting.append((child, depth + 1, side))


def _lists(table, kind):
    size = table.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * size, pa.int32()), pa.array(table.ravel(), kind))


def _packed_rows(df: DataFrame, columns, label, missing) -> DataFrame:
    """The values of a row as the bytes of its doubles, and the label as 0 or 1; stored. An array would be taken apart value by value in every pass."""
    ship_package(df.sparkSession)
    width = len(columns)
    values = [F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(float(missing))).alias(f"v{i}") for i, c in enumerate(columns)]

    def run(batches):
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]]).astype("<f8")
            packed = pa.Array.from_buffers(pa.binary(8 * width), len(x), [None, pa.py_buffer(x.tobytes())])
            yield pa.record_batch([packed.cast(pa.binary()), batch.column(width)], ["x", "y"])

    labelled = df.select(*values, F.coalesce(F.col(label) == 1, F.lit(False)).cast("bigint").alias("y"))
    return materialize(labelled.mapInArrow(run, "x binary, y bigint"), "rows", compression="zstd")


def _blocks(batches, size):
    """Blocks of a bounded size with a column in each row, the rows of label 1 first, and how many those are."""
    held, rows = [], 0

    def block():
        x = np.concatenate([x for x, _ in held])
        y = np.concatenate([y for _, y in held])
        return np.ascontiguousarray(x[np.argsort(-y, kind="stable")].T), int(y.sum())

    for batch in batches:
        x = np.array([np.frombuffer(v, "<f8") for v in batch.column(0).to_pylist()]).reshape(-1, size)
        held.append((x, batch.column(1).to_numpy(zero_copy_only=False)))
        rows += len(x)
        if rows * size >= _BLOCK_VALUES:
            yield block()
            held, rows = [], 0
    if rows:
        yield block()


def _ranges(data: DataFrame, forest: Forest, drawn, level):
    """[tree, node, k] lowest and highest value of every drawn feature; NaN where a node has no row."""
    size, first, (trees, nodes, per_node) = len(forest.columns), 1 << level, drawn.shape
    shared = data.sparkSession.sparkContext.broadcast((forest.feature, forest.threshold, drawn))

    def run(batches):
        feature, threshold, choice = shared.value
        low, high = np.full(drawn_shape, np.inf), np.full(drawn_shape, -np.inf)
        for table, _ in _blocks(batches, size):
            flat, width = table.ravel(), table.shape[1]
            for tree in range(trees):
                for node, rows in _at_level(table, np.arange(width), feature[tree], threshold[tree], level):
                    slot = tree, node - first
                    values = flat.take(choice[slot][:, None] * width + rows)
                    np.minimum(low[slot], values.min(axis=1), out=low[slot])
                    np.maximum(high[slot], values.max(axis=1), out=high[slot])
        used = np.flatnonzero(np.isfinite(low[:, :, 0]).ravel())
        yield pa.record_batch([pa.array(used), _lists(low.reshape(-1, per_node)[used], pa.float64()),
                               _lists(high.reshape(-1, per_node)[used], pa.float64())], ["slot", "low", "high"])

    drawn_shape = drawn.shape
    parts = data.mapInArrow(run, "slot bigint, low array<double>, high array<double>").groupBy("slot").agg(
        F.array(*(F.min(F.col("low")[k]) for k in range(per_node))).alias("low"),
        F.array(*(F.max(F.col("high")[k]) for k in range(per_node))).alias("high"))
    low, high = np.full((trees * nodes, per_node), np.nan), np.full((trees * nodes, per_node), np.nan)
    for row in parts.collect():  # at most one row per tree and node
        low[row.slot], high[row.slot] = row.low, row.high
    shared.destroy()
    return low.reshape(drawn.shape), high.reshape(drawn.shape)


def _counts(data: DataFrame, forest: Forest, drawn, cuts, level):
    """[tree, node] rows and positives, and [tree, node, k] those at or below each threshold."""
    size, first, (trees, nodes, per_node) = len(forest.columns), 1 << level, drawn.shape
    shared = data.sparkSession.sparkContext.broadcast((forest.feature, forest.threshold, drawn, cuts))

    def run(batches):
        feature, threshold, choice, cut = shared.value
        total = np.zeros((trees, nodes, 2 + 2 * per_node), np.int64)
        for table, positive in _blocks(batches, size):
            flat, width = table.ravel(), table.shape[1]
            for tree in range(trees):
                for node, rows in _at_level(table, np.arange(width), feature[tree], threshold[tree], level):
                    slot = tree, node - first
                    left = flat.take(choice[slot][:, None] * width + rows) <= cut[slot][:, None]
                    begin = int(np.searchsorted(rows, positive))  # rows of label 1 come first
                    of_positives = np.count_nonzero(left[:, :begin], axis=1)
                    counted = total[slot]
                    counted[0] += len(rows)
                    counted[1] += begin
                    counted[2:2 + per_node] += of_positives + np.count_nonzero(left[:, begin:], axis=1)
                    counted[2 + per_node:] += of_positives
        used = np.flatnonzero(total[:, :, 0].ravel())
        yield pa.record_batch([pa.array(used), _lists(total.reshape(trees * nodes, -1)[used], pa.int64())], ["slot", "n"])

    width = 2 + 2 * per_node
    parts = data.mapInArrow(run, "slot bigint, n array<bigint>").groupBy("slot").agg(
        F.array(*(F.sum(F.col("n")[k]) for k in range(width))).alias("n"))
    counted = np.zeros((trees * nodes, width), np.int64)
    for row in parts.collect():  # at most one row per tree and node
        counted[row.slot] = row.n
    shared.destroy()
    counted = counted.reshape(trees, nodes, width)
    return counted[..., 0], counted[..., 1], counted[..., 2:2 + per_node], counted[..., 2 + per_node:]


def _impurity(rows, positives):
    """Gini impurity times the rows."""
    return np.where(rows > 0, 2.0 * positives * (rows - positives) / np.maximum(rows, 1), 0.0)


def grow(df: DataFrame, columns, trees=300, depth=7, per_node=None, label="target", seed=27, missing=0.0) -> Forest:
    """A forest of ``trees`` of ``depth`` levels of splits; ``per_node`` features are drawn, the root of their number by default."""
    columns = list(columns)
    per_node = min(per_node or max(1, int(len(columns) ** 0.5)), len(columns))
    # Every level reads the rows twice.
    data = _packed_rows(df, columns, label, missing)
    size = 1 << depth
    forest = Forest(columns, np.full((trees, size), -1, np.int32), np.zeros((trees, size)), np.zeros((trees, size)))
    for level in range(depth):
        nodes = np.arange(1 << level, 2 << level)
        drawn = drawn_features(seed, trees, nodes, len(columns), per_node)
        low, high = _ranges(data, forest, drawn, level)
        share = (draw(seed + 1, np.arange(trees)[:, None, None], nodes[None, :, None], drawn) + 0.5) / MODULUS
        cuts = low + share * (high - low)
        rows, positives, left, left_positives = _counts(data, forest, drawn, cuts, level)
        all_rows, all_positives = rows[..., None], positives[..., None]
        gain = (_impurity(all_rows, all_positives) - _impurity(left, left_positives)
                - _impurity(all_rows - left, all_positives - left_positives))
        open_ = (left > 0) & (left < all_rows) & (all_positives > 0) & (all_positives < all_rows)
        best = np.where(open_, gain, -1.0).argmax(axis=2)
        tree, at = np.nonzero(open_.any(axis=2))
        if not len(tree):
            break
        chosen = best[tree, at]
        forest.feature[tree, nodes[at]] = drawn[tree, at, chosen]
        forest.threshold[tree, nodes[at]] = cuts[tree, at, chosen]
        forest.gain[tree, nodes[at]] = gain[tree, at, chosen]
    return forest


def importance_scores(df: DataFrame, columns, **settings) -> DataFrame:
    """``(position, feature, score)`` of a forest grown on ``df``."""
    shares = grow(df, columns, **settings).importances()
    rows = [(i, c, float(v)) for i, (c, v) in enumerate(zip(columns, shares))]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, score double")
