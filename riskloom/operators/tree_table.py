"""A fitted tree ensemble as a table, and what can be told from it by joins: scores, split counts, scores after every round.

The table has one row per tree node: ``round`` from 1, ``weight`` of the round, ``node``, ``feature`` by position (null in a
leaf), ``threshold`` (left if the value is at most that), ``left``, ``right``, ``gain`` and ``prediction``. Node 0 is the root. It is
bounded by rounds and depth, not by data, and is sent to the rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.flags import as_flag
from riskloom.operators.ordering import global_running_total
from riskloom.session import materialize, shared_path, ship_package

SCHEMA = ("round int, weight double, node int, feature int, threshold double, left int, right int, gain double,"
          " prediction double")


def ensemble_table(model: PipelineModel) -> DataFrame:
    """The nodes of a fitted booster, read from the model's own stored form."""
    spark = SparkSession.active()
    path = shared_path(spark, "ensemble")
    model.stages[-1].write().save(path)
    # The stored form tells trees, nodes and weights by place; the names differ between versions.
    nodes = spark.read.parquet(f"{path}/data").toDF("treeID", "nodeData").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights").drop("metadata")
    inner = F.col("leftChild") >= 0
    return materialize(nodes.join(F.broadcast(weights), "treeID").select(
        (F.col("treeID") + 1).cast("int").alias("round"), F.col("weights").alias("weight"), F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("gain")).alias("gain"), "prediction"), "ensemble")


def split_counts(ensemble: DataFrame, columns) -> DataFrame:
    """``(position, feature, score)``: in how many nodes of the ensemble each feature is split on."""
    counted = ensemble.where("feature IS NOT NULL").groupBy("feature").agg(F.count("*").alias("n"))
    names = ensemble.sparkSession.createDataFrame(list(enumerate(columns)), "position int, feature string")
    return names.join(F.broadcast(counted.select(F.col("feature").alias("position"), "n")), "position", "left").select(
        "position", "feature", F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("score"))


def round_predictions(ensemble: DataFrame, df: DataFrame, columns, *keys, missing=0.0) -> DataFrame:
    """``keys``, ``round`` and the ``part`` that the round adds to a row's margin.

    Rows meet the roots of all rounds and step down by joins on (round, node), one per level, all with the broadcast table.
    """
    values = F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(missing))) for c in columns))
    roots = ensemble.where("node = 0").select("round", "weight").collect()  # one row per round
    rounds = F.array(*(F.struct(F.lit(r["round"]).alias("round"), F.lit(r.weight).alias("weight")) for r in roots))
    at = df.select(*keys, values.alias("_values"), F.explode(rounds).alias("_root")).select(
        *keys, "_values", "_root.round", "_root.weight", F.lit(0).alias("_at"))
    inner = ensemble.where("feature IS NOT NULL").select(
        F.col("round").alias("_round"), F.col("node").alias("_node"), "feature", "threshold", "left", "right")
    for _ in range(levels(ensemble)):
        met = at.join(F.broadcast(inner), (F.col("round") == F.col("_round")) & (F.col("_at") == F.col("_node")), "left")
        side = F.when(F.get("_values", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = met.select(*keys, "_values", "round", "weight", F.coalesce(side, F.col("_at")).alias("_at"))
    leaves = ensemble.select(F.col("round").alias("_round"), F.col("node").alias("_node"), "prediction")
    return at.join(F.broadcast(leaves), (F.col("round") == F.col("_round")) & (F.col("_at") == F.col("_node"))).select(
        *keys, "round", (F.col("weight") * F.col("prediction")).alias("part"))


def levels(ensemble: DataFrame) -> int:
    """Levels of splits, from the table's inner nodes, which rounds and depth bound."""
    inner = {(r["round"], r.node): (r.left, r.right)
             for r in ensemble.where("feature IS NOT NULL").select("round", "node", "left", "right").collect()}
    found, front = 0, {key for key in inner if key[1] == 0}
    while front:
        found += 1
        front = {(place, child) for place, node in front for child in inner[place, node] if (place, child) in inner}
    return found


def probability(margin):
    """Chance of class 1 at a margin of the logistic loss of labels -1 and 1."""
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


def table_scores(ensemble: DataFrame, df: DataFrame, columns, missing=0.0) -> DataFrame:
    """``(ID, PROB)`` by the table alone; plus the label if there is one. Ids must be unique."""
    label = ["target"] if "target" in df.columns else []
    parts = round_predictions(ensemble, df, columns, "id", *label, missing=missing)
    return parts.groupBy(F.col("id").alias("ID"), *label).agg(F.sum("part").alias("margin")).select(
        "ID", probability(F.col("margin")).alias("PROB"), *label)


def grouped_auc(df: DataFrame, group: str, label="target", score="prob") -> DataFrame:
    """``(group, auc, positives, negatives)``: the exact AUC of every group by one global order of (group, score).

    Groups may be of any size; none is gathered in a task. Null ``auc`` if a class is empty in a group.
    """
    positive = as_flag(F.col(label) == 1).cast("bigint")
    by_score = df.groupBy(F.col(group), F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    ranked = global_running_total(by_score, F.col(group).asc(), F.col("score").asc(), amount="neg", name="lower")
    # The total before a group's first row is that of all earlier groups.
    sums = ranked.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("lower") + F.col("neg") / 2.0)).alias("wins"), F.min("lower").alias("before"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    own = F.col("wins") - F.col("before") * F.col("positives")
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(group, F.try_divide(own, pairs).alias("auc"), "positives", "negatives")


def staged_margins(ensemble: DataFrame, df: DataFrame, columns, *keys, missing=0.0) -> DataFrame:
    """``keys``, ``round`` and the ``margin`` after it: a running sum over a row's rounds, whose number is bounded.

    A task walks its rows down all trees at once, so that neither values nor places are copied per round and no row is moved.
    """
    ship_package(df.sparkSession)
    walk, n_keys = _Walk(ensemble, len(columns)), len(keys)
    rounds = walk.rounds

    def run(batches):
        for batch in batches:
            for rows, margin in walk.margins(batch, n_keys):
                repeated = pa.array(np.repeat(np.arange(len(margin)), len(rounds)))
                yield pa.record_batch([*(rows.column(k).take(repeated) for k in range(n_keys)),
                                       pa.array(np.tile(rounds, len(margin)), pa.int32()), pa.array(margin.ravel())],
                                      [*keys, "round", "margin"])

    held = df.select(*keys, _values(columns, missing).alias("_values"))
    kinds = ", ".join(f"`{k}` {held.schema[k].dataType.simpleString()}" for k in keys)
    return held.mapInArrow(run, f"{kinds}, round int, margin double")


def _values(columns, missing):
    return F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(missing))) for c in columns))


# Rows walked at once: so many times the rounds are in memory.
_WALKED = 2000


class _Walk:
    """The trees of an ensemble as flat arrays, and the margins of rows after every round."""

    def __init__(self, ensemble: DataFrame, size):
        feature, threshold, children, part, self.rounds = _trees(ensemble)
        count, width = feature.shape
        first = np.arange(count) * width
        self.depth, self.size, self.roots = levels(ensemble), size, first
        self.feature, self.threshold, self.part = feature.ravel(), threshold.ravel(), part.ravel()
        self.children = (children + first[:, None, None]).ravel()

    def margins(self, batch, column):
        """Slices of a batch, and [row, round] their margins by the values in ``column``."""
        for at in range(0, batch.num_rows, _WALKED):
            rows = batch.slice(at, _WALKED)
            x = rows.column(column).flatten().to_numpy(zero_copy_only=False)
            line = (np.arange(rows.num_rows) * self.size)[:, None]
            node = np.broadcast_to(self.roots, (rows.num_rows, len(self.roots)))
            for _ in range(self.depth):
                # A comparison that Spark and the model share: NaN is above every threshold.
                right = ~(x.take(line + self.feature.take(node)) <= self.threshold.take(node))
                node = self.children.take(2 * node + right)
            yield rows, np.cumsum(self.part.take(node), axis=1)


def _trees(ensemble: DataFrame):
    """[round, node] feature, threshold, both children (a leaf's are itself) and weighted prediction; and the rounds in order."""
    nodes = ensemble.collect()  # bounded by rounds and depth
    rounds = sorted({n["round"] for n in nodes})
    place, width = {r: i for i, r in enumerate(rounds)}, max((n.node for n in nodes), default=0) + 1
    feature, threshold = np.zeros((len(rounds), width), np.int64), np.zeros((len(rounds), width))
    children = np.broadcast_to(np.arange(width)[None, :, None], (len(rounds), width, 2)).copy()
    part = np.zeros((len(rounds), width))
    for n in nodes:
        at = place[n["round"]], n.node
        part[at] = n.weight * n.prediction
        if n.feature is not None:
            feature[at], threshold[at], children[at] = n.feature, n.threshold, (n.left, n.right)
    return feature, threshold, children, part, np.array(rounds, np.int32)


def watch_list(ensemble: DataFrame, train: DataFrame, validation: DataFrame, columns, missing=0.0) -> DataFrame:
    """``(round, train_auc, validation_auc)`` after every round."""
    both = train.select("target", *(f"`{c}`" for c in columns), F.lit(0).alias("_side")).unionByName(
        validation.select("target", *(f"`{c}`" for c in columns), F.lit(1).alias("_side")))
    by_group = staged_auc(ensemble, materialize(both, "watched"), columns, "_side", missing=missing)
    return by_group.groupBy("round").agg(
        F.max(F.when(F.col("_side") == 0, F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("_side") == 1, F.col("auc"))).alias("validation_auc"))


def staged_auc(ensemble: DataFrame, df: DataFrame, columns, side, label="target", missing=0.0) -> DataFrame:
    """``(round, side, auc, positives, negatives)``: the exact AUC of every round on every ``side``, a small whole number.

    What :func:`grouped_auc` says of :func:`staged_margins`, with sorted runs in place of single margins: a task sorts the margins of a block
    of rows round by round and cuts them at fixed values into ranges, which meet by (round, side, range). A range holds so many rows that a task
    sorts it again at once. Cuts come from a sample of the rows; they steer the size of the ranges, not the result. Store ``df`` before.
    """
    ship_package(df.sparkSession)
    walk, rows = _Walk(ensemble, len(columns)), df.count()
    rounds, most = walk.rounds, max(_BLOCK_VALUES // max(len(walk.rounds), 1), 1)
    held = df.select(F.col(side).cast("int").alias("side"), as_flag(F.col(label) == 1).alias("label"), _values(columns, missing).alias("values"))
    cuts = _cuts(walk, held, rows)

    def block(parts):
        sides, labels, margins = (np.concatenate(x) for x in zip(*parts))
        records = []
        for one in np.unique(sides):
            # Of a class [round, row], each round in order.
            classes = [np.sort(margins[(sides == one) & (labels == c)].T, axis=1) for c in (1, 0)]
            for i, number in enumerate(rounds):
                runs = [_runs(values[i], cuts[i]) for values in classes]
                records += [(number, one, k, *positive, *negative) for k, (positive, negative) in enumerate(zip(*runs))
                            if positive[0] or negative[0]]
        for at in range(0, len(records), _SENT):
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*records[at:at + _SENT]), _RUN_TYPES)], _RUN_NAMES)

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for piece, margin in walk.margins(batch, 2):
                parts.append((piece.column(0).to_numpy(), piece.column(1).to_numpy(), margin))
                n += len(margin)
                if n >= most:
                    yield from block(parts)
                    parts, n = [], 0
        if n:
            yield from block(parts)

    runs = held.mapInArrow(run, ", ".join(f"{n} {'int' if t == pa.int32() else 'binary'}" for n, t in zip(_RUN_NAMES, _RUN_TYPES)))
    ranges = runs.groupBy("round", "side", "range").applyInArrow(
        _range_wins, "round int, side int, range int, twice_wins bigint, positives bigint, negatives bigint")
    # At most one row per range, so this window is as small as the list of cuts.
    lower = F.coalesce(F.sum("negatives").over(Window.partitionBy("round", "side").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    sums = ranges.withColumn("wins", F.col("twice_wins") / 2.0 + F.col("positives") * lower).groupBy("round", F.col("side").alias(side)).agg(
        F.sum("wins").alias("wins"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    return sums.select("round", side, F.try_divide("wins", F.col("positives").cast("double") * F.col("negatives")).alias("auc"),
                       "positives", "negatives")


# Margins that a task holds at once, 64 MB, and twice that while it sorts them; rows in a range; rows of the sample at most, and records sent at once.
_BLOCK_VALUES, _RANGE_ROWS, _SAMPLED, _SENT = 1 << 23, 1 << 20, 20_000, 100
_RUN_NAMES = ["round", "side", "range", "positive", "positive_n", "negative", "negative_n"]
_RUN_TYPES = [pa.int32()] * 3 + [pa.binary()] * 4


def _cuts(walk, held: DataFrame, rows):
    """[round, cut] margins that part the rows into ranges of about ``_RANGE_ROWS``."""
    ranges = -(-rows // _RANGE_ROWS)
    if ranges < 2:
        return np.empty((len(walk.rounds), 0))
    sample = held.select("values").sample(min(1.0, min(200 * ranges, _SAMPLED) / rows), 1).toArrow()
    margins = [m for batch in sample.to_batches() for _, m in walk.margins(batch, 0)]
    if not margins:
        return np.empty((len(walk.rounds), 0))
    ordered = np.sort(np.concatenate(margins), axis=0)
    return ordered[np.arange(1, ranges) * len(ordered) // ranges].T.copy()


def _runs(values, cuts):
    """Sorted values cut into ranges, a value equal to a cut above it: (bytes of the different values, of their numbers) by range."""
    edges = [0, *np.searchsorted(values, cuts), len(values)]
    found = []
    for begin, end in zip(edges, edges[1:]):
        part = values[begin:end]
        new = np.flatnonzero(part[1:] != part[:-1]) + 1
        if len(new) + 1 >= len(part):
            found.append((part.tobytes(), b""))  # no value comes twice
        else:
            starts = np.concatenate([[0], new])
            found.append((part[starts].tobytes(), np.diff(np.append(starts, len(part))).astype("<i8").tobytes()))
    return found


def _range_wins(table: pa.Table) -> pa.Table:
    """Twice the pairs of a range that are ranked rightly, ties counting half, and how many rows of each class it has."""
    def joined(name):
        values, numbers = [], []
        for v, n in zip(table[name].to_pylist(), table[f"{name}_n"].to_pylist()):
            values.append(np.frombuffer(v, "<f8"))
            numbers.append(np.frombuffer(n, "<i8") if n else np.ones(len(values[-1]), "<i8"))
        return np.concatenate(values), np.concatenate(numbers)

    positive, each = joined("positive")
    negative, number = joined("negative")
    order = np.argsort(negative)
    negative, below = negative[order], np.concatenate([[0], np.cumsum(number[order])])
    lower, upper = (below[np.searchsorted(negative, positive, side=s)] for s in ("left", "right"))
    wins = int((each * (lower + upper)).sum())
    return pa.table({**{k: table[k].slice(0, 1).cast(pa.int32()) for k in ("round", "side", "range")}, "twice_wins": pa.array([wins], pa.int64()),
                     "positives": pa.array([int(each.sum())], pa.int64()), "negatives": pa.array([int(below[-1])], pa.int64())})
