"""Feature selection. Score frames are ``(position, feature, score)``, one row per column.

Statistics of all columns are one pass: a task adds up its Arrow batches column by column and gives one row per column, and those rows meet
by column. Hundreds of aggregates in one plan would exceed what the JVM compiles and run interpreted.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import top_features
from riskloom.session import ship_package
from riskloom.vocab import NOT_SELECTABLE


KEYS = ("id", "target", "appl_sbm_tm")


def feature_columns(df: DataFrame, keys=KEYS, drop=()) -> list[str]:
    """Feature names by name, not position; names in ``drop`` need not exist."""
    return [c for c in df.columns if c not in keys and c not in drop]


def selectable_features(df: DataFrame) -> list[str]:
    return feature_columns(df, drop=NOT_SELECTABLE)


def listed_features(df: DataFrame, names) -> list[str]:
    """The ``names``, all of which ``df`` must hold."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{len(missing)} of {len(names)} listed features are missing: {missing}")
    return list(names)


def _task_rows(df: DataFrame, columns, summary, schema, label=None) -> DataFrame:
    """What ``summary`` gives for the columns of every task: it takes batches of value arrays (nulls taken out) and of the label.

    A batch is ``(values, kept, label)`` with one entry per column in ``values`` and ``kept``; ``kept`` is None for a column without nulls.
    """
    ship_package(df.sparkSession)
    cells = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)],
                      *([] if label is None else [label.alias("label")]))
    width, labelled = len(columns), label is not None

    def read(batches):
        for batch in batches:
            values, kept = [], []
            for column in batch.columns[:width]:
                whole = column.null_count == 0
                kept.append(None if whole else column.is_valid().to_numpy(zero_copy_only=False))
                values.append((column if whole else column.drop_null()).to_numpy(zero_copy_only=False))
            yield values, kept, batch.column(width) if labelled else None

    def run(batches):
        with np.errstate(all="ignore"):
            yield summary(read(batches))

    return cells.mapInArrow(run, schema)


def _score_frame(rows: DataFrame, columns, score) -> DataFrame:
    """``rows`` by ``position`` as a score frame with every one of the ``columns``."""
    names = rows.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, columns))).alias("position", "feature"))
    return names.join(F.broadcast(rows), "position", "left").select("position", "feature", score.alias("score"))


def variance_scores(df: DataFrame, columns) -> DataFrame:
    """Population variance of every column: one pass, no row per value.

    A task gives count, mean and squared deviations of each column; they are merged as such, since sums of squares would cancel.
    """
    width = len(columns)

    def summary(batches):
        count, mean, squares = np.zeros(width), np.zeros(width), np.zeros(width)
        for values, _, _ in batches:
            for i, v in enumerate(values):
                if len(v):
                    own = v.mean()
                    shift, rows = own - mean[i], count[i] + len(v)
                    squares[i] += ((v - own) ** 2).sum() + shift * shift * count[i] * len(v) / rows
                    mean[i] += shift * len(v) / rows
                    count[i] = rows
        used = np.flatnonzero(count)
        task = np.full(len(used), TaskContext.get().partitionId())
        return pa.record_batch([pa.array(used, pa.int32()), pa.array(task, pa.int32()), pa.array(count[used]), pa.array(mean[used]),
                                pa.array(squares[used])], ["position", "task", "n", "mean", "squares"])

    def merged(a, b):
        rows, shift = a.n + b.n, b["mean"] - a["mean"]
        return F.struct(rows.alias("n"), F.when(a.n == 0, b["mean"]).otherwise(a["mean"] + shift * b.n / rows).alias("mean"),
                        F.when(a.n == 0, b.squares).otherwise(a.squares + b.squares + shift * shift * a.n * b.n / rows).alias("squares"))

    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "squares")])
    parts = _task_rows(df, columns, summary, "position int, task int, n double, mean double, squares double")
    # One entry a task and column, merged in the order of the tasks.
    totals = parts.groupBy("position").agg(F.array_sort(F.collect_list(F.struct("task", "n", "mean", "squares"))).alias("parts")).select(
        "position", F.aggregate("parts", none, merged).alias("all"))
    return _score_frame(totals, columns, F.col("all.squares") / F.col("all.n"))


def chi2_scores(df: DataFrame, columns, label="target") -> DataFrame:
    """Chi-squared of non-negative features against a 0/1 label, from sums per class.

    Observed is the feature sum of a class, expected the class share of the total sum; one
    pass over the matrix. A feature that sums to zero has no score. (Spark's own chi-squared test
    counts categories instead, a different statistic.)
    """
    width = len(columns)

    def summary(batches):
        labelled, positives = 0, 0
        count, total, observed = np.zeros(width, np.int64), np.zeros(width), np.zeros(width)
        for values, kept, positive in batches:
            labelled += len(positive) - positive.null_count
            chosen = positive.fill_null(False).to_numpy(zero_copy_only=False)
            positives += int(chosen.sum())
            for i, (v, k) in enumerate(zip(values, kept)):
                count[i] += len(v)
                total[i] += v.sum()
                observed[i] += v[chosen if k is None else chosen[k]].sum()
        return pa.record_batch([pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, labelled)),
                                pa.array(np.full(width, positives)), pa.array(count), pa.array(total), pa.array(observed)],
                               ["position", "labelled", "positives", "n", "total", "observed"])

    parts = _task_rows(df, columns, summary, "position int, labelled long, positives long, n long, total double, observed double",
                       F.col(label) == 1)
    sums = parts.groupBy("position").agg(*[F.sum(c).alias(c) for c in ("labelled", "positives", "n", "total", "observed")]).select(
        "position", F.try_divide("positives", "labelled").alias("share"), F.when(F.col("n") > 0, F.col("total")).alias("total"), "observed")
    expected = F.col("share") * F.col("total")
    # With two classes both deviations have the same size.
    deviation = F.pow(F.col("observed") - expected, F.lit(2))
    score = (F.try_divide(deviation, expected)
             + F.try_divide(deviation, (1 - F.col("share")) * F.col("total")))
    return _score_frame(sums, columns, score)


def names_of(scores: DataFrame) -> list[str]:
    """Feature names of a score frame; as many rows as the matrix has columns at most."""
    return [r.feature for r in scores.select("feature").collect()]


def top_names(scores: DataFrame, k) -> list[str]:
    return names_of(top_features(scores, k))


def combine_names(base=None, *others) -> list[str]:
    """Names of the variance set that all other sets hold too.

    The base set starts the union, the others intersect it: without a base nothing is left.
    """
    kept = list(base or [])
    for names in others:
        kept = [n for n in kept if n in set(names)]
    return kept


def binary_columns(df: DataFrame, columns) -> list[str]:
    """Columns with exactly two distinct values, in schema order, nulls not counted.

    One pass instead of distinct counts: a task gives the lowest and highest value of each column and whether any value lies
    between them. Two numbers of all tasks together and nothing between make a column of two values; NaN makes none.
    """
    columns = list(columns)
    width = len(columns)

    def summary(batches):
        low, high, more, seen = np.full(width, np.nan), np.full(width, np.nan), np.zeros(width, bool), np.zeros(width, bool)
        for values, _, _ in batches:
            for i, v in enumerate(values):
                if not len(v) or more[i]:
                    continue
                if seen[i]:
                    v = np.concatenate(([low[i], high[i]], v))
                low[i], high[i], seen[i] = v.min(), v.max(), True  # NaN if there is any
                more[i] = bool(((v > low[i]) & (v < high[i])).any()) or np.isnan(low[i])
        used = np.flatnonzero(seen)
        return pa.record_batch([pa.array(np.repeat(used, 2), pa.int32()), pa.array(np.column_stack([low, high])[used].ravel()),
                                pa.array(np.repeat(more[used], 2))], ["position", "value", "more"])

    parts = _task_rows(df, columns, summary, "position int, value double, more boolean")
    two = parts.groupBy("position").agg(F.count_distinct("value").alias("n"), F.max("more").alias("more")).where("n = 2 AND NOT more")
    return [columns[r.position] for r in two.orderBy("position").collect()]


def tree_layout(df: DataFrame, columns, keep_binary=130) -> list[str]:
    """Continuous columns, then the first ``keep_binary`` two-valued ones."""
    binary = binary_columns(df, columns)
    return [c for c in columns if c not in set(binary)] + binary[:keep_binary]


def linear_layout(df: DataFrame, columns, keep_binary=140) -> list[str]:
    """The first ``keep_binary`` two-valued columns, then the continuous ones."""
    binary = binary_columns(df, columns)
    return binary[:keep_binary] + [c for c in columns if c not in set(binary)]
