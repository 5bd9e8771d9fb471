"""Second moments of a feature matrix, and what follows from them without reading the rows again.

One pass gives counts, sums and the sums of all products of two columns. A task adds up outer products of its batches and
gives one row per column, so what is shuffled depends on the number of columns and tasks, not on the rows. The driver
holds one matrix of the columns' number squared. Null and NaN entries count as zero, as in the model input.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """``rows``, the columns' ``sums`` and the sums of ``products`` of each two, in the order of ``columns``."""

    columns: tuple
    rows: int
    sums: np.ndarray
    products: np.ndarray

    def covariance(self) -> np.ndarray:
        mean = self.sums / max(self.rows, 1)
        return self.products / max(self.rows, 1) - np.outer(mean, mean)


def second_moments(df: DataFrame, columns) -> DataFrame:
    """``(position, sums)``: of each column the sums of its products with all columns; a column of ones comes last."""
    size = len(columns) + 1
    values = F.array(*(F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns),
                     F.lit(1.0)).alias("x")

    def add_up(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            total += x.T @ x
        rows = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * size, pa.int32()), pa.array(total.ravel()))
        yield pa.record_batch([pa.array(np.arange(size), pa.int32()), rows], ["position", "sums"])

    parts = df.select(values).mapInArrow(add_up, "position int, sums array<double>")
    return parts.groupBy("position").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(size))).alias("sums"))


def collected(df: DataFrame, columns) -> Moments:
    """The moments on the driver: ``len(columns) + 1`` rows of as many numbers."""
    rows = {r.position: r.sums for r in second_moments(df, columns).collect()}
    table = np.array([rows[i] for i in range(len(columns) + 1)]) if rows else np.zeros((len(columns) + 1,) * 2)
    return Moments(tuple(columns), int(round(table[-1, -1])), table[-1, :-1], table[:-1, :-1])


def as_pairs(df: DataFrame, columns) -> DataFrame:
    """``(one, other, product)`` by column names; ``1`` stands for the column of ones, so its products are the sums."""
    names = F.array(*(F.lit(c) for c in columns), F.lit("1"))
    pairs = second_moments(df, columns).select("position", F.posexplode("sums").alias("place", "product"))
    return pairs.select(F.element_at(names, F.col("position") + 1).alias("one"),
                        F.element_at(names, F.col("place") + 1).alias("other"), "product")


def ridge_weights(moments: Moments, label: str, strength=1.0):
    """The inverse of the penalised correlations, and the weights of the label on the standardised columns.

    Minimises the squared error of the label plus ``1/strength`` times the squared weights. Columns that never change
    get the weight 0.
    """
    at = moments.columns.index(label)
    others = [i for i in range(len(moments.columns)) if i != at]
    covariance = moments.covariance()
    spread = np.sqrt(np.maximum(np.diag(covariance), 0.0))
    # What is left of a constant column is rounding.
    flat = spread[others] ** 2 <= 1e-12 * np.diag(moments.products)[others] / max(moments.rows, 1)
    unit = np.where(flat, 0.0, 1.0 / np.where(flat, 1.0, spread[others]))
    scaled = moments.rows * covariance[np.ix_(others, others)] * np.outer(unit, unit)
    inverse = np.linalg.inv(scaled + np.eye(len(others)) / strength)
    target = moments.rows * covariance[others, at] * unit
    return [moments.columns[i] for i in others], inverse, inverse @ target


def elimination_ranking(moments: Moments, label: str, keep: int, step=1, strength=1.0) -> list[tuple]:
    """``(feature, ranking)``: 1 for the ``keep`` features that stay, then rising the earlier a feature is dropped.

    Recursive elimination by the smallest weight of a ridge fit. Dropping a column downdates the inverse and the weights
    by one rank, so that the whole path costs one inversion; the rows are not read again. Of equal weights the earlier column goes first.
    """
    names, inverse, weights = ridge_weights(moments, label, strength)
    left, ranking, rounds = list(range(len(names))), {}, []
    while len(left) > keep:
        order = sorted(left, key=lambda i: (abs(weights[i]), i))[:min(step, len(left) - keep)]
        for i in order:
            pivot = inverse[:, i] / inverse[i, i]
            weights = weights - pivot * weights[i]
            inverse = inverse - np.outer(pivot, inverse[i])
            left.remove(i)
        rounds.append(order)
    for place, dropped in enumerate(reversed(rounds), start=2):
        ranking.update(dict.fromkeys(dropped, place))
    return [(name, ranking.get(i, 1)) for i, name in enumerate(names)]


def elimination(df: DataFrame, columns, keep, label="target", step=1, strength=1.0) -> DataFrame:
    """``(position, feature, ranking)`` of all columns from one pass over ``df``."""
    ranked = elimination_ranking(collected(df, [*columns, label]), label, keep, step, strength)
    rows = [(i, name, rank) for i, (name, rank) in enumerate(ranked)]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, ranking int")
