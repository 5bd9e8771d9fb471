"""Ranks and running totals over a whole table without a single-task window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits


def _sorted_slices(df: DataFrame, order) -> DataFrame:
    """``df`` in global order, stored, with ``slice_id`` and the 0-based ``slice_row``.

    A global sort range-partitions by the order columns, each task holding one slice. The
    result is stored because the slices must be the same in the two passes that
    follow. With a unique last order column even a value shared by a
    third of the rows is cut into slices of even size.
    """
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    return materialize(placed, "sorted").select(
        *df.columns,
        F.shiftright("_at", _ROW_BITS).alias("slice_id"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("slice_row"),
    )


def _with_total_before(slices: DataFrame, amount) -> DataFrame:
    """Add ``total_before``: the sum of ``amount`` over all earlier slices.

    The per-slice totals have at most one row per shuffle partition, which bounds both the
    window over them and the broadcast.
    """
    earlier = Window.orderBy("slice_id").rowsBetween(Window.unboundedPreceding, -1)
    totals = slices.groupBy("slice_id").agg(F.sum(amount).alias("slice_total"))
    offsets = totals.select(
        "slice_id",
        F.coalesce(F.sum("slice_total").over(earlier), F.lit(0)).alias("total_before"))
    return slices.join(F.broadcast(offsets), "slice_id")


def global_row_number(df: DataFrame, *order, name="rank") -> DataFrame:
    """Number all rows 1..n in the given order. End the order with a unique column."""
    slices = _sorted_slices(df, order)
    return (_with_total_before(slices, F.lit(1))
            .withColumn(name, F.col("total_before") + F.col("slice_row") + 1)
            .select(*df.columns, name))


def global_running_total(df: DataFrame, *order, amount, name) -> DataFrame:
    """Sum of ``amount`` over all earlier rows in the given order, the row itself left out."""
    slices = _sorted_slices(df, order)
    within = (Window.partitionBy("slice_id").orderBy("slice_row")
                    .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum(amount).over(within), F.lit(0))
    return (_with_total_before(slices, F.col(amount))
            .withColumn(name, F.col("total_before") + before)
            .select(*df.columns, name))


def top_features(scores: DataFrame, k) -> DataFrame:
    """The k best rows of a ``(position, feature, score)`` frame, unscored ones last.

    Equal scores go to the later column, as in a stable ascending sort cut from the end.
    """
    order = [F.col("score").desc_nulls_last(), F.col("position").desc()]
    return scores.orderBy(*order).limit(k)
