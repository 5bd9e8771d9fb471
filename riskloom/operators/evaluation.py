"""Exact area under the ROC curve."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.flags import as_flag
from riskloom.operators.ordering import global_running_total


def exact_auc(df: DataFrame, label="target", score="prob") -> DataFrame:
    """One row: ``auc``, ``positives``, ``negatives``.

    The share of (positive, negative) pairs ranked rightly, ties counting half. Rows are first
    counted per score, then one running total of the negatives replaces the pairs.
    Every label but 1 is negative. Null ``auc`` if a class is empty.
    """
    positive = as_flag(F.col(label) == 1).cast("bigint")
    by_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    ranked = global_running_total(by_score, F.col("score").asc(), amount="neg", name="lower")
    wins = F.sum(F.col("pos") * (F.col("lower") + F.col("neg") / 2.0))
    totals = ranked.agg(wins.alias("wins"), F.sum("pos").alias("positives"),
                        F.sum("neg").alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select(F.try_divide("wins", pairs).alias("auc"), "positives", "negatives")
