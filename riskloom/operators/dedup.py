"""Duplicate rows, distinct keys and first rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import ONE_ROW_PER_ID


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop full duplicates (null equals null).

    The shuffle key is the whole row, so rows of a hot id spread over all tasks.
    """
    return df.distinct()


def distinct_keys(df: DataFrame, key="id") -> DataFrame:
    return df.select(key).distinct()


def first_per_key(df: DataFrame, key="id", order_by=None, keep=None) -> DataFrame:
    """The first row of every key under a declared order (nulls first).

    Files have no row order in Spark, so the order is part of the call: by default all
    other columns, ascending. A ``min`` over a struct (a sort aggregate in Spark) keeps one candidate per
    key and task; a window would pull all rows of a hot key into one task.
    """
    keep = list(keep or [c for c in df.columns if c != key])
    order_by = list(order_by or [c for c in df.columns if c != key])
    extra = [c for c in keep if c not in order_by]
    candidate = F.struct(*[F.col(c) for c in order_by + extra])
    return (df.groupBy(key).agg(F.min(candidate).alias("first_row"))
              .select(key, *[F.col("first_row").getField(c).alias(c) for c in keep]))


def require_unique_tables(tables: dict, spine: DataFrame) -> None:
    """Fail if an id repeats in the spine or in a table declared to hold one row per id."""
    require_unique(spine)
    for name in ONE_ROW_PER_ID:
        if name in tables and tables[name] is not spine:
            require_unique(tables[name])


def require_unique(df: DataFrame, key="id") -> DataFrame:
    """Fail if a key repeats: a right side with repeats would multiply rows in a join."""
    repeated = df.groupBy(key).count().filter("count > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"{key} is not unique, for example {[r[key] for r in repeated]}")
    return df
