"""Min-max scaling over a whole table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numbers import rescaled


def column_ranges(df: DataFrame, columns) -> DataFrame:
    """One row with the lowest and highest value of every column."""
    return df.agg(F.struct(*[
        F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns
    ]).alias("ranges"))


def scale_columns(df: DataFrame, columns, ranges: DataFrame | None = None) -> DataFrame:
    """Scale columns to 0..1; a constant column becomes null.

    The range is that of ``df`` itself unless fitted ``ranges`` of another table
    are given. It enters once, as a scalar subquery in a struct column of its own; one subquery per
    bound would be planned that many times.
    """
    fitted = column_ranges(df, columns) if ranges is None else ranges
    low, high = ({c: F.col("ranges").getField(c).getField(side) for c in columns}
                 for side in ("low", "high"))
    scaled = {c: rescaled(F.col(c), low[c], high[c]) for c in columns}
    return (df.withColumn("ranges", fitted.scalar())
              .select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns]))
