"""Filling, filtering and splitting."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numbers import number_or_null
from riskloom.functions.text import without_null_tokens
from riskloom.vocab import NULL_CATEGORY


def normalise_missing(df: DataFrame) -> DataFrame:
    """Null tokens in text columns and NaN in float columns become null."""
    out = []
    for name, kind in df.dtypes:
        if kind == "string":
            out.append(without_null_tokens(name).alias(name))
        elif kind in ("double", "float"):
            out.append(F.when(~F.isnan(name), F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def table_mean(df: DataFrame, value: Column) -> Column:
    """Mean over the whole table as a scalar subquery: one pass, no join, no driver step."""
    return df.agg(F.avg(value)).scalar()


def mean_fill(df: DataFrame, *columns) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), table_mean(df, F.col(c))) for c in columns})


def amount_mean_fill(df: DataFrame, column="amt_order") -> DataFrame:
    """Text amount to double; missing and ``null`` take the mean of the usable amounts."""
    amount = number_or_null(column)
    return df.withColumn(column, F.coalesce(amount, table_mean(df, amount)))


def usable_rows(df: DataFrame, column) -> DataFrame:
    """Rows whose value is present and not the text ``null``."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != NULL_CATEGORY))


def zero_fill(df: DataFrame) -> DataFrame:
    """All remaining nulls in numeric columns become 0."""
    return df.fillna(0)


def months_between(df: DataFrame, first, last, column="appl_sbm_tm") -> DataFrame:
    """Rows of the months ``first..last`` (``yyyyMM``, inclusive).

    A range on the raw ``yyyy-MM-dd ...`` text, so that Parquet statistics can skip
    row groups; equal to comparing the month keys.
    """
    start = f"{first[:4]}-{first[4:]}"
    year, month = int(last[:4]), int(last[4:])
    following = f"{year + month // 12:04d}-{month % 12 + 1:02d}"
    return df.filter((F.col(column) >= start) & (F.col(column) < following))


def split_off_month(df: DataFrame, month, column="appl_sbm_tm"):
    """``(every other month, the given month)``; rows without a month are in the first part."""
    inside = months_between(df, month, month, column)
    start = f"{month[:4]}-{month[4:]}"
    outside = df.filter(~F.coalesce(F.startswith(F.col(column), F.lit(start)), F.lit(False)))
    return outside, inside
