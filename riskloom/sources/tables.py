"""Readers for the applicant tables, stored matrices and score files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.clean import normalise_missing
from riskloom.schemas import FEATURE_TABLES, SCHEMAS, SPINES
from riskloom.sources.sinks import MONTH


CSV = {"header": True, "quote": '"', "escape": '"'}


def _typed(column, kind, table):
    """The column in its declared type. Whole numbers may be written ``1.0``; a label that is not 0 or 1 is an error."""
    if not isinstance(kind, T.IntegerType):
        return F.col(column).try_cast(kind)
    number = F.col(column).try_cast("double")
    fault = F.raise_error(F.concat(F.lit(f"{table}.{column} is not 0 or 1: "), F.col(column).cast("string")))
    return (F.when(F.col(column).isNull(), F.lit(None)).when(number.isin(0.0, 1.0), number.cast(kind))
            .otherwise(fault.cast(kind)))


def read_table(spark: SparkSession, path, name, fmt="csv", multi_line=False) -> DataFrame:
    """One table with its declared columns and types, missing values as null.

    CSV columns are found by header name and cast afterwards: no inference pass over
    the data, and files may have more columns or another order. Quotes inside a field are doubled; with
    ``multi_line`` fields may hold line ends (such files cannot be split).
    """
    if fmt == "csv":
        raw = spark.read.csv(path, encoding="utf-8", multiLine=multi_line, **CSV)
    else:
        raw = spark.read.format(fmt).load(path)
    schema = SCHEMAS[name]
    present = normalise_missing(raw.select(*[f.name for f in schema if f.name in raw.columns]))
    absent = [f.name for f in schema if f.name not in raw.columns]
    if "id" in absent or ("appl_sbm_tm" in absent):
        raise ValueError(f"{name} at {path} lacks its key columns")
    return present.select(*[
        (F.lit(None) if f.name in absent else _typed(f.name, f.dataType, name))
        .cast(f.dataType).alias(f.name) for f in schema])


def read_tables(spark: SparkSession, root, role="train", prefix=None, fmt="csv") -> dict:
    """The six feature tables and the spine of the ``train`` or ``score`` set.

    Looks for ``<root>/<prefix>_<table>.<fmt>``; the spine is ``target`` or ``list``.
    """
    prefix = role if prefix is None else prefix
    names = (*FEATURE_TABLES, SPINES[role])
    return {name: read_table(spark, f"{root}/{prefix}_{name}.{fmt}", name, fmt) for name in names}


def read_matrix(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_monthly(spark: SparkSession, path, first=None, last=None) -> DataFrame:
    """A matrix stored by month, months ``first..last`` (``yyyyMM``, inclusive) or all; only their folders are read."""
    stored = spark.read.parquet(path)
    # Folder names that look like numbers are read as such.
    month = F.col(MONTH).try_cast("int")
    if first is not None:
        stored = stored.where(month >= int(first))
    if last is not None:
        stored = stored.where(month <= int(last))
    return stored.drop(MONTH)


def read_month_split(spark: SparkSession, path, held) -> tuple:
    """``(every other month, the held month)``; rows without a month are in the first part."""
    month = F.col(MONTH).try_cast("int")
    stored = spark.read.parquet(path)
    return (stored.where(month.isNull() | (month != int(held))).drop(MONTH), stored.where(month == int(held)).drop(MONTH))


def read_bucketed(spark: SparkSession, prefix, names) -> dict:
    """Tables that :func:`~riskloom.sources.sinks.write_bucketed` stored."""
    return {name: spark.table(f"{prefix}_{name}") for name in names}


def read_scores(spark: SparkSession, path, fmt="parquet") -> DataFrame:
    """An ``(ID, PROB)`` file, columns taken by position as the first two."""
    raw = spark.read.csv(path, **CSV) if fmt == "csv" else spark.read.format(fmt).load(path)
    key, prob = raw.columns[:2]
    return raw.select(F.col(key).alias("ID"), F.col(prob).cast("double").alias("PROB"))
