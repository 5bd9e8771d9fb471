"""0/1 flags. Every flag is an int and never null."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_flag(condition: Column) -> Column:
    """1 when the condition is true, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def equals_flag(c, value) -> Column:
    return as_flag(F.col(c) == F.lit(value))


def differs_flag(c, value) -> Column:
    """1 when the value differs; a missing value differs from everything."""
    return (~F.col(c).eqNullSafe(F.lit(value))).cast("int")


def in_flag(c, values) -> Column:
    return as_flag(F.col(c).isin(*values))


def contains_flag(c, text) -> Column:
    return as_flag(F.col(c).contains(text))


def null_flag(*columns) -> Column:
    """1 when all given columns are null."""
    return reduce(and_, [F.col(c).isNull() for c in columns]).cast("int")


def present_flag(*columns) -> Column:
    """1 when all given columns are present."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns]).cast("int")


def one_hot(c, values_by_name) -> list[Column]:
    """One equality flag per ``{output name: value}`` entry."""
    return [equals_flag(c, value).alias(name) for name, value in values_by_name.items()]


def numbered(prefix, values) -> dict:
    """``{prefix1: first value, prefix2: second value, ...}`` for :func:`one_hot`."""
    return {f"{prefix}{i}": value for i, value in enumerate(values, start=1)}


def blank_address_flag() -> Column:
    """Address, region and phone missing, and at least one of fixed phone and receiver too."""
    missing = {c: F.col(c).isNull()
               for c in ("addr_id", "region", "phone", "fix_phone", "receiver_md5")}
    either = missing["fix_phone"] | missing["receiver_md5"]
    return (missing["addr_id"] & missing["region"] & missing["phone"] & either).cast("int")
