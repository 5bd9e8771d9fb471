"""Aggregate expressions for one ``groupBy(key).agg(...)``.

All of them keep fixed-width state per group, so Spark combines them on the
map side and one hot key never gathers its rows or values in one place.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.vocab import NULL_CATEGORY

_BITS_PER_MASK = 62


def _column(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def any_null(c) -> Column:
    return F.max(_column(c).isNull().cast("int"))


def distinct_with_null(c) -> Column:
    """Number of distinct values; null counts as one value."""
    c = _column(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("bigint"))


def set_length(c) -> Column:
    """Number of distinct values, but 0 when the category ``null`` is among them."""
    c = _column(c)
    has_null = F.max((c == NULL_CATEGORY).cast("int"))
    return F.when(has_null == 1, F.lit(0)).otherwise(F.count_distinct(c)).cast("bigint")


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("bigint")), F.lit(0))


def mask_columns(vocabulary, name) -> list[str]:
    """Names of the mask columns of a vocabulary."""
    return [f"{name}{i}" for i in range(-(-len(vocabulary) // _BITS_PER_MASK))]


def membership_masks(c, vocabulary, name) -> list[Column]:
    """Which vocabulary values a group holds, as bits of one bigint per 62 values.

    One ``bit_or`` replaces one aggregate per value: a 42-value multi-hot costs the
    shuffle eight bytes a group instead of 42 columns. Read it with
    :func:`membership_flags`.
    """
    c = _column(c)
    masks = []
    for i, mask in enumerate(mask_columns(vocabulary, name)):
        chunk = vocabulary[i * _BITS_PER_MASK:(i + 1) * _BITS_PER_MASK]
        place = F.array_position(F.array(*[F.lit(v) for v in chunk]), c).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place - 1)
        masks.append(F.bit_or(F.when(place > 0, bit)).alias(mask))
    return masks


def membership_flags(vocabulary, name, rename=None) -> list[Column]:
    """The 0/1 columns behind :func:`membership_masks`, one per vocabulary value."""
    rename = rename or {}
    flags = []
    for i, value in enumerate(vocabulary):
        mask = F.col(f"{name}{i // _BITS_PER_MASK}")
        bit = F.coalesce(F.getbit(mask, F.lit(i % _BITS_PER_MASK)), F.lit(0)).cast("int")
        flags.append(bit.alias(rename.get(value, value)))
    return flags
