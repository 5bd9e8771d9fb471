"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.vocab import CARRIER_PREFIXES, NULL_CATEGORY, NULL_TOKENS
from riskloom.functions.flags import as_flag


def without_null_tokens(c) -> Column:
    """Turn the texts that stand for "missing" into null."""
    return F.when(F.col(c).isin(*NULL_TOKENS), F.lit(None)).otherwise(F.col(c))


def null_as_category(c) -> Column:
    return F.coalesce(F.col(c), F.lit(NULL_CATEGORY))


def region_prefix(c="region") -> Column:
    """First two characters of the region (its province); ``null`` when missing."""
    return F.coalesce(F.substring(c, 1, 2), F.lit(NULL_CATEGORY))


def first_character(c, missing="-1") -> Column:
    return F.coalesce(F.substring(c, 1, 1), F.lit(missing))


def month_key(c) -> Column:
    """``yyyyMM`` of a ``yyyy-MM-dd ...`` text."""
    return F.substring(F.replace(F.substring_index(c, " ", 1), F.lit("-"), F.lit("")), 1, 6)


def short_month_key(c, missing="00000000") -> Column:
    """``yyMM`` of a ``yyyy-MM-dd ...`` text."""
    return F.coalesce(F.concat(F.substring(c, 3, 2), F.substring(c, 6, 2)), F.lit(missing))


def carrier_flags(c="phone") -> list[Column]:
    """Mobile-network flags from the first three digits of a phone number."""
    start = F.substring(c, 1, 3)
    return [as_flag(start.isin(*values)).alias(name) for name, values in CARRIER_PREFIXES.items()]
