"""Dates kept as text in the inputs: guarded parsing, ages and gaps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.flags import as_flag
from riskloom.vocab import ZERO_DATE

# Year, month, day, with an optional time of day. A plain cast would also take '1990' or '1990-5'.
_DATE_TEXT = (r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}"
              r"(\s+([01]?\d|2[0-3]):[0-5]?\d:([0-5]?\d|6[01]))?$")
_TIMESTAMP_LENGTH = len("yyyy-MM-dd HH:mm:ss")
_AGE_BANDS = {"age_one": (0, 18), "age_two": (18, 30), "age_three": (30, 60), "age_four": (60, 100)}
_LONGEST_GAP = 50000


def day_of(c) -> Column:
    """The date at the start of a text, null if there is none."""
    return F.substring(c, 1, 10).try_cast("date")


def is_valid_date(c) -> Column:
    day = F.regexp_extract(c, r"^(\S+)", 1)
    return F.coalesce(F.col(c).rlike(_DATE_TEXT) & day.try_cast("date").isNotNull(), F.lit(False))


def age_in(year, birthday="birthday") -> Column:
    """Age reached in ``year``; 0 when the birthday is not a valid date."""
    born = F.substring(birthday, 1, 4).try_cast("int")
    return F.when(is_valid_date(birthday), F.lit(year) - born).otherwise(F.lit(0))


def age_flags(age="age") -> list[Column]:
    """Age bands (0,18], (18,30], (30,60], (60,100]; ``age_five`` is always 0."""
    flags = [as_flag((F.col(age) > low) & (F.col(age) <= high)).alias(name)
             for name, (low, high) in _AGE_BANDS.items()]
    return [*flags, F.lit(0).alias("age_five")]


def auth_day(c="auth_time") -> Column:
    """Authentication date; null for a missing or zero date."""
    return F.when(F.col(c) != ZERO_DATE, day_of(c))


def effective_auth_day(application_day: Column, c="auth_time") -> Column:
    """Authentication date, or the application date where there is none."""
    return F.coalesce(auth_day(c), application_day)


def full_timestamp_day(c="time_order") -> Column:
    """Date of a text of exactly ``yyyy-MM-dd HH:mm:ss`` length, else null."""
    return F.when(F.length(c) == _TIMESTAMP_LENGTH, day_of(c))


def long_text_day(c="time_order", longer_than=16) -> Column:
    """Date of a timestamp text longer than ``longer_than`` characters, else null."""
    return F.when(F.length(c) > longer_than, day_of(c))


def year_gap(later: Column, earlier: Column) -> Column:
    return F.year(later) - F.year(earlier)


def bounded_gap(one: Column, other: Column) -> Column:
    """Days between two dates, either way; -1 when missing, zero or 50000 and more."""
    days = F.abs(F.datediff(one, other))
    return F.when((days > 0) & (days < _LONGEST_GAP), days).otherwise(F.lit(-1))
