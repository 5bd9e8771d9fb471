"""Per-key summaries that mix ordinary aggregates with distinct counts and category sets."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.counts import mask_columns, membership_masks
from riskloom.vocab import NULL_CATEGORY


def with_key(df: DataFrame, key) -> DataFrame:
    """Rows that have a key. Written before a shuffle that several branches share, because a filter
    that Spark infers in one branch only would keep it from being reused."""
    return df.filter(F.col(key).isNotNull())


def _distinct_counts(df: DataFrame, key, columns: dict) -> DataFrame:
    """Distinct non-null values per key: ``key`` and one count per entry of ``columns``.

    Values are laid out one per row and shuffled by (key, value), so a hot key spreads over all
    tasks and no task ever holds its set of values. Nulls are dropped before the shuffle.
    """
    short = {name: f"v{i}" for i, name in enumerate(columns)}
    values = (df.select(key, *[c.cast("string").alias(short[n]) for n, c in columns.items()])
                .unpivot(key, list(short.values()), "kind", "value")
                .filter(F.col("value").isNotNull()).distinct())
    return values.groupBy(key).agg(*[
        F.count_if(F.col("kind") == short[n]).alias(n) for n in columns])


def summarise(df: DataFrame, key, aggregates, distinct=None, set_lengths=None,
              members=None) -> DataFrame:
    """One row per key that is not null.

    ``aggregates``   ordinary aggregates, under their own names.
    ``distinct``     ``{name: column}``: distinct values, null counting as one value.
    ``set_lengths``  ``{name: column}``: distinct values, 0 if the category ``null`` is among them.
    ``members``      ``{name: (category, vocabulary)}``: gives ``name_mask0...`` (see
                     :func:`membership_masks`), ``name_count`` and ``name_len`` (counted as
                     ``set_lengths``). Known values are counted from the masks; only values outside
                     the vocabulary go through the distinct count.

    Ordinary aggregates stay apart from distinct ones: Spark would otherwise carry their inputs and
    states through every copy of a row. Both halves end up partitioned by the key, so joining them
    adds no shuffle.
    """
    distinct, set_lengths, members = distinct or {}, set_lengths or {}, members or {}
    df = with_key(df, key)
    marks = {n: c.isNull() for n, c in distinct.items()}
    marks.update({n: c == NULL_CATEGORY for n, c in set_lengths.items()})
    marks.update({n: c == NULL_CATEGORY for n, (c, _) in members.items()})
    masks = [m for n, (c, vocabulary) in members.items()
             for m in membership_masks(c, vocabulary, f"{n}_mask")]
    plain = df.groupBy(key).agg(*aggregates, *masks, *[
        F.max(condition.cast("int")).alias(f"mark_{n}") for n, condition in marks.items()])
    kept = [c for c in plain.columns if c != key and not c.startswith("mark_")]

    outside = {n: F.when(~c.isin(*vocabulary), c) for n, (c, vocabulary) in members.items()}
    counted = {**distinct, **set_lengths, **outside}
    if not counted:
        return plain.select(key, *kept)
    counts = _distinct_counts(df, key, counted).withColumnsRenamed(
        {n: f"values_{n}" for n in counted})
    number = {n: F.coalesce(F.col(f"values_{n}"), F.lit(0).cast("bigint")) for n in counted}
    for n, (_c, vocabulary) in members.items():
        known = [F.bit_count(F.coalesce(F.col(m), F.lit(0).cast("bigint"))).cast("bigint")
                 for m in mask_columns(vocabulary, f"{n}_mask")]
        number[n] = reduce(add, known, number[n])

    def emptied_by_null(n):
        return F.when(F.col(f"mark_{n}") == 1, F.lit(0).cast("bigint")).otherwise(number[n])

    finished = [(number[n] + F.col(f"mark_{n}")).alias(n) for n in distinct]
    finished += [emptied_by_null(n).alias(n) for n in set_lengths]
    finished += [number[n].alias(f"{n}_count") for n in members]
    finished += [emptied_by_null(n).alias(f"{n}_len") for n in members]
    return plain.join(counts, key, "left").select(key, *kept, *finished)
