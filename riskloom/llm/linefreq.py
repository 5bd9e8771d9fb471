"""Removal of boilerplate lines by their frequency within a site.

For each host the pages that contain a line are divided by all pages of the host; lines above the ratio
are boilerplate and are dropped from every page of that host. Built-in expressions only.

How it holds at scale: lines are counted by (host, digest) with partial sums before the shuffle, so
neither a hot host nor a line on all its pages gathers in one task. A host has at most
``mean lines per page / ratio`` boilerplate lines, so they travel to its pages as one bounded array.

Defined cases: a line is what stands between line ends; lines without a character other than ASCII
blanks are never dropped. Lines are told apart by their 128-bit MD5. A line that
repeats within a page counts once. A null or empty text stays as it is. Pages without a host keep all
lines. Repeated rows are separate pages. Columns named like a result column are replaced.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, without
from riskloom.session import materialize

#: Share of a host's pages above which a line is boilerplate.
MAX_RATIO = 0.2
#: Pages that must hold a line before its ratio means anything.
MIN_PAGES = 5


def _has_word(line):
    return line.rlike(r"[^\x20\x09-\x0D]")


def _digest(line):
    return F.unhex(F.md5(line))


def boilerplate_lines(pages: DataFrame, host="source", text="text", max_ratio=MAX_RATIO,
                      min_pages=MIN_PAGES) -> DataFrame:
    """One row per host with boilerplate: ``host`` and ``lines``, an array of line digests."""
    known = pages.where(F.col(host).isNotNull())
    lines = known.select(F.col(host).alias("host"), F.explode(F.array_distinct(
        F.filter(F.split(text, "\n"), _has_word))).alias("line"))
    counts = (lines.groupBy("host", _digest(F.col("line")).alias("digest"))
              .agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages))
    totals = known.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_pages"))
    return (counts.join(totals, "host")
            .where(F.col("n_pages") > max_ratio * F.col("host_pages"))
            .groupBy("host").agg(F.sort_array(F.collect_list("digest")).alias("lines")))


def drop_boilerplate(pages: DataFrame, host="source", text="text", **rules) -> DataFrame:
    """``pages`` with the cleaned text, and ``n_lines`` and ``n_dropped`` of each page."""
    found = materialize(boilerplate_lines(pages, host, text, **rules), "boilerplate")
    key, drop = fresh(pages, "_host"), fresh(pages, "_lines")
    found = found.select(F.col("host").alias(key), F.col("lines").alias(drop))
    joined = pages.join(found, F.col(host) == F.col(key), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda line: ~_has_word(line) | ~F.array_contains(drop, _digest(line)))
    cleaned = F.when(F.col(drop).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    size = F.coalesce(F.size(lines), F.lit(0)).cast("bigint")
    dropped = F.when(F.col(drop).isNull() | F.col(text).isNull(), F.lit(0)).otherwise(
        F.size(lines) - F.size(kept)).cast("bigint")
    others = [F.col(f"`{c}`") for c in without(pages.columns, (text, "n_lines", "n_dropped"))]
    return joined.select(*others, cleaned.alias(text),
                         F.when(F.col(text).isNull(), F.lit(0)).otherwise(size).cast("bigint").alias("n_lines"),
                         dropped.alias("n_dropped"))
