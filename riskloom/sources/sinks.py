"""Writers for matrices and score files."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import month_key
from riskloom.operators.clean import months_between

#: Column that a matrix stored by month is partitioned by.
MONTH = "month"


def write_matrix(matrix: DataFrame, path) -> None:
    matrix.write.mode("overwrite").parquet(path)


def write_matrices(labelled: DataFrame, scoring, root, train_months, validation_month) -> dict:
    """Train, validation, full and scoring matrix from one extraction; returns their paths.

    The labelled matrix is written once and the splits are cut from the stored file, side by side. ``scoring`` is a frame,
    or a function that makes it from the stored labelled matrix.
    """
    spark = labelled.sparkSession
    paths = {k: f"{root}/{k}_feature" for k in ("train", "validate", "test", "train_test")}
    write_matrix(labelled, paths["train_test"])
    stored = spark.read.parquet(paths["train_test"])
    cuts = {"train": months_between(stored, *train_months),
            "validate": months_between(stored, validation_month, validation_month),
            "test": scoring(stored) if callable(scoring) else scoring}
    with ThreadPoolExecutor(len(cuts)) as threads:
        # Wrapped one by one: each wrapper holds a copy of the caller's properties.
        waiting = [threads.submit(inheritable_thread_target(spark)(write_matrix), df, paths[k]) for k, df in cuts.items()]
        for written in waiting:
            written.result()
    return paths


def write_monthly(matrix: DataFrame, path, column="appl_sbm_tm") -> None:
    """One matrix in folders by month (``yyyyMM``); rows without a month share one folder of their own.

    Months that the matrix holds are replaced, all others stay, so that a single month can be written again. Rows meet by month
    before they are written, a few files each, split further by id so that a large month is not one task's work.
    """
    spark = matrix.sparkSession
    spread = F.pmod(F.xxhash64("id"), F.lit(16))
    (matrix.withColumn(MONTH, month_key(column)).repartition(F.col(MONTH), spread).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))
    spark.catalog.refreshByPath(path)


def write_bucketed(tables: dict, prefix: str, folder: str, buckets: int, key="id") -> None:
    """Tables bucketed by ``key`` into equal numbers of buckets: files under ``folder``, ``<prefix>_<table>`` in the catalog.

    What is grouped or joined by the key afterwards needs no exchange. Rows meet by bucket before they are written, so there is one file
    a bucket. A table that exists is replaced.
    """
    for name, df in tables.items():
        (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
         .option("path", f"{folder}/{name}").saveAsTable(f"{prefix}_{name}"))


def write_scores(scores: DataFrame, path, fmt="parquet") -> None:
    """Store ``ID, PROB``; ``fmt="csv"`` for a file with a header."""
    writer = scores.select("ID", "PROB").write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.format(fmt).save(path)
