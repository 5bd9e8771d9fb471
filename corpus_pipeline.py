"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All but the last
return the columns of ``documents``.
"""

from pyspark.sql import functions as F

from riskloom.llm import decontam, linefreq, packing, quality, setjoin, tokens
from riskloom.session import materialize


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the rules and whose host is not rejected."""
    return quality.keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Every document without its site's boilerplate lines; ``n_chars`` follows the text."""
    cleaned = linefreq.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_duplicate_join(spark, docs, sf_dir):
    """One document of each group of near duplicates, that of the smallest id."""
    return setjoin.one_of_each(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents into which no benchmark item leaks."""
    return decontam.remove_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark, docs, sf_dir):
    """The pieces of all documents in token windows, with their ids."""
    return packing.pack_documents(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each result stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
