"""Quality rules with host verdicts.

Each document is measured and fails or passes fixed rules. Failures are added up per host; each host's
failure rate is shrunk towards the rate of all hosts with a beta prior fitted to the hosts' own
rates; documents of hosts whose shrunk rate is too high are rejected as well.

Defined cases: a null or empty text has no words and fails. A null host is no host: it takes no
part in the prior and gives no verdict. Repeated rows count and are judged one by one. Columns of the
input are kept except those named like a result column, which the result replaces. An empty table
gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import map_batches, without
from riskloom.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, counted in documents.
PRIOR_STRENGTH = (2.0, 10_000.0)

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*SIGNALS, "base_failed", "host_rate", "host_rejected", "kept")
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\x20\t\n\x0b\x0c\r"


def repeated_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, window, times = np.unique(windows, return_inverse=True, return_counts=True)
    found = times[window] > 1
    if not found.any():
        return 0
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= found
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The signals of one text, in the order of ``SIGNALS``."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters = raw.translate(None, _BLANKS)
    return (len(words), len(letters.decode()), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def document_signals(docs: DataFrame, carry) -> DataFrame:
    """The columns ``carry`` of each document with its signals and ``base_failed``."""
    carry = without(carry, RESULTS)
    source = docs.select(*carry, F.col("text").alias("__text"))
    schema = T.StructType(source.schema.fields[:-1]
                          + [T.StructField(name, T.LongType()) for name in SIGNALS])

    def run(batches):
        for batch in batches:
            rows = [measure(t) for t in batch.column(len(carry)).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(SIGNALS))]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(carry)] + columns, names=[*carry, *SIGNALS])

    return map_batches(source, run, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(signals: DataFrame, host="source") -> DataFrame:
    """One row per host: ``host``, ``host_docs``, ``host_failed``, ``host_rate`` and ``host_rejected``.

    The prior is beta with the mean of all documents and, by the method of moments, the
    spread of the host rates weighted by documents: strength = mean (1 - mean) / spread - 1.
    """
    hosts = (signals.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
             .agg(F.count("*").alias("host_docs"),
                  F.sum(F.col("base_failed").cast("bigint")).alias("host_failed")))
    rate = F.col("host_failed") / F.col("host_docs")
    weight = F.sum("host_docs")
    whole = hosts.agg((F.sum("host_failed") / weight).alias("mean"),
                      (F.sum(F.col("host_docs") * rate * rate) / weight).alias("square"))
    mean, spread = F.col("mean"), F.col("square") - F.col("mean") * F.col("mean")
    low, high = PRIOR_STRENGTH
    strength = F.when(spread > 1e-12, F.least(F.lit(high), F.greatest(
        F.lit(low), mean * (1 - mean) / spread - 1))).otherwise(F.lit(high))
    # Two numbers, read by the driver and written into the expression.
    prior = whole.select("mean", strength.alias("strength")).first()
    if prior["mean"] is None:
        prior = {"mean": 0.0, "strength": high}
    shrunk = ((F.col("host_failed") + F.lit(prior["mean"] * prior["strength"]))
              / (F.col("host_docs") + F.lit(prior["strength"])))
    return hosts.select("host", "host_docs", "host_failed", shrunk.alias("host_rate"),
                        (shrunk > MAX_HOST_RATE).alias("host_rejected"))


def judge_documents(docs: DataFrame, carry, host="source") -> DataFrame:
    """``carry`` with the signals, ``base_failed``, ``host_rate`` and ``kept``.

    The measured rows are stored once; hosts are counted from them and joined back. The
    join moves only what is carried, and Spark splits a hot host's rows.
    """
    wanted = list(dict.fromkeys([*carry, host]))
    measured = materialize(document_signals(docs, wanted), "signals")
    verdicts = materialize(host_verdicts(measured, host), "hosts").select(
        F.col("host").alias("_host"), "host_rate", "host_rejected")
    joined = measured.join(
        verdicts, F.col(host) == F.col("_host"), "left")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(*without(carry, RESULTS), *SIGNALS, "base_failed",
                         F.round("host_rate", 9).alias("host_rate"), kept.alias("kept"))


def keep_good(docs: DataFrame, host="source") -> DataFrame:
    """The documents that neither fail the rules nor belong to a rejected host, as they came in.

    Failing documents are dropped before anything is stored, hosts are counted in the same pass
    over the texts only by their signals.
    """
    signals = materialize(document_signals(docs, [host]), "signals")
    verdicts = materialize(host_verdicts(signals, host), "hosts")
    rejected = verdicts.where("host_rejected").select(F.col("host").alias("_host"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    passed = document_signals(docs.select(row, "text"), ["row"]).where(~F.col("base_failed"))
    return (passed.join(rejected, F.col(f"row.{host}") == F.col("_host"), "left_anti")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
