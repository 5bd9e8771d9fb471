"""Helpers shared by the text operators."""

import atexit
import ctypes
import gc
import shutil
import tempfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import riskloom

BATCH_BYTES = 4 << 20
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set = set()
#: What a Python worker remembers between tasks: functions that forget it, by the module that remembers.
forgetters: dict = {}
_last_user = [None]


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package, folder = Path(riskloom.__file__).parent, tempfile.mkdtemp(prefix="riskloom-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it until then
        shutil.copytree(package, f"{folder}/code/riskloom", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/riskloom", "zip", f"{folder}/code"))
        _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system; allocators would keep it for as long as the worker lives."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def take_over(user: str) -> None:
    """Forget what another operator remembered in this worker."""
    if _last_user[0] not in (None, user):
        for forget in forgetters.values():
            forget()
    _last_user[0] = user


def _tidy(function):
    """``function`` in a worker that starts without other operators' memory and returns its own at the end."""
    user = function.__module__

    def run(batches):
        take_over(user)
        yield from function(batches)
        give_back()
    return run


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that long texts cannot fill a worker."""
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(_BYTES_SETTING, None) is None:
        conf.set(_BYTES_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(_tidy(function), schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(names, replaced) -> list:
    """``names`` but for those that a result column replaces, whatever their case."""
    replaced = {r.lower() for r in replaced}
    return [n for n in names if n.lower() not in replaced]


def whole_text(column="text"):
    """The text, a null one being empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
