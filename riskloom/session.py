"""Session settings and the place for intermediate tables."""

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set = set()

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing, _before, _lock = {}, {}, threading.Lock()


def build_session(app_name="riskloom", master=None, **conf) -> SparkSession:
    """A session with adaptive execution on and UTC time.

    Cluster size and shuffle partitions stay with the cluster's own settings
    unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The wide matrix has 197 columns; above the limit Spark gives up whole-stage code.
        "spark.sql.codegen.maxFields": "250",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package, folder = Path(__file__).parent, tempfile.mkdtemp(prefix="riskloom-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it until then
        shutil.copytree(package, f"{folder}/code/riskloom", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/riskloom", "zip", f"{folder}/code"))
        _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder for intermediate tables that all executors reach: ``spark.checkpoint.dir``.

    There is no fallback: a session without one must be given a folder by ``use_folder``.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return configured


def use_folder(spark: SparkSession, folder: str) -> None:
    """Take ``folder`` for intermediate tables unless the session already names one."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, the shuffle files of a query go as soon as it has ended; otherwise they lie on the disks until the driver collects its garbage.

    Threads of a session may overlap: the last to leave puts the setting back.
    """
    key = id(spark)
    with _lock:
        if not _freeing.get(key):
            _before[key] = spark.conf.get(_FREE_SHUFFLES, None)
            spark.conf.set(_FREE_SHUFFLES, "true")
        _freeing[key] = _freeing.get(key, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _freeing[key] -= 1
            if not _freeing[key]:
                del _freeing[key]
                if (before := _before.pop(key)) is None:
                    spark.conf.unset(_FREE_SHUFFLES)
                else:
                    spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str = "stage", **options) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later passes need one expensive result. The lineage is cut, so a
    lost executor costs a re-read, not a recomputation, and Parquet gives later
    passes column pruning and file statistics.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)
