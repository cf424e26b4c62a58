"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Sizes are per task and hold at any data volume; the
# number of shuffle partitions is left to the cluster, and AQE merges or splits them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method above 8000 bytes. Wide cleaning projections exceed that
    # when fused into one stage method; below this limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "courierlake", **conf: str) -> SparkSession:
    """A session with the engine's settings. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    # Recording the Python line of every column expression triples the time to build a plan.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to a session somebody else has built."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    A temporary one stands in only where none is set and all tasks run in this process; executors
    of a cluster would each write to a disk of their own, so there a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _private_root(spark.sparkContext.applicationId)


@cache
def _private_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"courierlake-{application}-")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def file_count(spark: SparkSession, path: str) -> int:
    """How many files lie below a path, markers of committed jobs included."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getFileCount()


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, used by nobody else."""
    _made.append(f"{scratch_root(spark)}/courierlake/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch data of this process; returns the number of paths.

    Call it when a run's results are written: frames that were built before may read scratch data.
    """
    conf, fs = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    for made in _made:
        path = fs.Path(made)
        path.getFileSystem(conf).delete(path, True)
    cleared = len(_made)
    _made.clear()
    return cleared


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives later stages true file
    sizes, so that Spark itself decides which join sides are small enough to broadcast. The
    schema comes from the files: a folder without them raises instead of giving no rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
