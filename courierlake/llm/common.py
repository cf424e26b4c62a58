"""Helpers that the operators share: tables, the shared folder, skew-proof lookups."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it holds more than one row in so many; so at most that many keys are hot.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A private temporary folder stands in only where the setting is missing and all tasks run
    in the driver's own process; on a cluster a missing setting is an error.
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


_made: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_root(spark)}/courierlake-llm/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends at files that outlive executors.

    The schema comes from the files, so a missing folder raises instead of giving no rows.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_so_far() -> int:
    """A mark for ``clear_stored``."""
    return len(_made)


def clear_stored(spark: SparkSession, since: int = 0, keep_last: bool = False) -> None:
    """Delete what ``stored`` wrote in this process since a mark, the last result excepted if asked.

    Call it when a run's results are written: frames that were built before read it.
    """
    conf, fs = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    end = len(_made) - keep_last
    for made in _made[since:end]:
        path = fs.Path(made)
        path.getFileSystem(conf).delete(path, True)
    del _made[since:end]


def whole_text(text: Column) -> Column:
    """Texts as they count for the operators: null is empty."""
    return F.coalesce(text, F.lit(""))


def lookup(rows: DataFrame, found: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined (inner) to ``found``, which holds one row for each key.

    ``size`` is the column of ``found`` that holds the number of rows of the key, ``total`` the
    number of all rows. Keys with more than a thousandth of all rows are at most a thousand and
    are sent to every task; the others meet in a shuffle join in which no key is hot.
    """
    hot = F.col(size) * HOT_SHARE > F.lit(total)
    common = F.broadcast(found.where(hot))
    rest = found.where(~hot)
    return (
        rows.join(common, key)
        .unionByName(rows.join(F.broadcast(found.where(hot).select(key)), key, "left_anti").join(rest, key))
    )
