"""Versions of a table under one root, and a pointer to the current one.

A version is written to a folder of its own, and only then the pointer is swapped, in one rename. A
reader sees the old version or the new one; a writer that dies in between leaves the old one in place.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from courierlake.session import exists

POINTER = "CURRENT"


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    info: dict = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that the pointer names, None before the first one."""
    if not exists(spark, f"{root}/{POINTER}"):
        return None
    text = spark.read.text(f"{root}/{POINTER}", wholetext=True).first().value
    return Version(**json.loads(text))


def publish(df: DataFrame, root: str, info: dict | None = None) -> Version:
    """Write ``df`` as the next version and point to it. ``df`` may read the version before."""
    spark = df.sparkSession
    before = current(spark, root)
    number = before.number + 1 if before else 1
    # The folder has a name of its own: what an attempt that died has left is never mixed in.
    version = Version(number, f"{root}/version={number}-{uuid.uuid4().hex[:12]}", info or {})
    df.write.parquet(version.path)
    _swap(spark, root, version)
    return version


def _swap(spark: SparkSession, root: str, version: Version) -> None:
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    pointer, draft = _path(spark, f"{root}/{POINTER}"), _path(spark, f"{root}/.{uuid.uuid4().hex}")
    out = draft.getFileSystem(conf).create(draft)
    out.write(bytearray(json.dumps(version.__dict__).encode()))
    out.close()
    overwrite = spark._sc._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(pointer.toUri(), conf).rename(draft, pointer, overwrite)


def read_current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the current version; none before the first one."""
    version = current(spark, root)
    return spark.read.schema(schema).parquet(version.path) if version else spark.createDataFrame([], schema)


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions older than the last ``keep``; returns how many."""
    version = current(spark, root)
    folder = _path(spark, root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    deleted = 0
    for status in fs.listStatus(folder) if version else []:
        name = status.getPath().getName()
        if name.startswith("version="):
            number = int(name.removeprefix("version=").split("-")[0])
            if number <= version.number - keep:
                deleted += fs.delete(status.getPath(), True)
    return deleted
