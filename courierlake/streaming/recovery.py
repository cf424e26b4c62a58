"""Crash, resume and replay of a stream by its own checkpoint.

A stream logs what a micro-batch will read, writes it, and commits. The file sink logs the batch too, so
a batch that was written but not committed is found there when it is run again, and not written twice.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

SINK_LOG = "_spark_metadata"


class _Files:
    """The entries of a stream's logs: one small file for each batch, named by its number."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def after(self, folder: str, entry: int) -> list[str]:
        """Paths of the entries behind one. A compacted entry holds earlier ones and can't be taken apart."""
        out = []
        for name in self.names(folder):
            number = re.match(r"\d+", name)
            if number and int(number[0]) > entry:
                if name.endswith(".compact"):
                    raise ValueError(f"{folder}/{name} holds batches before {entry}; start a new checkpoint instead")
                out.append(f"{folder}/{name}")
        return out

    def lines(self, name: str) -> list[str]:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        folder, _, entry = name.rpartition("/")
        self.fs.delete(self.path(name), False)
        self.fs.delete(self.path(f"{folder}/.{entry}.crc"), False)


def last_batch(spark: SparkSession, checkpoint: str, log: str = "commits") -> int:
    """Number of the last batch that was committed (or planned: ``log="offsets"``), -1 for none."""
    names = _Files(spark, checkpoint).names(f"{checkpoint}/{log}")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def forget_commit(spark: SparkSession, checkpoint: str, sink: str | None = None) -> int:
    """Take back the last commit: the checkpoint of a process that died between write and commit.

    With ``sink`` it died a little earlier, when the files were written and not yet in the sink's log.
    """
    batch, files = last_batch(spark, checkpoint), _Files(spark, checkpoint)
    if batch >= 0:
        files.delete(f"{checkpoint}/commits/{batch}")
        for entry in files.after(f"{sink}/{SINK_LOG}", batch - 1) if sink else []:
            files.delete(entry)
    return batch


def rewind(spark: SparkSession, checkpoint: str, sink: str, batch: int) -> list[str]:
    """Undo all batches after ``batch`` of a stopped, stateless stream from one folder of files to another.

    The next run reads again what these batches have read. Entries go from the sink's log first: readers
    then no longer see these rows, and their files are deleted. Returns the deleted data files.
    """
    files = _Files(spark, checkpoint)
    offset = json.loads(files.lines(f"{checkpoint}/offsets/{batch}")[2])["logOffset"]
    forgotten = {
        folder: files.after(folder, entry)
        for folder, entry in (
            (f"{sink}/{SINK_LOG}", batch),
            (f"{checkpoint}/commits", batch),
            (f"{checkpoint}/offsets", batch),
            (f"{checkpoint}/sources/0", offset),
        )
    }
    written = [
        json.loads(line)["path"]
        for entry in forgotten[f"{sink}/{SINK_LOG}"]
        for line in files.lines(entry)
        if line.startswith("{")
    ]
    for entries in forgotten.values():
        for entry in sorted(entries, reverse=True):
            files.delete(entry)
    for path in written:
        files.fs.delete(files.path(path), False)
    return written
