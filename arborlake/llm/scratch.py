"""Tables that cut lineage, in the folder which all executors share.

A table stays until ``drop`` or ``only`` says that nothing reads it any more: results are lazy
and read theirs when they are asked for. What is left is deleted when the driver's process ends.
An empty table, nulls and any column names are written as they are.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_left: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a temporary one, but only if driver and executors are one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if context.applicationId not in _local:
            _local[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='arborlake')}"
        folder = _local[context.applicationId]
    return folder.rstrip("/")


def _delete(spark: SparkSession, uri: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def delete_matching(spark: SparkSession, pattern: str) -> None:
    """Delete the files that a glob pattern names, in any store that Spark writes to."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in store.globStatus(path) or []:
        store.delete(status.getPath(), True)


@atexit.register
def _clear() -> None:
    for folder, spark in _left.items():
        with contextlib.suppress(Exception):  # the session may be gone, and its file systems with it
            _delete(spark, folder)


class Scratch:
    """A folder of one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.tables: set[str] = set()
        _left[self.folder] = spark

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.folder}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read again: lost executors cost no recomputation beyond it."""
        out = self.path(name)
        df.write.parquet(out)
        kept = self.spark.read.schema(df.schema).parquet(out)
        kept.scratch_path = out
        self.tables.add(out)
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables which nothing reads any more."""
        for t in tables:
            self.tables.discard(t.scratch_path)
            _delete(self.spark, t.scratch_path)

    def only(self, *tables: DataFrame) -> None:
        """Delete all tables of this run but these, which the result reads."""
        for path in self.tables - {t.scratch_path for t in tables}:
            _delete(self.spark, path)
        self.tables = {t.scratch_path for t in tables}
