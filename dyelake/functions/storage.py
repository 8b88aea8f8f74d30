"""Intermediate tables that outlive the executors that made them."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables written since each scratch() that this thread or task has open.
_open: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent and all executors are threads of this process (local runs and tests) a temporary folder
    stands in. On a cluster its absence is an error: executors would each write to their own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-dyelake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which cuts its lineage; ``by`` names columns to partition it by.

    A lost executor then costs a reread of files, not a recomputation of all that came before. Inside scratch() the
    files go when that ends; else they stay until the folder's owner clears it.
    """
    path = _new_path(df.sparkSession)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new_path(spark: SparkSession) -> str:
    path = f"{shared_dir(spark)}/dyelake-{uuid.uuid4().hex}"
    for own in _open.get():
        own.append(path)
    return path


class Bucketed:
    """``df`` as a table in the shared folder, dealt into buckets by ``keys`` and sorted by them within.

    Tables of equal buckets are joined and merged on these keys without a shuffle.
    """

    def __init__(self, df: DataFrame, buckets: int, keys: list[str]):
        self.spark, self.path = df.sparkSession, _new_path(df.sparkSession)
        self.name = "dyelake_" + uuid.uuid4().hex
        df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", self.path).saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Ends the table and deletes its files."""
        self.spark.sql(f"DROP TABLE {self.name}")
        remove(self.spark, self.path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes folders, in whatever store they are."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written() inside are deleted at its end: what is wanted of them must have been written elsewhere by then."""
    own: list[str] = []
    before = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(before)
        remove(spark, *own)
