"""The folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it. Only a local session may go without: it gets a temporary folder; on
    a cluster that would be another folder on every machine, so that is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quill-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_scopes = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What `scratch` and `stored` make inside is deleted at the end: for work whose results do not read it any more. A
    scope inside another deletes its own alone."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for name in stack.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if stack := getattr(_scopes, "stack", None):
        stack[-1].append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table, written as Parquet in the shared folder and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW = 100_000  # rows of a small registry


def by_size(df: DataFrame, most: int = FEW) -> DataFrame:
    """The smaller side of a join, as a table of rules or sources: broadcast where it has at most `most` rows, which are
    counted, else shuffled and merged."""
    return df.hint("broadcast" if df.limit(most + 1).count() <= most else "merge")


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
