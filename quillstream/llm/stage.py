"""Writing a table out in the cluster's shared folder and reading it back, and rows packed by bucket."""

from __future__ import annotations

import functools
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.sources.shared import shared_folder


class _Tables(threading.local):
    """Of a thread: the tables that `written` made inside the pipeline stage that runs, and those of the one before."""

    made: list[str] | None = None
    left: tuple[str, ...] = ()


_tables = _Tables()


def pipeline_stage(function):
    """For stages that run one after the other, each on the stored result of the one before: a stage first deletes the
    tables that `written` made inside the stage before it."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **named) -> DataFrame:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _tables.left:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        _tables.made, _tables.left = [], ()
        try:
            return function(spark, *args, **named)
        finally:
            _tables.made, _tables.left = None, tuple(_tables.made)

    return run


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written as Parquet in the shared folder and read back: cuts lineage, outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _tables.made is not None:
        _tables.made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """A shuffled table of known size in no more tasks than it is worth; large tables keep their partitions."""
    n = max(1, -(-rows // each))
    return df.coalesce(n) if n < partitions(df.sparkSession) else df


def fold(doc_id: str | object, n: int = 5):
    """crc32(doc_id as text) mod n, as a column."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def to_buckets(keys: np.ndarray, columns: list[np.ndarray], buckets: int, deal: np.ndarray | None = None) -> Iterator[tuple[int, list[bytes]]]:
    """Rows dealt by the top bits of their key, or of `deal`: (bucket, [keys, *columns] as bytes), a row for each bucket
    that has any; the order within a bucket stays."""
    bucket = (((keys if deal is None else deal) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    sorted_columns = [c[order] for c in (keys, *columns)]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    ends = np.r_[starts[1:], len(bucket)] if len(bucket) else []
    for a, b in zip(starts, ends, strict=True):
        yield int(bucket[a]), [c[a:b].tobytes() for c in sorted_columns]


def bucket_count(spark: SparkSession, rows: float, each: int = 1 << 20) -> int:
    """Buckets so that each holds about `each` rows, and every shuffle partition a few."""
    return int(max(4 * partitions(spark), -(-rows // each)))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores in front as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) for columns of any name: they go under plain ones and have their own again in run."""
    names = df.columns

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(renamed, schema)
