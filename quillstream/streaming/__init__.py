"""State between runs as streams: ids seen, and streaks of empty runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstream.sources import shared
from quillstream.sources.keyed import KeyedTable, Manifest


def first_seen(articles: DataFrame, event_time: str, delay: str = "30 days") -> DataFrame:
    """Each id once; state is kept for `delay` of event time."""
    return articles.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id"])


def unseen(batch: DataFrame, table: KeyedTable, manifest: Manifest) -> DataFrame:
    """Distinct rows of a batch (a stored table, one row an id) whose id the table's version does not hold. Ids that the
    filters of their bucket rule out are new; only parts that may hold one of the others are read."""
    return batch.join(table.stored_keys(batch.select(table.key), manifest).hint("merge"), table.key, "left_anti")


def ingest_stream(articles: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends new articles to a plain Parquet table, whose ids every micro-batch reads: for small ones. A table that grows
    is a keyed one, see `ingest_keyed_stream`."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(["id"])
        path = spark._jvm.org.apache.hadoop.fs.Path(table)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            fresh = fresh.join(spark.read.parquet(table).select("id"), "id", "left_anti")
        fresh.write.mode("append").parquet(table)

    return articles.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_keyed_stream(articles: DataFrame, table: KeyedTable, checkpoint: str, name: str = "ingest") -> StreamingQuery:
    """Adds new articles to a keyed table with sketches: each micro-batch is made distinct by id and held against the ids
    of its buckets. A batch that is run again after a failure finds its number in the manifest and adds nothing."""

    def add(batch: DataFrame, number: int) -> None:
        with shared.scratch_scope(batch.sparkSession):
            fresh = shared.stored(batch.dropDuplicates([table.key]), "batch")
            table.append(lambda manifest: unseen(fresh, table, manifest), commit=(name, number))

    return articles.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def zero_streak_stream(runs: DataFrame) -> DataFrame:
    """runs(source_id, run, total) as a stream to (source_id, run, total, zero_streak), in the order of run in each
    batch; a run not later than the last one of its source is left out."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, streak = state.get if state.exists else (-1, 0)
        rows = pd.concat(list(frames)).sort_values("run")
        out = []
        for run, total in zip(rows["run"].tolist(), rows["total"].tolist(), strict=True):
            if run > last:
                last, streak = run, 0 if total > 0 else streak + 1
                out.append((key[0], run, total, streak))
        state.update((last, streak))
        yield pd.DataFrame(out, columns=["source_id", "run", "total", "zero_streak"])

    grouped = runs.select("source_id", F.col("run").cast("long").alias("run"), F.col("total").cast("long").alias("total")).groupBy("source_id")
    return grouped.applyInPandasWithState(update, "source_id string, run long, total long, zero_streak long", "last long, streak long", "append", "NoTimeout")
