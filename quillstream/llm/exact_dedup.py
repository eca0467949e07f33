"""Exact deduplication by a tree merge of sorted digest runs. DataFrame operations only.

Rows are dealt into runs by a hash of doc_id. A run keeps, sorted by digest, the smallest and the largest identifier and
the number of copies of every digest. Runs are exchanged in binomial rounds: in each, the FAN runs whose numbers differ
in the next log2(FAN) bits alone (as many rounds of pairs at once) are merged into one, which is written sorted, until
one run is left (spread over all partitions by digest, never in one task); then the result goes down the same tree by
merge joins. A run's merge is one of sorted rows: they are exchanged, sorted and merged where they are next to each other,
without a hash table, so that it spills. A digest held by a third of all rows is thus at most FAN rows per key in every merge and every join, whatever its count.

A digest is SHA-256 with the text's length and a second, independent hash beside it: identifiers are kept for equal
values of all three at every level, so that no identifier stands for a text that merely shares one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import free_name, partitions, written

FAN = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sorted_run(rows: DataFrame, key: list[str]) -> DataFrame:
    """A level's runs, written with the rows of every partition sorted by run and digest."""
    return written(rows.sortWithinPartitions("_run", *key), "runs")


def tree_merge(rows: DataFrame, key: list[str], id_column: str, runs: int, fan: int = FAN) -> DataFrame:
    """For rows(key.., id): the rows with smallest_id, largest_id and group_size of their key.

    Runs are exchanged in rounds, `fan` (a power of two) into one, with partial sums at every level; no key has more
    than `fan` rows in a merge, nor more than its copies in one run in the last join.
    """
    bits = fan.bit_length() - 1
    rows = rows.withColumn("_run", F.pmod(F.xxhash64(F.col(id_column)), F.lit(runs)))
    sums = lambda least, most, n: [least.alias("smallest_id"), most.alias("largest_id"), n.alias("group_size")]
    # Structs are merged in sorted order; a null is none of them.
    of = lambda aggregate, c: aggregate(F.when(F.col(c).isNotNull(), F.struct(c)))[c]
    levels = [sorted_run(rows.groupBy("_run", *key).agg(*sums(F.min(id_column), F.max(id_column), F.count(F.lit(1)))), key)]
    while runs > 1:
        runs = -(-runs // fan)
        merged = levels[-1].withColumn("_run", F.shiftright("_run", bits)).groupBy("_run", *key)
        levels.append(sorted_run(merged.agg(*sums(of(F.min, "smallest_id"), of(F.max, "largest_id"), F.sum("group_size"))), key))
    top = levels.pop()
    while levels:
        parent = top.select(F.col("_run").alias("_parent"), *key, "smallest_id", "largest_id", "group_size")
        child = levels.pop().select("_run", *key, F.shiftright("_run", bits).alias("_parent"))
        top = child.join(parent.hint("merge"), ["_parent", *key]).drop("_parent")
    return rows.join(top.hint("merge"), ["_run", *key]).drop("_run")


VERIFIED = ["text_sha256", "text_bytes", "text_check"]


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Groups of equal texts (equal after lower-casing A-Z only); of each, the row with the largest doc_id stays.

    Returns doc_id, keep_id, smallest_id, group_size, kept, text_sha256. A null text counts as empty, and empty texts
    are equal. Very long texts are digested whole. Rows that repeat both doc_id and text are copies of one document:
    all count in group_size, and those with the largest doc_id are all marked kept. A null doc_id never wins against
    a number; where a group has no other, keep_id is null and its rows are kept. An empty table gives no rows; other
    columns are not read.
    """
    own = normalised(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(own, 256).alias("text_sha256"), F.octet_length(own).alias("text_bytes"), F.xxhash64(own).alias("text_check"))
    rows = written(rows, "digests")
    runs = FAN ** max(1, len(f"{partitions(docs.sparkSession) - 1:o}"))
    merged = tree_merge(rows, VERIFIED, "doc_id", runs)
    return merged.select("doc_id", F.col("largest_id").alias("keep_id"), "smallest_id", "group_size", F.col("doc_id").eqNullSafe(F.col("largest_id")).alias("kept"), "text_sha256")


def row_key(digest: Column) -> Column:
    """One key for a row's doc_id, which may be null, and its text's digest."""
    return F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest), 256)


def one_of_each_key(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Of docs(.., key), one row for each key in kept(_key), without that column: the smallest by all columns. Rows that
    repeat a key are merged before they are exchanged."""
    columns = [c for c in docs.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    orderable = not any(t in docs.schema.simpleString() for t in ("map<", "variant", "interval"))
    one = docs.groupBy(F.col(key).alias("_key")).agg((F.min(row) if orderable else F.first(row)).alias("_row"))
    return one.join(kept.hint("merge"), "_key", "left_semi").select("_row.*")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, all columns; one of rows that share doc_id and text."""
    kept = exact_dedup(docs).where("kept").select(row_key(F.col("text_sha256")).alias("_key")).distinct()
    key = free_name(docs, "_key")
    return one_of_each_key(docs.withColumn(key, row_key(text_digest(F.col("text")))), kept, key)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
