"""Audit of how five text filters interact, in every order they can be applied.

A table-driven transducer reads the UTF-8 bytes once: a byte's class and the state before it give the next state and
the output (a word opens or closes, a capital, a code point, a symbol). Word spans go into an open-addressing hash table
whose hits are verified byte by byte, which counts a document's distinct words. All rows of a block advance together.

Of a document only the set of filters that it fails matters from there on: the corpus becomes at most 32 counts a part,
and the 120 orders are evaluated on those.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import written
from quillstream.llm.textcore import _RANDOM, blocks, ragged, spans_hash

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, "#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

# Classes of bytes.
BLANK, PLAIN, CAPITAL, SYMBOL, LEAD2, LEAD3, LEAD4, TAIL = range(8)
CLASS = np.full(256, PLAIN, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
CLASS[65:91] = CAPITAL
CLASS[[ord(c) for c in SYMBOLS]] = SYMBOL
CLASS[0x80:0xC0] = TAIL
CLASS[0xC0:0xE0], CLASS[0xE0:0xF0], CLASS[0xF0:] = LEAD2, LEAD3, LEAD4

# States: between words, in a word, and in a word with one to three bytes of a character to come.
BETWEEN, WORD, ONE, TWO, THREE = range(5)
NEXT = np.empty((5, 8), np.uint8)
NEXT[:, [BLANK, PLAIN, CAPITAL, SYMBOL, LEAD2, LEAD3, LEAD4]] = [BETWEEN, WORD, WORD, WORD, ONE, TWO, THREE]
NEXT[:, TAIL] = [WORD, WORD, WORD, ONE, TWO]

OPENS, CLOSES, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16
OUTPUT = np.zeros((5, 8), np.uint8)
OUTPUT[BETWEEN, BLANK + 1 :] |= OPENS
OUTPUT[WORD:, BLANK] |= CLOSES
OUTPUT[:, CAPITAL] |= IS_CAPITAL
OUTPUT[:, SYMBOL] |= IS_SYMBOL
OUTPUT[:, :TAIL] |= IS_POINT


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(output of every byte, state after every byte) of rows that each begin between words.

    Every class but TAIL sets the state by itself, so only tails, of which a character has three at most, need the state
    before them: in each of three rounds the next tail of every character comes right.
    """
    kind = CLASS[data]
    after = NEXT[BETWEEN, kind]
    first = offsets[:-1][np.diff(offsets) > 0]
    tails = np.flatnonzero(kind == TAIL)
    tails = tails[~np.isin(tails, first)] if len(tails) else tails
    for _ in range(3 if len(tails) else 0):
        after[tails] = NEXT[after[tails - 1], TAIL]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[first] = BETWEEN
    return OUTPUT[before, kind], after


class SpanTable:
    """Distinct spans of every row, by open addressing with linear probing over all rows of a block."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray):
        self.data, self.starts, self.size, self.row = data, starts, ends - starts, row
        self.hashes = spans_hash(_RANDOM[data], starts, ends) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a and b are of one row and equal, byte by byte."""
        equal = (self.row[a] == self.row[b]) & (self.size[a] == self.size[b])
        at = np.flatnonzero(equal)
        n = self.size[a[at]]
        differs = self.data[ragged(self.starts[a[at]], n)] != self.data[ragged(self.starts[b[at]], n)]
        equal[np.repeat(at, n)[differs]] = False
        return equal

    def insert(self) -> np.ndarray:
        """Which spans are the first of their kind in their row to be held."""
        n = len(self.starts)
        mask = np.uint64((1 << max(4, (2 * n).bit_length())) - 1)
        table = np.full(int(mask) + 1, -1, np.int64)
        slot = self.hashes & mask
        held, left = np.zeros(n, bool), np.arange(n)
        while len(left):
            free = left[table[slot[left]] < 0]
            table[slot[free[::-1]]] = free[::-1]  # of those that want one free place, the first gets it
            owner = table[slot[left]]
            held[left[owner == left]] = True
            other = left[owner != left]
            left = other[~self.same(other, table[slot[other]])]
            slot[left] = (slot[left] + np.uint64(1)) & mask
        return held


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each row fails."""
    rows = len(offsets) - 1
    output, after = transduce(data, offsets)
    row_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    count = lambda bit: np.bincount(row_of(np.flatnonzero(output & bit)), minlength=rows)
    starts = np.flatnonzero(output & OPENS)
    last = offsets[1:][np.diff(offsets) > 0]
    ends = np.sort(np.concatenate([np.flatnonzero(output & CLOSES), last[after[last - 1] != BETWEEN]]))
    row = row_of(starts)
    words = np.bincount(row, minlength=rows)
    distinct = np.bincount(row[SpanTable(data, starts, ends, row).insert()], minlength=rows)
    fails = (
        words < LEAST_WORDS,
        100 * distinct < DISTINCT_PERCENT * words,
        100 * count(IS_CAPITAL) > CAPITAL_PERCENT * count(IS_POINT),
        count(IS_SYMBOL) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def document_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every row of docs(doc_id, lang, text): bit k is set where the row fails filter k."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                own = batch[a:b]
                columns = [own.column("doc_id"), own.column("part"), own.column("digest"), pa.array(failures(data, offsets), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "digest", "mask"])

    judged = written(plain.mapInArrow(judge, "doc_id long, part string, digest binary, mask int"), "audit")
    # Equal texts: their smallest doc_id, found with partial sums and written, so that a text held by a third of all rows
    # is one row here and the join below has two plain shuffles, whose hot partitions are split.
    copied = judged.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = judged.join(written(copied, "audit-copied").hint("merge"), "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)).cast("int")
    return joined.select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(later, 4)).alias("mask"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part (lang), each of the 120 orders of the filters and each of its five steps.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, as counts of
    documents in the part. Filters: A under 100 words; B distinct words under 80 percent; C more than 10 percent of the
    code points are capitals A-Z; D holds one of #$%&*|; E equals the text of a smaller doc_id anywhere in the table.

    A null text is empty (it fails A alone, and E where a smaller doc_id has no text either); a null lang is the part "",
    and so is an empty one. Very long texts are read whole. Every row counts as a document: rows that repeat a doc_id
    and a text do not fail E by each other; a null doc_id is neither smaller nor larger than any. Of several labels of a
    doc_id any that is 1 counts; rows without a label are neither good nor toxic. An empty table gives no rows; other
    columns are not read.
    """
    judged = document_failures(docs)
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).cast("long").alias(f"_{c}")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    rows = judged.join(written(known, "audit-labels").hint("merge"), "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    cells = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("_quality").alias("good"), total("_toxic").alias("toxic"))
    # At most 32 cells a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    each = parts.select("part", "cells", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order"))
    each = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    earlier = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    bits = lambda letters: sum(F.contains(letters, F.lit(f)).cast("int") * (1 << k) for k, f in enumerate(FILTERS))
    each = each.select("*", letter.alias("_filter"), bits(letter).alias("_own"), bits(earlier).alias("_before"))

    def summed(condition, field: str = "n") -> Column:
        return F.aggregate(F.filter("cells", lambda c: condition(c["mask"])), F.lit(0).cast("long"), lambda total, c: total + c[field])

    own, before = F.col("_own"), F.col("_before")
    here = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    each = each.select(
        "part", "filter_order", "step", "_filter",
        summed(lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        summed(here).alias("removed"),
        summed(lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        summed(lambda m: m == own).alias("unique_fails"),
        summed(here, "good").alias("good_lost"),
        summed(here, "toxic").alias("toxic_lost"),
    )
    # 120 rows for each part and filter.
    return each.withColumn("shapley", F.expr("sum(removed) over (partition by part, _filter)")).drop("_filter")


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
counted AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
judged AS (SELECT doc_id, part, (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > first_id, false)::INT AS mask FROM counted),
known AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, 1 << (instr('ABCDE', substr(filter_order, step, 1))::INT - 1) AS own,
    list_sum([0] || list_transform(range(1, step), lambda i: 1 << (instr('ABCDE', substr(filter_order, i, 1))::INT - 1)))::INT AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step)),
summed AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM summed
"""
