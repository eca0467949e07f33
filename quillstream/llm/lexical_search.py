"""Ranked lexical search: the best documents of every query by integer impacts, over all documents.

Documents are indexed where they are read: a task packs what it reads into shards of posting lists, kept to the terms of
the queries, and writes them once; nothing is shuffled. With the corpus' counts known, a shard's postings become impacts,
with one range-maximum sparse table over all its posting lists. A query then searches a shard best-first: an interval of
documents is bounded by the sum of its terms' range maxima; the interval with the highest bound is split at the document
with its largest single impact, which is scored, until no bound can reach the k-th score. Intervals with few postings
are scored whole. A shard gives k documents a query; those are merged by rank, first within salts.

Queries are taken in blocks of a bounded number of terms, each a pass over the documents, so that what a task holds of
them has a size that does not depend on their number.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.exact_dedup import LOWER, UPPER
from quillstream.llm.stage import partitions, written
from quillstream.llm.textcore import _RANDOM, Words, blocks, column_bytes, ragged, spans_hash

K = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
QUERY_TERMS = 1_000_000  # (query, term) pairs in a block of queries
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 18
LEAF = 1024  # postings of an interval that is scored whole
SHARD = "ids array<bigint>, lengths binary, terms binary, counts binary, docs binary, tf binary, with_terms long, all_terms long"

#: Bytes of terms, in lower case; all others as spaces.
_TERM_BYTE = np.full(256, 0x20, np.uint8)
_TERM_BYTE[48:58] = range(48, 58)
_TERM_BYTE[65:91] = range(97, 123)
_TERM_BYTE[97:123] = range(97, 123)
_TERM_BYTE[0x80:] = range(0x80, 0x100)


class Vocabulary:
    """Terms by number, found by hash and verified byte by byte; a term's number is its place in order of hashes."""

    def __init__(self, terms: list[str]):
        data, offsets = column_bytes(pa.array(terms, pa.string()))
        hashes = spans_hash(_RANDOM[data], offsets[:-1], offsets[1:])
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.data, self.starts, self.size = hashes[self.order], data, offsets[:-1][self.order], np.diff(offsets)[self.order]

    def numbers(self, words: Words) -> np.ndarray:
        """The number of each word's term, -1 for others."""
        hashes = words.hashes()
        found = np.full(len(hashes), -1)
        at, size = np.searchsorted(self.hashes, hashes), words.ends - words.starts
        left = np.arange(len(hashes))
        while True:  # one round, but for terms that share a hash
            left = left[at[left] < len(self.hashes)]
            left = left[self.hashes[at[left]] == hashes[left]]
            if not len(left):
                return found
            same = self.size[at[left]] == size[left]
            some = np.flatnonzero(same)
            n = size[left[some]]
            differs = words.data[ragged(words.starts[left[some]], n)] != self.data[ragged(self.starts[at[left[some]]], n)]
            same[np.repeat(some, n)[differs]] = False
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1


class _ShardWriter:
    """Gathers documents with terms of the queries, and the counts over all documents."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids, self.lengths, self.postings, self.docs, self.held, self.with_terms, self.all_terms = [], [], [], 0, 0, 0, 0

    def add(self, ids: pa.Array, words: Words, numbers: np.ndarray, rows: int, size: int) -> None:
        n = np.diff(words.first)
        self.with_terms += int((n > 0).sum())
        self.all_terms += int(n.sum())
        hit = np.flatnonzero(numbers >= 0)
        pair, tf = np.unique(words.row[hit] * size + numbers[hit], return_counts=True)
        row, term = np.divmod(pair, size)
        used = np.unique(row)
        place = np.zeros(rows, np.int64)
        place[used] = self.docs + np.arange(len(used))
        self.ids.append(ids.take(pa.array(used)))
        self.lengths.append(n[used])
        self.postings.append((place[row], term, tf))
        self.docs, self.held = self.docs + len(used), self.held + len(pair)

    def shard(self) -> pa.RecordBatch:
        """One row: documents by doc_id (nulls last), postings by term and document."""
        ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], pa.int64())
        order = pa.compute.sort_indices(ids).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        doc, term, tf = (np.concatenate(x) for x in zip(*self.postings, strict=True)) if self.postings else (np.zeros(0, np.int64),) * 3
        doc = rank[doc]
        by = np.lexsort((doc, term))
        terms, counts = np.unique(term, return_counts=True)
        lengths = np.concatenate(self.lengths)[order] if self.lengths else np.zeros(0, np.int64)
        packed = [lengths.astype("<i8"), terms.astype("<i4"), counts.astype("<i4"), doc[by].astype("<i4"), tf[by].astype("<i8")]
        columns = [pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in packed]]
        columns += [pa.array([self.with_terms]), pa.array([self.all_terms])]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SHARD.split(", ")])


def index(docs: DataFrame, vocabulary) -> DataFrame:
    """Shards of docs(doc_id, text) for the terms of a broadcast Vocabulary."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, writer = vocabulary.value, _ShardWriter()
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                words = Words(_TERM_BYTE[data], offsets)
                writer.add(batch.column("doc_id")[a:b], words, held.numbers(words), b - a, max(1, len(held.hashes)))
                if writer.docs >= SHARD_DOCS or writer.held >= SHARD_POSTINGS:
                    yield writer.shard()
        if writer.all_terms:
            yield writer.shard()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pack, SHARD)


class Postings:
    """Posting lists of a shard, one behind the other by term, with impacts and their range-maximum sparse table."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.docs, self.impacts, self.n_docs = docs.astype(np.int64), impacts, n_docs
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.lists = dict(zip(terms.tolist(), range(len(terms)), strict=True))
        self.keys = np.repeat(np.arange(len(terms)), counts) * (n_docs + 1) + self.docs
        # best[k][i]: place of the largest impact among those at i to i + 2**k - 1, which are read within a list alone.
        self.best = [np.arange(len(docs), dtype=np.int32)]
        width = 1
        while 2 * width <= (counts.max() if len(counts) else 0):
            a, b = self.best[-1][:-width], self.best[-1][width:]
            self.best.append(np.where(impacts[a] >= impacts[b], a, b))
            width *= 2
        # All levels in one array, so that ranges of different lengths are looked up at once.
        self.level = np.cumsum([0, *map(len, self.best)])
        self.table = np.concatenate(self.best)

    def maxima(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(impact, place) of the largest impact of every range that is not empty; (0, -1) of the others."""
        size = right - left
        some = np.flatnonzero(size > 0)
        most, place = np.zeros(len(left), np.int64), np.full(len(left), -1)
        k = np.frexp(size[some])[1] - 1
        a = self.table[self.level[k] + left[some]]
        b = self.table[self.level[k] + right[some] - (1 << k)]
        best = np.where(self.impacts[a] >= self.impacts[b], a, b)
        most[some], place[some] = self.impacts[best], best
        return most, place

    def top(self, terms: list[int], k: int) -> list[tuple[int, int]]:
        """The k best documents as (score, document), highest first, equal scores by document; scores above 0 alone."""
        own = np.array([self.lists[t] for t in terms if t in self.lists], np.int64)
        found: list[tuple[int, int]] = []  # a heap of (score, -document): the worst of the best in front

        def offer(score: int, doc: int) -> None:
            if score > 0:
                (heapq.heappush if len(found) < k else heapq.heappushpop)(found, (score, -doc))

        heap: list[tuple] = []

        def push(a: int, b: int, left: np.ndarray, right: np.ndarray) -> None:
            if a < b:
                most, place = self.maxima(left, right)
                if (bound := int(most.sum())) > 0:
                    heapq.heappush(heap, (-bound, a, b, left, right, int(place[most.argmax()])))

        push(0, self.n_docs, self.starts[own], self.ends[own])
        while heap:
            bound, a, b, left, right, place = heapq.heappop(heap)
            # Documents of the interval have at most this score and come no earlier than a.
            if len(found) == k and (-bound, -a) < found[0]:
                break
            size = right - left
            if size.sum() <= LEAF:
                at = ragged(left, size)
                scores = np.zeros(b - a, np.int64)
                np.add.at(scores, self.docs[at] - a, self.impacts[at])
                least = found[0][0] if len(found) == k else 1
                good = np.flatnonzero(scores >= least)
                good = good[np.argsort(-scores[good], kind="stable")[:k]]
                for score, doc in zip(scores[good].tolist(), (good + a).tolist(), strict=True):
                    offer(score, doc)
                continue
            doc = int(self.docs[place])
            at = np.searchsorted(self.keys, own * (self.n_docs + 1) + doc)
            hit = (at < right) & (self.docs[np.minimum(at, len(self.docs) - 1)] == doc)
            offer(int(self.impacts[at[hit]].sum()), doc)
            push(a, doc, left, at)
            push(doc + 1, b, at + hit, right)
        return [(score, -doc) for score, doc in sorted(found, reverse=True)]


def length_parts(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """The part of each document's length in its impacts; exact beyond 64 bits."""
    distinct, at = np.unique(lengths, return_inverse=True)
    return np.array([10 + (90 * x * n) // total for x in distinct.tolist()], np.int64)[at]


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def search(shards: DataFrame, queries, k: int) -> DataFrame:
    """(query, doc_id, score): the k best documents of each shard for every query. queries: a broadcast of (terms of
    each query, weight of each term, number of documents with terms, number of all terms)."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, weight, n, total = queries.value
        for batch in batches:
            for row in range(len(batch)):
                read = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)  # noqa: B023, E731
                terms, counts, docs, tf = read("terms", "<i4"), read("counts", "<i4"), read("docs", "<i4"), read("tf", "<i8")
                if not len(docs):
                    continue
                ids = batch.column("ids")[row].values
                m = length_parts(read("lengths", "<i8"), n, total)
                impacts = np.repeat(weight[terms], counts) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
                lists = Postings(terms, counts, docs, impacts, len(ids))
                found = [(q, doc, score) for q, own in enumerate(of) for score, doc in lists.top(own, k)]
                number, doc, score = map(list, zip(*found, strict=True)) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), ids.take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    return shards.select("ids", "lengths", "terms", "counts", "docs", "tf").mapInArrow(best, "query int, doc_id long, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item."""
    own = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(own).alias("term")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The k highest-scoring documents of every item: item_id, rank (from 1), doc_id, score (above 0).

    Terms, weights and scores are as the query's contract states; equal scores by ascending doc_id, null last. Null and
    empty texts have no terms: such documents are found by nothing and count in nothing, such items find nothing. Very
    long texts are read whole. Rows that repeat a document are ranked each; rows that share an item_id (or have none) are
    one item with the terms of all of them. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = written(item_terms(items), "item-terms")
    pairs = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-pairs // QUERY_TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    out = []
    for own in range(n_blocks):
        rows = asked.where(block == own).collect()  # some QUERY_TERMS terms, whatever the number of items
        if not rows:
            continue
        held = Vocabulary(sorted({t for r in rows for t in r["terms"]}))
        sent = spark.sparkContext.broadcast(held)
        shards = written(index(docs, sent), "shards")
        n, total = shards.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("all_terms"), F.lit(0))).first()
        df = np.zeros(len(held.hashes), np.int64)
        for r in document_counts(shards).collect():  # at most one row a term
            df[r["term"]] = r["df"]
        number = {t: k for k, t in enumerate(np.array(sorted({t for r in rows for t in r["terms"]}), object)[held.order].tolist())}
        queries = spark.sparkContext.broadcast(([sorted(number[t] for t in r["terms"]) for r in rows], weights(df, n), n, total))
        found = search(shards, queries, k)
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
        out.append(best_of(found, names, k))
    if not out:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    every = out[0]
    for rows in out[1:]:
        every = every.unionByName(rows)
    return every


def document_counts(shards: DataFrame) -> DataFrame:
    """(term, df): documents that hold each term, summed first within a task."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, n = (np.concatenate([np.frombuffer(x.as_py(), "<i4") for x in batch.column(c)]) for c in ("terms", "counts"))
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n.astype(np.int64))], names=["term", "n"])

    return shards.select("terms", "counts").mapInArrow(counts, "term int, n long").groupBy("term").agg(F.sum("n").alias("df"))


def best_of(found: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """Ranks of found(query, doc_id, score). Salts come first: no query has more than k rows a salt in the last step."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(partitions(found.sparkSession))))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "_salt").orderBy(*order))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    # names has a row for each query of the block.
    return last.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
sizes AS (SELECT r, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, total),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weighed AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY term),
scored AS (SELECT q.item_id, s.r, s.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN postings p USING (term) JOIN weighed USING (term) JOIN sizes s ON s.r = p.r GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
