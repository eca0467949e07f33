"""Approximate nearest neighbours by largest inner product, with balanced posting lists.

Vectors are divided into bands by their norm, each STEP times the next; within a band they are lifted by one coordinate
so that the largest inner product is the smallest distance (over all norms at once, large ones would hide all others).
Each band has centroids, fitted on a bounded sample by balanced k-means; every vector is put in the posting list of its
nearest centroid and, near a boundary, in those of further centroids whose distance is within REPLICATE of the nearest
one. A band's centroids form a neighbour graph that a task holds in memory; a query walks each, keeps the nearest lists,
and prunes those whose distance ratio to the nearest is above PRUNE. Lists are joined with their queries by list, part
and share: a list longer than its share is dealt over several parts, and the queries of one that many ask over several
shares, so that a hot cluster is read by many tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.stage import written

LIST = 400  # vectors a list holds on average
CENTROIDS = 4_096  # most centroids, reached at CENTROIDS * LIST vectors; beyond, lists grow and are dealt over more parts
FIT = 8  # vectors that a centroid is fitted on, at least
SAMPLE = FIT * CENTROIDS  # most vectors that centroids are fitted on, but for a small share of each band
REPLICATE, COPIES = 1.10, 4  # distance ratio within which a vector is put in further lists, at most so many in all
PROBES, PRUNE = 32, 1.35  # lists that a query reads of each band, at most; distance ratio beyond which they are left
BANDS, STEP = 16, 1.25  # the last band holds all norms below
ASKED = 4_096  # queries of a list that one task answers, about
GRAPH, EF = 24, 64


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vector (array<double>) of rows that take part: not null, no null or non-finite component, not zero."""
    v = F.col(embedding).cast("array<double>")
    fine = v.isNotNull() & F.col(vec_id).isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector")).where(F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def lifted(x: np.ndarray, bound: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(bound - (x * x).sum(1), 0))]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means whose distances grow with the size that a cluster had in the round before, so that none gets far more
    than its share."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    penalty = np.zeros(k)
    for _ in range(rounds):
        own = np.concatenate([(squared(x[a : a + 4096], c) + penalty).argmin(1) for a in range(0, len(x), 4096)])
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        full = size > 0
        c[full] = total[full] / size[full, None]
        c[~full] = x[rng.integers(0, len(x), int((~full).sum()))]
        spread = float(np.mean(squared(x[: min(len(x), 2048)], c).min(1)))
        penalty += 0.1 * spread * (size / (len(x) / k) - 1)
        penalty = np.clip(penalty, -spread, spread)
    return c


class CentroidGraph:
    """Centroids and each one's nearest others; a greedy best-first walk from a few entries finds a query's lists."""

    def __init__(self, centroids: np.ndarray, degree: int = GRAPH):
        self.c = centroids
        d = squared(centroids, centroids)
        np.fill_diagonal(d, np.inf)
        degree = min(degree, len(centroids) - 1)
        self.near = np.argsort(d, axis=1)[:, :degree] if degree > 0 else np.zeros((len(centroids), 0), int)
        # Links both ways keep every centroid reachable from its neighbours.
        links = [set(row) for row in self.near.tolist()]
        for i, row in enumerate(self.near.tolist()):
            for j in row[: max(1, degree // 2)]:
                links[j].add(i)
        self.links = [np.array(sorted(s), int) for s in links]
        self.entries = np.unique(np.linspace(0, len(centroids) - 1, min(16, len(centroids))).astype(int))

    def search(self, q: np.ndarray, n: int, ef: int = EF) -> tuple[np.ndarray, np.ndarray]:
        """(the n nearest centroids found, their squared distances), nearest first."""
        ef = max(ef, n)
        seen = set(self.entries.tolist())
        d = ((self.c[self.entries] - q) ** 2).sum(1)
        todo = sorted(zip(d.tolist(), self.entries.tolist(), strict=True))
        best = [(-a, b) for a, b in todo]
        heapq.heapify(best)
        while todo:
            a, i = heapq.heappop(todo)
            if len(best) >= ef and a > -best[0][0]:
                break
            fresh = [j for j in self.links[i].tolist() if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for a, j in zip(((self.c[fresh] - q) ** 2).sum(1).tolist(), fresh, strict=True):
                if len(best) < ef or a < -best[0][0]:
                    heapq.heappush(todo, (a, j))
                    heapq.heappush(best, (-a, j))
                    if len(best) > ef:
                        heapq.heappop(best)
        found = sorted((-a, j) for a, j in best)[:n]
        return np.array([j for _, j in found], int), np.array([a for a, _ in found])


def banded(vectors: DataFrame) -> tuple[DataFrame, dict[int, int], float]:
    """(vec_id, vector, band), rows of each band, largest squared norm. Vectors of several lengths are an error."""
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    rows = vectors.select("vec_id", "vector", square.alias("_s"))
    bound, shortest, longest = rows.agg(F.max("_s"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if shortest != longest:
        raise ValueError(f"vectors must have one length; there are some of {shortest} and of {longest} components")
    if bound is None:
        return rows.select("vec_id", "vector", F.lit(0).alias("band")), {}, 0.0
    band = F.least(F.floor(F.log(F.lit(bound) / F.col("_s")) / F.lit(2 * math.log(STEP))), F.lit(BANDS - 1)).cast("int")
    rows = rows.select("vec_id", "vector", F.greatest(band, F.lit(0)).alias("band"))
    # At most BANDS rows.
    return rows, {r["band"]: r["n"] for r in rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}, bound


class Index:
    """The bands' graphs; lists are numbered through all bands."""

    def __init__(self, graphs: dict[int, CentroidGraph], bound: float):
        self.graphs, self.bound = dict(sorted(graphs.items())), bound
        self.first, n = {}, 0
        for band, graph in self.graphs.items():
            self.first[band] = n
            n += len(graph.c)
        self.lists = n

    def bound_of(self, band: int) -> float:
        return self.bound / STEP ** (2 * band)

    def search(self, q: np.ndarray, probes: int, prune: float) -> np.ndarray:
        """Lists that a query reads."""
        found = []
        for band, graph in self.graphs.items():
            if probes >= len(graph.c) and np.isinf(prune):
                own = np.arange(len(graph.c))
            else:
                own, d = graph.search(np.append(q, 0.0), probes)
                own = own[np.sqrt(d) <= np.sqrt(d[0]) * prune]
            found.append(own + self.first[band])
        return np.concatenate(found)


def build(rows: DataFrame, counts: dict[int, int], bound: float, sample: int = SAMPLE, list_size: int = LIST) -> Index:
    """Centroids of each band from its share of `sample` vectors, the first by a hash of their vec_id; a centroid for
    `list_size` of the band's rows."""
    total, graphs, index = sum(counts.values()), {}, Index({}, bound)
    most = {band: max(sample // BANDS, sample * n // total) for band, n in counts.items()}
    of = lambda values: F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("band"))
    # One pass for all bands: what can be among a band's first by hash, then its first.
    reach = {band: float(min(1.0, (2 * m + 1000) / counts[band])) for band, m in most.items()}
    picked = rows.withColumn("_h", F.xxhash64("vec_id")).where((F.col("_h") / F.lit(2.0**64) + 0.5) <= of(reach))
    order = F.row_number().over(Window.partitionBy("band").orderBy("_h", "vec_id"))
    own = picked.withColumn("_n", order).where(F.col("_n") <= of(most)).orderBy("band", "_n").select("band", "vector").toArrow()
    bands, vectors = own.column("band").to_numpy(), _matrix(own.column("vector").combine_chunks())
    for band, n in counts.items():
        x = lifted(vectors[bands == band], index.bound_of(band))
        k = max(1, min(max(1, CENTROIDS * n // total), n // list_size, len(x) // FIT))
        graphs[band] = CentroidGraph(balanced_centroids(x, k))
    return Index(graphs, bound)


def posting_lists(rows: DataFrame, index: Index) -> DataFrame:
    """(list, vec_id, vector): each vector in its nearest list and, near a boundary, in a few more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column(2).to_numpy()
            for band in np.unique(bands).tolist():
                c, mine = index.graphs[band].c, np.flatnonzero(bands == band)
                for a in range(0, len(mine), 2048):
                    own = batch.take(pa.array(mine[a : a + 2048]))
                    d = np.sqrt(squared(lifted(_matrix(own.column(1)), index.bound_of(band)), c))
                    near = np.argsort(d, axis=1, kind="stable")[:, : min(COPIES, len(c))]
                    ratio = np.take_along_axis(d, near, 1)
                    keep = ratio <= np.maximum(ratio[:, :1], 1e-12) * REPLICATE
                    keep[:, 0] = True
                    picked = pa.array(np.nonzero(keep)[0])
                    yield pa.RecordBatch.from_arrays([pa.array((near[keep] + index.first[band]).astype(np.int32)), own.column(0).take(picked), own.column(1).take(picked)], names=["list", "vec_id", "vector"])

    return rows.select("vec_id", "vector", "band").mapInArrow(run, "list int, vec_id long, vector array<double>")


def probed_lists(queries: DataFrame, index: Index, probes: int, prune: float) -> DataFrame:
    """(list, query_id, query): the lists that each query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [index.search(q, probes, prune) for q in _matrix(batch.column(1))]
            picked = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            lists = pa.array(np.concatenate(found).astype(np.int32)) if found else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([lists, batch.column(0).take(picked), batch.column(1).take(picked)], names=["list", "query_id", "query"])

    return queries.select("vec_id", "vector").mapInArrow(run, "list int, query_id long, query array<double>")


def _parts(rows: DataFrame, most: int) -> Column:
    """Into how many parts of at most about `most` rows each list is dealt; the counts are one row for each list."""
    more = {r["list"]: -(-r["n"] // most) for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).collect()}
    if not more:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(int(x)) for pair in more.items() for x in pair]), F.col("list")), F.lit(1))


def best_of_lists(key, queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Each query's k best of one part of a list, in blocks; scores are sums of products in double precision."""
    q, x = _matrix(queries.column("query").combine_chunks()), _matrix(rows.column("vector").combine_chunks())
    q_id, x_id = queries.column("query_id").to_numpy(), rows.column("vec_id").to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    for a in range(0, len(q) if len(x) else 0, 512):
        s = q[a : a + 512] @ x.T
        s[q_id[a : a + 512, None] == x_id] = -np.inf
        n = min(k, len(x_id))
        cut = np.partition(s, len(x_id) - n, axis=1)[:, len(x_id) - n, None]
        # The product of matrices may round equal sums differently: near the cut, sums are taken anew, one way for all.
        i, j = np.nonzero((s >= cut - 1e-9 * np.abs(cut)) & (s > -np.inf))
        score = (q[a + i] * x[j]).sum(1)
        order = np.lexsort((x_id[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out[0].append(q_id[a : a + 512][i[keep]])
        out[1].append(x_id[j[keep]])
        out[2].append(score[keep])
    empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), [np.concatenate(o) if o else e for o, e in zip(out, empty, strict=True)], strict=True)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, probes: int = PROBES, prune: float = PRUNE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products found for each query, its own row left out,
    ties to the smaller vec_id; all candidates where they are fewer.

    vectors, queries: (vec_id, vector) as from usable(). Rows repeated with one vec_id count once in a result; an empty
    table gives no rows. All vectors, those of queries among them, must have one length: others are a ValueError.
    """
    rows, counts, bound = banded(vectors)
    if not counts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build(rows, counts, bound)
    lists = written(posting_lists(rows, index), "posting-lists")
    parts = _parts(lists, 4 * LIST)
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))

    def run(key, a: pa.Table, b: pa.Table) -> pa.Table:
        return best_of_lists(key, a, b, k)

    def search(asking: DataFrame, probes: int, prune: float) -> DataFrame:
        asked = written(probed_lists(asking, index, probes, prune), "asked")
        shares = _parts(asked, ASKED)
        asked = asked.withColumn("share", F.pmod(F.xxhash64("query_id"), shares).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        given = dealt.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
        keys = ["list", "part", "share"]
        hits = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
        return written(hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "hits")

    found, read_all = search(queries, probes, prune), False
    while True:
        # Queries with fewer than k hits read further lists, none pruned, until they have k or have read all.
        enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
        short = written(queries.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti").select("vec_id", "vector"), "short")
        if short.isEmpty():
            break
        if read_all:
            break
        read_all, prune = probes >= index.lists, np.inf
        found = written(found.unionByName(search(short, probes, prune)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "found")
        probes *= 8
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann(spark, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
