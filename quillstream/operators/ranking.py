"""Ranking quality of scored pages, and many weight vectors in one job."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillstream.functions import scoring
from quillstream.operators import scan
from quillstream.sources import shared

GOOD, BAD = "label = 'good'", "label = 'bad'"


def top_entrypoints(pages: DataFrame, key: str, pos: str, least: float = 0.5, n: int = 3) -> DataFrame:
    """At most n pages of each key with final_score of at least `least`; the first is active and gives the fit."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("final_score"), pos))
    return pages.where(F.col("final_score") >= least).withColumn("rn", rank).where(F.col("rn") <= n).withColumn("active", F.col("rn") == 1)


def _counts() -> list:
    hit = "final_score >= 0.5"
    return [
        F.count_if(F.expr(GOOD)).alias("n_good"),
        F.count_if(F.expr(BAD)).alias("n_bad"),
        F.count_if(F.expr(f"{GOOD} and {hit}")).alias("good_above"),
        F.count_if(F.expr(f"{BAD} and not {hit}")).alias("bad_below"),
        F.avg(F.when(F.expr(GOOD), F.col("final_score"))).alias("avg_good"),
        F.avg(F.when(F.expr(BAD), F.col("final_score"))).alias("avg_bad"),
    ]


def quality_per_fund(scored: DataFrame, keys: tuple[str, ...] = ("fund_id",), digits: int = 4) -> DataFrame:
    """Precision (1.0 without good pages), reject rate (0.0 without bad ones), means and their separation."""
    rows = scored.groupBy(*keys).agg(*_counts())
    mean_good = F.coalesce("avg_good", F.lit(0.0))
    separation = F.when(F.col("n_bad") > 0, mean_good - F.coalesce("avg_bad", F.lit(0.0))).otherwise(mean_good)
    return rows.select(
        *keys, "n_good", "n_bad", "good_above", "bad_below",
        F.round(F.when(F.col("n_good") > 0, F.col("good_above") / F.col("n_good")).otherwise(1.0), digits).alias("precision"),
        F.round(F.when(F.col("n_bad") > 0, F.col("bad_below") / F.col("n_bad")).otherwise(0.0), digits).alias("reject_rate"),
        F.round(mean_good, digits).alias("avg_good"), F.round(F.coalesce("avg_bad", F.lit(0.0)), digits).alias("avg_bad"), F.round(separation, digits).alias("separation"),
    )


def _overall(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    p = F.when(F.col("n_good") > 0, F.col("good_above") / F.col("n_good")).otherwise(0.0)
    r = F.when(F.col("n_bad") > 0, F.col("bad_below") / F.col("n_bad")).otherwise(0.0)
    return rows.select(*keys, "n_good", "n_bad", F.round(p, 4).alias("precision"), F.round(r, 4).alias("reject_rate"), F.round(p * 0.6 + r * 0.4, 4).alias("overall"))


def overall(scored: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pooled precision and reject rate (0.0 without rows) and 0.6 of one plus 0.4 of the other."""
    return _overall(scored.groupBy(*keys).agg(*_counts()), keys)


def ranking_report(scored: DataFrame, digits: int = 4) -> DataFrame:
    """Every fund's quality and the pooled row, from one pass: pooled tells the last from a fund without an id. The pooled
    row takes 0.0 where there is nothing to count, as overall does, a fund's precision 1.0; overall is the pooled row's
    alone. A table without rows has a pooled row of zeros."""
    # The pooled row is there whatever scored holds.
    empty = scored.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in scored.schema.fields], F.lit(False).alias("_real"))
    rows = scored.withColumn("_real", F.lit(True)).unionByName(empty)
    rows = rows.rollup("fund_id").agg(F.grouping_id().alias("_pool"), F.count_if("_real").alias("_n"), *_counts()).where("_pool = 1 or _n > 0")
    pooled = F.col("_pool") == 1
    share = lambda hit, n, none: F.when(F.col(n) > 0, F.col(hit) / F.col(n)).otherwise(none)
    p, r = share("good_above", "n_good", F.when(pooled, 0.0).otherwise(1.0)), share("bad_below", "n_bad", F.lit(0.0))
    mean_good = F.coalesce("avg_good", F.lit(0.0))
    separation = F.when(F.col("n_bad") > 0, mean_good - F.coalesce("avg_bad", F.lit(0.0))).otherwise(mean_good)
    return rows.select(
        "fund_id", pooled.alias("pooled"), "n_good", "n_bad", "good_above", "bad_below", F.round(p, digits).alias("precision"), F.round(r, digits).alias("reject_rate"),
        F.when(~pooled, F.round(mean_good, digits)).alias("avg_good"), F.when(~pooled, F.round(F.coalesce("avg_bad", F.lit(0.0)), digits)).alias("avg_bad"), F.when(~pooled, F.round(separation, digits)).alias("separation"),
        F.when(pooled, F.round(p * 0.6 + r * 0.4, 4)).alias("overall"),
    )


def weight_grid(spark, step: int = 10) -> DataFrame:
    """All weight vectors in steps of 1/step within 0.05 and 0.6 that sum to 1; a few hundred rows at most."""
    one = spark.range(1, step).select(F.col("id").cast("int").alias("k"))
    grid = one.select(F.col("k").alias("a")).crossJoin(one.select(F.col("k").alias("b"))).crossJoin(one.select(F.col("k").alias("c")))
    grid = grid.withColumn("d", F.lit(step) - F.col("a") - F.col("b") - F.col("c"))
    names = dict(zip(("domain", "path", "structure", "gate"), "abcd", strict=True))
    grid = grid.select(*[(F.col(c) / float(step)).alias(n) for n, c in names.items()], (F.col("a") * 10000 + F.col("b") * 100 + F.col("c")).alias("weight_id"))
    return grid.where(" and ".join(f"{n} between 0.05 and 0.6" for n in names))


SWEEP_BLOCK = 100_000  # weight vectors that are tried in one pass over the pages
_CHUNK = 64


def _rated(parts: np.ndarray, whole: np.ndarray, stored: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whether each page (row) reaches 0.5 under each weight vector (column): as scoring.rescored, which rounds to four
    digits, so that 0.49995 reaches it."""
    d, p, s, g = (parts[:, k, None] for k in range(4))
    found = d * weights[0] + p * weights[1] + s * weights[2] + (1 - g) * weights[3]
    return np.where(whole[:, None], found >= 0.49995, stored[:, None] >= 0.5)


def sweep(labelled: DataFrame, weights: DataFrame) -> DataFrame:
    """The overall row of every weight vector of weights(weight_id, domain, path, structure, gate). Each task scores its
    pages under all vectors, a few at a time, and gives one row of counts a vector, which are summed: pages are not
    multiplied by vectors. Of more than SWEEP_BLOCK vectors each block is a pass over the pages."""
    spark = labelled.sparkSession
    names = list(scoring.WEIGHTS)
    stored = shared.stored(weights.select("weight_id", *[F.col(n).cast("double") for n in names]), "weights")
    blocks = max(1, -(-stored.count() // SWEEP_BLOCK))
    columns = [f"{n}_score" for n in names[:3]] + ["gate_penalty"]
    rows = labelled.select("label", *[F.col(c).cast("double") for c in ("final_score", *columns)])
    kind = stored.schema["weight_id"].dataType
    arrow = to_arrow_type(kind)
    counted = []
    for block in range(blocks):
        own = stored.where(F.pmod(F.xxhash64("weight_id"), F.lit(blocks)) == block).toPandas()  # some SWEEP_BLOCK rows
        vectors = spark.sparkContext.broadcast((own[names].to_numpy(float).T.copy(), own["weight_id"].to_list()))

        def count(batches: Iterator[pa.RecordBatch], vectors=vectors) -> Iterator[pa.RecordBatch]:
            w, ids = vectors.value
            above, below, totals = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), [0, 0]
            for batch in batches:
                good, bad = (pc.fill_null(pc.equal(batch.column("label"), label), False).to_numpy(zero_copy_only=False) for label in ("good", "bad"))
                raw = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns], 1)
                missing = np.stack([batch.column(c).is_null().to_numpy(zero_copy_only=False) for c in columns], 1).any(1)
                final = pc.fill_null(batch.column("final_score"), 0.0).to_numpy(zero_copy_only=False)
                totals = [totals[0] + int(good.sum()), totals[1] + int(bad.sum())]
                for a in range(0, len(ids), _CHUNK):
                    hit = _rated(raw, ~missing, final, w[:, a : a + _CHUNK])
                    above[a : a + _CHUNK] += hit[good].sum(0)
                    below[a : a + _CHUNK] += (~hit[bad]).sum(0)
            n = len(ids)
            yield pa.RecordBatch.from_pydict({"weight_id": pa.array(ids, arrow), "n_good": [totals[0]] * n, "n_bad": [totals[1]] * n, "good_above": above, "bad_below": below})

        counted.append(rows.mapInArrow(count, f"weight_id {kind.simpleString()}, n_good long, n_bad long, good_above long, bad_below long"))
    sums = reduce(DataFrame.unionByName, counted).groupBy("weight_id").agg(*[F.sum(c).alias(c) for c in ("n_good", "n_bad", "good_above", "bad_below")])
    return _overall(sums, ("weight_id",))


def progress(experiments: DataFrame) -> DataFrame:
    """experiments(seq, yield) with status: IMPROVED on the best before, else SAME."""
    rows = scan.prefix_scan(experiments, [F.col("seq")], {"_best": (scan.MAX, F.col("yield"))}, exclusive=True)
    return rows.withColumn("status", F.when(F.col("_best").isNull() | (F.col("yield") > F.col("_best")), "IMPROVED").otherwise("SAME")).drop("_best")


def is_saturated(experiments: DataFrame, n: int = 5) -> DataFrame:
    last = experiments.orderBy(F.desc("seq")).limit(n)
    return last.agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("status") == "SAME") == n).alias("saturated"))
