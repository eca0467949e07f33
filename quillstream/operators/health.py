"""Run metrics of sources, streaks of empty runs, alarms and data-quality audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import text


def run_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows(keys.., admitted, is_new, is_gated): totals of a run, gated and valid ratios to two digits."""
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if("is_new").alias("new"), F.count_if("is_gated").alias("gated"), F.count_if(~F.col("admitted")).alias("mismatch"))
    ratio = F.col("gated") / F.greatest("total", F.lit(1))
    return out.withColumn("gated_ratio", F.round(ratio, 2)).withColumn("valid_ratio", F.round(1 - ratio, 2))


def zero_streaks(runs: DataFrame, key: str = "source_id", run: str = "run") -> DataFrame:
    """runs(source_id, run, total) with the length of the streak of empty runs that ends there."""
    order = Window.partitionBy(key).orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    block = runs.withColumn("_block", F.sum((F.col("total") > 0).cast("int")).over(order))
    own = Window.partitionBy(key, "_block").orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    return block.withColumn("zero_streak", F.sum((F.col("total") == 0).cast("int")).over(own)).drop("_block")


def inspection_state(runs: DataFrame, key: str = "source_id", run: str = "run") -> DataFrame:
    """The last run of each source with its streak and the alarms it raises."""
    return with_alerts(streak_summary(runs, key, run).drop("all_zero", "n_runs"))


def with_alerts(last: DataFrame) -> DataFrame:
    """Last runs with their streaks, and the alarms they raise."""
    found = text.alerts(F.col("zero_streak"), F.col("gated_ratio"), F.col("valid_ratio"), F.col("mismatch"))
    return last.withColumn("alerts", F.array_join(found, ","))


STREAK = ("zero_streak", "all_zero", "n_runs")


def streak_summary(runs: DataFrame, key: str = "source_id", run: str = "run") -> DataFrame:
    """What a fold needs of some runs(source_id, run, total, ..): the last one's metrics, the streak of empty runs at the
    end, whether all of them are empty, and their number. Summaries of runs that follow each other merge into that of
    both (`merged`), in any grouping."""
    rows = zero_streaks(runs, key, run)
    names = [c for c in runs.columns if c != key]
    last = F.max_by(F.struct(*names, "zero_streak"), run)
    out = rows.groupBy(key).agg(last.alias("_r"), F.count_if(F.col("total") > 0).alias("_filled"), F.count(F.lit(1)).alias("n_runs"))
    return out.select(key, "_r.*", (F.col("_filled") == 0).alias("all_zero"), "n_runs")


def merged(earlier: DataFrame, later: DataFrame, key: str = "source_id") -> DataFrame:
    """Two summaries of one row a source, of which the second's runs come after the first's."""
    names = [c for c in later.columns if c != key]
    old = earlier.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in names])
    rows = later.join(old, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    streak = F.when(F.col("all_zero"), F.col("zero_streak") + F.coalesce("_zero_streak", F.lit(0))).otherwise(F.col("zero_streak"))
    both = {"zero_streak": streak, "all_zero": F.col("all_zero") & F.coalesce("_all_zero", F.lit(True)), "n_runs": F.col("n_runs") + F.coalesce("_n_runs", F.lit(0))}
    has = F.col("n_runs").isNotNull()
    return rows.select(F.when(has, F.col(key)).otherwise(F.col("_key")).alias(key), *[F.when(has, both.get(c, F.col(c))).otherwise(F.col(f"_{c}")).alias(c) for c in names])


def folded(state: DataFrame, runs: DataFrame, key: str = "source_id", run: str = "run") -> DataFrame:
    """A state of summaries after more runs; those not later than a source's last one have been folded before and change
    nothing."""
    known = state.select(F.col(key).alias("_key"), F.col(run).alias("_last"))
    fresh = runs.join(known, F.col(key).eqNullSafe(F.col("_key")), "left").where(F.col("_last").isNull() | (F.col(run) > F.col("_last"))).drop("_key", "_last")
    return merged(state, streak_summary(fresh, key, run).select(*state.columns), key)


def audit(articles: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per source: whether titles are there, dates cover 0.8, no host is foreign, and the count is within its range."""
    rows = articles.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("title", F.lit("")) == "").alias("untitled"),
        F.count_if(F.col("date").isNotNull()).alias("dated"), F.count_if(~F.col("admitted")).alias("foreign"),
    )
    fine = (F.col("untitled") == 0) & (F.col("dated") >= F.col("n") * 0.8) & (F.col("foreign") == 0) & F.col("n").between(F.col("least"), F.col("most"))
    return rows.join(ranges, "source_id").select("source_id", "n", "untitled", "dated", "foreign", fine.alias("passed"))


def article_yield(articles: DataFrame, noise: list[str], least: int = 20) -> DataFrame:
    """Per source: summarized articles with a takeaway long enough and free of noise, as a share, in bands."""
    noisy = F.lit(False)
    for pattern in noise:
        noisy = noisy | F.coalesce(F.col("takeaway"), F.lit("")).rlike(pattern)
    good = F.col("summarized") & (F.length(F.coalesce("takeaway", F.lit(""))) >= least) & ~noisy
    rows = articles.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("n_quality"), F.count_if(noisy).alias("n_noise"))
    share = F.round(F.col("n_quality") / F.col("n"), 4)
    return rows.withColumn("yield", share).withColumn("band", F.when(share >= 0.7, "OK").when(share >= 0.4, "LOW").otherwise("BAD"))


def registry_gaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two registries has."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full_outer").where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), "missing").otherwise("orphan").alias("gap"))
