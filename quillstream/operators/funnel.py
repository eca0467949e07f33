"""The candidate funnel and trials as tables, as of a date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import scoring


def screen_verdict(signals: DataFrame) -> DataFrame:
    """signals(status, has_password, login_phrases, articles, times, dates, h2) with passed and reason."""
    index = reduce(lambda a, b: a + b, [(F.col(c) >= 2).cast("int") for c in ("articles", "times", "dates")])
    reason = (
        F.when(F.col("status") != 200, "not accessible")
        .when(F.col("has_password") | (F.col("login_phrases") >= 2), "login wall")
        .when((index >= 2) | (F.col("h2") >= 3), "index")
        .otherwise("no index")
    )
    return signals.withColumn("index_signals", index).withColumn("reason", reason).withColumn("passed", F.col("reason") == "index")


def index_estimate(times: Column, dates: Column, headings: Column) -> Column:
    return F.greatest(times, dates, F.least(headings, F.lit(20)))


def without(rows: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b.select(key), key, "left_anti"), others, rows)


def trial_queue(candidates: DataFrame, *taken: DataFrame) -> DataFrame:
    """Validated candidates of quality HIGH or MEDIUM that are in none of the tables `taken`, with their priority."""
    rows = without(candidates.where("status = 'validated' and quality in ('HIGH', 'MEDIUM')"), "id", *taken)
    return rows.withColumn("priority", scoring.queue_priority(F.col("quality_score"), F.col("quality"), F.col("fit_score")))


def fill_slots(queue: DataFrame, active: DataFrame, slots: int = 3) -> DataFrame:
    """The best of the queue for the slots that active trials leave free; at most `slots` rows are ranked in one place."""
    best = queue.orderBy(F.desc("priority"), "id").limit(slots)
    free = active.agg((F.lit(slots) - F.count(F.lit(1))).alias("_free"))
    rank = F.row_number().over(Window.orderBy(F.desc("priority"), "id"))
    return best.withColumn("slot", rank).crossJoin(F.broadcast(free)).where("slot <= _free").drop("_free")


def first_of_day(checks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    others = [c for c in checks.columns if c not in keys]
    first = checks.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("r"))
    return first.select(*keys, *[F.col(f"r.{c}").alias(c) for c in others])


def trial_rollup(checks: DataFrame, samples: DataFrame) -> DataFrame:
    """Per trial: articles and days with articles over accessible checks, mean (exact, then of three digits, halves up) and
    number of samples, outcome."""
    seen = F.col("accessible")
    a = checks.groupBy("trial_id").agg(F.coalesce(F.sum(F.when(seen, F.col("article_count"))), F.lit(0)).alias("articles"), F.count_if(seen & (F.col("article_count") > 0)).alias("days"))
    score = scoring.exact(F.col("overall"))
    b = samples.groupBy("trial_id").agg(F.avg(score).alias("mean"), F.count(score).alias("n_samples"))
    rows = a.join(b, "trial_id", "left").withColumn("n_samples", F.coalesce("n_samples", F.lit(0)))
    return rows.withColumn("outcome", scoring.trial_outcome(F.col("days"), F.col("mean"), F.col("n_samples"))).withColumn("mean", scoring.rounded_mean(F.col("mean")))


def decided(trials: DataFrame, rollup: DataFrame, as_of: Column, days: int = 3) -> DataFrame:
    """Trials with their state as of a date: undecided ones that ran for `days` get their outcome and become history."""
    due = (F.date_diff(as_of, F.col("start_date")) >= days) & ~F.coalesce("auto_decided", F.lit(False))
    rows = trials.join(rollup.select("trial_id", F.col("outcome").alias("_outcome")), "trial_id", "left")
    outcome = F.when(due, F.coalesce("_outcome", F.lit("fail_quantity"))).otherwise(F.col("outcome"))
    return rows.withColumn("state", F.when(due | F.coalesce("auto_decided", F.lit(False)), "history").otherwise("active")).withColumn("outcome", outcome).drop("_outcome")


def retry_targets(candidates: DataFrame, handlers: DataFrame, as_of: Column) -> DataFrame:
    """Inaccessible candidates not of LOW quality, without a handler, last tried a day ago or never."""
    last = F.coalesce(F.try_to_timestamp("attempted_at"), F.lit("1970-01-01").cast("timestamp"))
    rows = candidates.where("status = 'inaccessible'").where(~F.col("quality").eqNullSafe("LOW")).where(last <= as_of - F.expr("interval 1 day"))
    return without(rows, "id", handlers)


def recheck_due(candidates: DataFrame, as_of: Column, n: int = 4) -> DataFrame:
    """At most n candidates to be analysed again: never analysed ones first, then the stalest past their cooldown."""
    wait = F.when(F.col("status").isin("rejected", "watchlist"), 30).otherwise(7)
    due = F.col("analysed").isNull() | (F.date_diff(as_of, F.col("analysed")) > wait)
    return candidates.where(due).orderBy(F.asc_nulls_first("analysed"), "id").limit(n)


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def pass_pending(history: DataFrame, candidates: DataFrame, production: DataFrame) -> DataFrame:
    """Candidates whose last trial passed and that are not in production."""
    passed = last_of(history, "id", "seq").where("outcome = 'pass'")
    return without(candidates.join(passed, "id"), "id", production)


def funnel_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def tag_coverage(tags: DataFrame, items: DataFrame) -> DataFrame:
    """Every tag of a small registry with the number of items(tags) that carry it."""
    used = items.select(F.explode(F.array_distinct("tags")).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return tags.join(used.hint("merge"), "tag", "left").select("tag", F.coalesce("n", F.lit(0)).alias("n"))
