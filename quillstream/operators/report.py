"""The candidate report: sections of one table, and rows for its lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import scoring
from quillstream.operators import scan
from quillstream.operators.funnel import last_of, without
from quillstream.operators.status import union_all

# Statuses of the section of seeds, and the constants of production rows.
SEED_STATUSES = ["seed", "discovered", "screened", "screen_failed"]
PRODUCTION = {"quality": "HIGH", "notes": "Active production source"}


def pass_pending_rows(candidates: DataFrame, history: DataFrame, production: DataFrame) -> DataFrame:
    """Candidates not in production whose history has a passed trial, with the last one's days, articles and quality."""
    last = last_of(history.where("outcome = 'pass'").select("id", "seq", "days", "articles", "mean"), "id", "seq")
    return without(candidates, "id", production).join(last.drop("seq"), "id").withColumnsRenamed({"days": "trial_days", "articles": "trial_articles", "mean": "trial_quality"})


def passed_list(pending: DataFrame) -> DataFrame:
    """Every candidate whose trial passed, with its place: best fit first, ties by id."""
    return scan.numbered(pending, [F.coalesce("fit_score", F.lit(0.0)).desc(), F.col("id")], "place")


def report(candidates: DataFrame, active: DataFrame, history: DataFrame, production: DataFrame) -> DataFrame:
    """All rows of the report with their `section`. The queue takes validated candidates of any quality; a candidate on
    trial, passed or in production is not in it. production(id, name), active(id)."""
    pending = pass_pending_rows(candidates, history, production)
    status = lambda *names: candidates.where(F.col("status").isin(*names))
    queue = without(status("validated"), "id", production, active, pending)
    sections = {
        "production": production.select("id", *[F.lit(v).alias(k) for k, v in PRODUCTION.items()]),
        "trials": candidates.join(active.select("id").distinct(), "id", "left_semi"),
        "pass_pending": pending,
        "queue": queue,
        "inaccessible": status("inaccessible"),
        "seed": status(*SEED_STATUSES),
        "rejected": status("rejected"),
    }
    return union_all(*[rows.withColumn("section", F.lit(name)) for name, rows in sections.items()])


def trial_progress(checks: DataFrame, samples: DataFrame, active: DataFrame) -> DataFrame:
    """A line for each active trial: days checked, articles, days with articles, mean quality so far."""
    seen = F.coalesce("accessible", F.lit(False))
    a = checks.groupBy("trial_id").agg(F.count(F.lit(1)).alias("checked"), F.coalesce(F.sum(F.when(seen, F.col("article_count"))), F.lit(0)).alias("articles"), F.count_if(seen & (F.col("article_count") > 0)).alias("days"))
    b = samples.groupBy("trial_id").agg(F.avg(scoring.exact(F.col("overall"))).alias("mean"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = active.select("trial_id").join(a, "trial_id", "left").join(b, "trial_id", "left")
    return rows.select("trial_id", zero("checked"), zero("articles"), zero("days"), scoring.rounded_mean(F.col("mean")).alias("mean"))


def listing_size(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each check's listing, and those with a date."""
    return listings.groupBy(*keys).agg(F.count(F.lit(1)).alias("article_count"), F.count("date").alias("date_count"))


def with_handler(trials: DataFrame, handlers: DataFrame) -> DataFrame:
    """trials with whether a handler of their own counts their articles."""
    own = handlers.select(F.col("source_id").alias("trial_id")).distinct().withColumn("_has", F.lit(True))
    return trials.join(own, "trial_id", "left").withColumn("fetcher_used", F.coalesce("_has", F.lit(False))).drop("_has")


def registry_check(sources: DataFrame, registries: dict[str, DataFrame]) -> DataFrame:
    """(source_id, gap): sources that a registry lacks, and entries of a registry that no source has."""
    out = []
    for name, rows in registries.items():
        keys = rows.select("source_id").distinct()
        out.append(sources.select("source_id").join(keys, "source_id", "left_anti").withColumn("gap", F.lit(f"no {name}")))
        out.append(keys.join(sources.select("source_id"), "source_id", "left_anti").withColumn("gap", F.lit(f"orphan {name}")))
    return union_all(*out)
