"""The daily run in one piece: ingest, content, analysis and published tables over one evolving store.

Each stage takes up what the store says is pending and writes back by key, so that a run may be repeated or broken off
anywhere: articles are added once, bodies that were had are not fetched again, failed ones are tried on the next day, and
what is published is replaced as a whole when it is ready.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream import sources
from quillstream.functions import text, urls
from quillstream.operators import bodies, health, ingest, scan, status, views
from quillstream.sources import shared
from quillstream.sources.keyed import KeyedTable
from quillstream.streaming import unseen

ARTICLE = "id string, source_id string, source_name string, title string, url string, date date, date_raw string, fetched_at string, summarized boolean, seq long, category string, summary string, content_status string, summary_en string, themes array<string>, key_takeaway_en string, analysis_model string, analysis_confidence string"
LISTED = "source_id string, source_name string, title string, url string, date date, date_raw string, pos long, gated boolean, category string, summary string"
RUN = "source_id string, run date, total long, new long, mismatch long, gated_ratio double, valid_ratio double"
PUBLISHED = {
    "timeline": ("id string, source_id string, title string, date date, position long, visible boolean, remaining long", "id"),
    "clusters": ("cluster string, id string, position long", "id"),
    "funds": ("source_id string, n long, analysed long, latest date", "source_id"),
}
LEAST_BODY = 100

log = logging.getLogger(__name__)


@dataclass
class Store:
    """The stored tables of the run, under one folder."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        self.articles = KeyedTable(self.spark, f"{self.root}/articles", ARTICLE, sketches=True)
        self.bodies = KeyedTable(self.spark, f"{self.root}/bodies", "id string, text string", bucket_rows=50_000)
        self.runs = sources.run_state(self.spark, f"{self.root}/runs", shared.schema(RUN))

    def published(self, name: str) -> KeyedTable:
        schema, key = PUBLISHED[name]
        return KeyedTable(self.spark, f"{self.root}/published-{name}", schema, key)


@dataclass
class Day:
    """What a day brings: listing rows, the sources' registry, snapshots of article pages (url, status, html), the rules of
    bodies and the answers of models (id, rank, model, raw), best rank first."""

    date: str
    listing: DataFrame
    registry: DataFrame
    pages: DataFrame
    rules: DataFrame
    answers: DataFrame


def ingest_articles(store: Store, day: Day) -> None:
    """Adds new articles of admitted listing rows, and folds each source's metrics of the run into its state."""
    listing = ingest.keep_first(day.listing, ["source_id", "url"], [F.col("pos")])
    registry = day.registry.hint("merge")
    gated = ingest.gate_by_host(listing, registry).drop("expected_hostname")
    caps = gated.where("admitted").join(registry.select("source_id", "max_articles"), "source_id", "left")
    capped = ingest.top_n(caps, ["source_id"], [F.col("pos")], F.coalesce("max_articles", F.lit(10))).withColumn("fetched_at", F.lit(day.date))
    made = ingest.canonical_articles(capped)
    extra = capped.select(urls.article_id(F.col("source_id"), F.col("url")).alias("id"), "pos", "category", "summary")
    rows = shared.stored(made.join(extra.hint("merge"), "id"), "listed")

    def fresh(manifest) -> DataFrame:
        new = scan.numbered(unseen(rows, store.articles, manifest), [F.col("source_id"), F.col("pos"), F.col("id")], "_n")
        return status.union_all(new.withColumn("seq", F.col("_n") + manifest.rows).drop("_n", "pos"), store.spark.createDataFrame([], ARTICLE)).select(*store.articles.schema.fieldNames())

    number = (F.to_date(F.lit(day.date)) - F.lit("1970-01-01").cast("date")).cast("int")
    before = store.articles.manifest()
    store.articles.append(fresh, commit=("ingest", store.spark.range(1).select(number).first()[0]))
    new = shared.stored(unseen(rows, store.articles, before).groupBy("source_id").agg(F.count(F.lit(1)).alias("new")), "new")
    totals = gated.groupBy("source_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("gated").alias("_gated"), F.count_if(~F.col("admitted")).alias("mismatch"))
    ratio = F.col("_gated") / F.greatest("total", F.lit(1))
    run = totals.join(new.hint("merge"), "source_id", "left").select("source_id", F.to_date(F.lit(day.date)).alias("run"), "total", F.coalesce("new", F.lit(0)).alias("new"), "mismatch", F.round(ratio, 2).alias("gated_ratio"), F.round(1 - ratio, 2).alias("valid_ratio"))
    sources.fold_run(run, store.runs)


def fetch_contents(store: Store, day: Day) -> None:
    """Bodies of pending articles of sources with rules, by their pages' snapshots; an article whose page gave none is
    failed, and pending again on the next run."""
    handlers = day.rules.where(F.col("source_id") != bodies.EVERY).select("source_id")
    pending = status.pending_content(store.articles.read(), handlers).select("id", "source_id", "url", "title", "category", "summary")
    pages = day.pages.groupBy("url").agg(F.max_by(F.struct("status", "html"), F.col("status") == 200).alias("_p"))
    rows = pending.join(pages.hint("merge"), "url", "left").select("id", "source_id", "title", "category", "summary", F.col("_p.status").alias("status"), F.col("_p.html").alias("html"))
    # Ids are hashes; places in the order of ids are the page numbers that parsing works with.
    rows = shared.stored(scan.numbered(rows, [F.col("id")], "page_id"), "pending")
    texts = bodies.bodies(rows.where("status = 200"), day.rules, LEAST_BODY, kinds=("body",))
    found = shared.stored(bodies.contents(rows.drop("html").join(texts.select("page_id", "body").hint("merge"), "page_id", "left"), day.rules).select("id", "content", "content_status"), "contents")
    store.bodies.upsert(found.where("content is not null").select("id", F.col("content").alias("text")))
    store.articles.patch(found.select("id", "content_status"))


def analyse(store: Store, day: Day) -> None:
    """Summaries and themes of articles with a body, from the first valid answer of the ranked models; articles without
    one stay as they are, and those whose body is lost become failed."""
    due = status.with_body(status.to_analyse(store.articles.read()), store.bodies.read().hint("merge"))
    parsed = day.answers.withColumn("_json", F.coalesce(text.answer_json(F.col("raw")), text.answer_json(text.first_object(F.col("raw")))))
    best = parsed.where("_json is not null").groupBy("id").agg(F.min_by(F.struct("model", "_json"), "rank").alias("_a"))
    rows = due.select("id", "content_status", F.col("body").isNull().alias("_lost")).join(best.hint("merge"), "id", "left")
    field = lambda name: F.get_json_object(F.col("_a._json"), f"$.{name}")
    has = ~F.col("_lost") & F.col("_a").isNotNull()
    changes = rows.where(has | F.col("_lost")).select(
        "id",
        F.when(F.col("_lost"), "failed").alias("content_status"),
        F.when(has, True).alias("summarized"),
        F.when(has, field("summary_en")).alias("summary_en"),
        F.when(has, text.canonical_themes(field("themes"))).alias("themes"),
        F.when(has, field("key_takeaway_en")).alias("key_takeaway_en"),
        F.when(has, F.col("_a.model")).alias("analysis_model"),
        F.when(has, status.confidence(F.col("content_status"))).alias("analysis_confidence"),
    )
    store.articles.patch(shared.stored(changes, "analysed"))


def publish(store: Store, day: Day) -> None:
    """Timeline, clusters and funds of what is stored, each replaced as a whole."""
    rows = store.articles.read()
    tables = {"timeline": views.timeline(rows), "clusters": views.cluster_members(rows), "funds": views.fund_rollup(day.registry, rows)}
    for name, df in tables.items():
        table = store.published(name)
        table.replace(shared.stored(df.select(*table.schema.fieldNames()), name))


STAGES = (("ingest", ingest_articles), ("content", fetch_contents), ("analysis", analyse))


def run_day(store: Store, day: Day) -> list[str]:
    """Runs the stages in order; the names of those that failed or were left out, since a stage needs the one before. What
    there is gets published in any case."""
    failed: list[str] = []
    for name, stage in STAGES:
        if failed:
            failed.append(name)
            continue
        try:
            with shared.scratch_scope(store.spark):
                stage(store, day)
        except Exception:
            log.exception("stage %s failed", name)
            failed.append(name)
    with shared.scratch_scope(store.spark):
        publish(store, day)
    return failed


def state(store: Store) -> DataFrame:
    """The last run of every source, its streak of empty runs and its alarms."""
    return health.with_alerts(store.runs.read())
