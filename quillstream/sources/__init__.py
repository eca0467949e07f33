"""Readers and writers of the reference's stored forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillstream.functions import dates, text
from quillstream.operators import health, ingest
from quillstream.sources import shared
from quillstream.sources.keyed import KeyedTable

ARTICLE = "id string, source_id string, source_name string, title string, url string, date date, date_raw string, fetched_at string, summarized boolean, content_path string, content_status string, summary_en string, summary_zh string, themes array<string>, key_takeaway_en string, key_takeaway_zh string, analysis_model string, analysis_confidence string"
ENTRYPOINTS = "sources map<string, struct<entrypoints: array<struct<url: string, content_type: string, confidence: double, final_score: double, active: boolean, last_verified_at: string, verified_by: string>>>>"
CANDIDATE = "id string, name string, status string, homepage_url string, research_url string, rss_url string, official_domain string, quality string, fit_score double, quality_score double, is_publicly_accessible boolean, has_article_index boolean, topics string, notes string, strategy_tags array<string>, last_screened_at string, last_validated_at string, synthesis_attempted_at string"
TRIAL = "id string, name string, research_url string, start_date date, end_date date, auto_decided boolean, outcome string, fit_score double, quality string, daily_checks map<string, struct<accessible: boolean, article_count: int, date_count: int, error: string>>, quality_samples array<struct<day: int, date: date, sampled: int, error: string, articles: array<struct<url: string, relevance: double, depth: double, extractable: double, overall: double, notes: string>>>>"
EXPERIMENT = "commit_hash string, yield double, status string, description string"


def read_json_lines(spark: SparkSession, path: str, schema: str, keep_bad: bool = False) -> DataFrame:
    """JSON lines, blank and broken ones left out; keep_bad gives the broken ones in _corrupt_record."""
    if not keep_bad:
        return spark.read.schema(schema).json(path, mode="DROPMALFORMED")
    whole = StructType(StructType.fromDDL(schema).fields + [StructField("_corrupt_record", StringType())])
    return spark.read.schema(whole).json(path, mode="PERMISSIVE")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, "id string").where("id is not null")


def read_list(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """Rows of a JSON document that is a list, or an object with the list under `field`."""
    items = StructType.fromDDL(schema)
    named = StructType.fromDDL(f"`{field}` array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in items.fields)}>>")
    whole = spark.read.text(path, wholetext=True).withColumn("_list", F.ltrim("value").startswith("["))
    wrapped = F.when(F.col("_list"), F.concat(F.lit(f'{{"{field}":'), "value", F.lit("}"))).otherwise(F.col("value"))
    return whole.select(F.from_json(wrapped, named).alias("d")).select(F.posexplode(f"d.{field}").alias("pos", "r")).select("pos", "r.*")


def read_entrypoints(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, pos, url, ..) of a document keyed by source; broken documents give no rows."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", ENTRYPOINTS).alias("d"))
    by_source = doc.select(F.explode("d.sources").alias("source_id", "s"))
    return by_source.select("source_id", F.posexplode("s.entrypoints").alias("pos", "e")).select("source_id", "pos", "e.*")


def read_trials(spark: SparkSession, path: str, history: bool = False) -> DataFrame:
    """Active trials of state documents (an older one has a single trial under active_trial), or their history."""
    trial = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(TRIAL).fields)
    schema = f"active_trials array<struct<{trial}>>, active_trial struct<{trial}>, history array<struct<{trial}>>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("d"))
    rows = F.col("d.history") if history else F.coalesce("d.active_trials", F.array_compact(F.array("d.active_trial")))
    return doc.select(F.posexplode(rows).alias("pos", "t")).select("pos", "t.*")


def quality_samples(trials: DataFrame) -> DataFrame:
    """A row for each sampled article of read_trials()."""
    each = trials.select(F.col("id").alias("trial_id"), F.explode("quality_samples").alias("s"))
    return each.select("trial_id", "s.day", "s.date", F.explode("s.articles").alias("a")).select("trial_id", "day", "date", "a.*")


def daily_checks(trials: DataFrame) -> DataFrame:
    each = trials.select(F.col("id").alias("trial_id"), F.explode("daily_checks").alias("date", "c"))
    return each.select("trial_id", F.to_date("date").alias("date"), "c.*")


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=EXPERIMENT)


def read_rss(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """Items of RSS 2.0 feeds, with or without a byte order mark; only those with a wanted category, if such are given.
    The date is that of pubDate in its own offset, tags are taken out of the description."""
    items = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, pubDate string, category array<string>, description string").load(path)
    items = items.where(text.wanted_category(F.col("category"), wanted)) if wanted is not None else items
    return items.withColumns({"title": text.without_bom(F.col("title")), "date": dates.mail_date(F.col("pubDate")), "summary": text.without_tags(F.col("description"))})


def listing_rows(payloads: DataFrame, path: str, schema: str) -> DataFrame:
    """Rows of the array at a dotted path of each JSON payload(source_id, raw)."""
    items = F.from_json(F.get_json_object("raw", f"$.{path}"), f"array<struct<{schema}>>")
    return payloads.select("source_id", F.posexplode(items).alias("pos", "r")).select("source_id", "pos", "r.*")


def append(df: DataFrame, path: str, by: str = "source_id") -> None:
    df.write.mode("append").partitionBy(by).parquet(path)


def write_version(df: DataFrame, root: str, version: str) -> str:
    """A whole table under a new version's folder: what is being read is never overwritten."""
    df.write.mode("errorifexists").parquet(f"{root}/{version}")
    return f"{root}/{version}"


def stamped_patch(old: DataFrame, changes: DataFrame, key: str, method: str, at: str) -> DataFrame:
    """old with the non-null values of changes; rows that a change names get its method and time."""
    hit = changes.select(key).distinct().withColumn("_hit", F.lit(True))
    rows = ingest.patch(old, changes, key).join(hit, key, "left")
    return rows.withColumns({"discovery_method": F.when(F.col("_hit"), method), "last_discovered_at": F.when(F.col("_hit"), F.lit(at).cast("timestamp"))}).drop("_hit")


def run_state(spark: SparkSession, root: str, runs: StructType, key: str = "source_id") -> KeyedTable:
    """The stored state of sources: the last metrics (columns of runs) and the streak summary of each."""
    return KeyedTable(spark, root, StructType([*runs.fields, *StructType.fromDDL("zero_streak long, all_zero boolean, n_runs long").fields]), key)


def fold_run(runs: DataFrame, state: KeyedTable, log: str | None = None) -> DataFrame:
    """Folds a run's metrics into the stored state, of which only the buckets of its sources are read and rewritten, and
    gives all sources' last metrics, streaks of empty runs and alarms. A run folded before changes nothing. log: a table
    that all runs are appended to as they are."""
    with shared.scratch_scope(runs.sparkSession):
        run = shared.stored(runs, "run")
        if log:
            append(run, log)
        now = state.change(state.touched_by(run), lambda old: health.folded(old, run, state.key))
    return health.with_alerts(state.read(manifest=now))


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_bodies(bodies: DataFrame, table: str) -> None:
    """Appends bodies(id, text) to the content table; a failed job leaves nothing of it."""
    bodies.select("id", "text").write.mode("append").parquet(table)


def read_bodies(spark: SparkSession, table: str, ids: DataFrame) -> DataFrame:
    """Stored bodies of the ids, one for each; of several the longest."""
    rows = spark.read.parquet(table).join(ids.select("id").distinct(), "id", "left_semi")
    return rows.groupBy("id").agg(F.max_by("text", F.length("text")).alias("text"))


def export_gzip(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)
