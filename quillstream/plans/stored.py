"""Scans and sinks over stored forms that Spark derives from the tables, in the shared folder; and runs as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream import sources, streaming
from quillstream.functions import text
from quillstream.operators import ingest, status
from quillstream.plans.base import query
from quillstream.plans.registry import LINKS, RUNS, page_links, runs
from quillstream.sources import shared
from quillstream.sources.keyed import KeyedTable
from quillstream.streaming import trials

def doc_id() -> Column:
    return F.col("doc_id")


def written_text(rows: DataFrame, name: str, one_each: bool = False) -> str:
    """Path of rows(value) as text files; a file for each row where documents are read whole."""
    path = shared.scratch(rows.sparkSession, name)
    writer = rows.write.option("maxRecordsPerFile", 1) if one_each else rows.write
    writer.text(path)
    return path


# --- scans --------------------------------------------------------------------------------------------------------

LINES = "doc_id % 10 NOT IN (3, 4)"


def json_lines(read) -> str:
    row = F.to_json(F.struct(F.when(doc_id() % 7 > 0, F.concat(F.lit("a"), doc_id().cast("string"))).alias("id"), F.col("source").alias("source_id"), F.substring("text", 1, 50).alias("title"), F.lit("extra").alias("unknown")))
    value = F.when(doc_id() % 10 == 3, F.substring(row, 1, 15)).when(doc_id() % 10 == 4, F.lit("")).otherwise(row)
    return written_text(read("documents").select(value.alias("value")), "articles-jsonl")


@query(f"SELECT CASE WHEN doc_id % 7 > 0 THEN 'a' || doc_id END AS id, source AS source_id, substr(text, 1, 50) AS title FROM documents WHERE {LINES}")
def scan_json_lines(read):
    spark = read("documents").sparkSession
    return sources.read_json_lines(spark, json_lines(read), sources.ARTICLE).select("id", "source_id", "title")


@query(f"SELECT count(*) FILTER ({LINES}) AS good, count(*) FILTER (doc_id % 10 = 3) AS bad FROM documents")
def scan_quarantine(read):
    rows = sources.read_json_lines(read("documents").sparkSession, json_lines(read), "source_id string, title string", keep_bad=True)
    rows = shared.stored(rows, "quarantine")
    return rows.agg(F.count_if(F.col("_corrupt_record").isNull()).alias("good"), F.count("_corrupt_record").alias("bad"))


@query(f"SELECT 'a' || doc_id AS id FROM documents WHERE {LINES} AND doc_id % 7 > 0")
def scan_ids(read):
    return sources.read_ids(read("documents").sparkSession, json_lines(read))


def customer_blocks(read, item, key: str = "c_custkey", name: str = "items") -> DataFrame:
    """Documents of a hundred customers each: (block, items)."""
    return read("customer").groupBy(F.expr(f"{key} div 100").alias("block")).agg(F.array_sort(F.collect_list(item)).alias(name))


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS status, c_custkey % 100 AS pos FROM customer")
def scan_lists(read):
    item = F.struct(F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("k"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("status"))
    doc = F.when(F.col("block") % 2 == 0, F.to_json("items")).otherwise(F.to_json(F.struct(F.col("items").alias("candidates"))))
    path = written_text(customer_blocks(read, item).select(doc.alias("value")), "candidates", True)
    return sources.read_list(read("customer").sparkSession, path, "candidates", sources.CANDIDATE).select("id", "name", "status", "pos")


@query("""SELECT c_custkey::VARCHAR AS source_id, p AS pos, '/' || c_custkey || '/' || p AS url, p = 1 AS active FROM customer, (SELECT unnest([0, 1]) AS p) WHERE c_custkey // 100 % 5 <> 4""".replace("p AS pos", "p::BIGINT AS pos"))
def scan_keyed_map(read):
    key = F.col("c_custkey").cast("string")
    entry = lambda n: F.struct(F.concat(F.lit("/"), key, F.lit(f"/{n}")).alias("url"), F.lit(n == 1).alias("active"))
    item = F.struct(key.alias("k"), F.struct(F.array(entry(0), entry(1)).alias("entrypoints")).alias("v"))
    blocks = customer_blocks(read, item)
    doc = F.to_json(F.struct(F.map_from_entries("items").alias("sources")))
    value = F.when(F.col("block") % 5 == 4, F.substring(doc, 1, 20)).otherwise(doc)
    path = written_text(blocks.select(value.alias("value")), "entrypoints", True)
    return sources.read_entrypoints(read("customer").sparkSession, path).select("source_id", "pos", "url", "active")


@query("""SELECT 'active' AS kind, c_custkey::VARCHAR AS id, c_acctbal > 0 AS accessible, c_custkey % 9 / 9.0::DOUBLE AS overall FROM customer WHERE c_custkey // 100 % 3 > 0 OR c_custkey % 100 = 0
UNION ALL SELECT 'history', c_custkey::VARCHAR, c_acctbal > 0, c_custkey % 9 / 9.0::DOUBLE FROM customer WHERE c_custkey // 100 % 3 = 0""")
def scan_trials(read):
    k = F.col("c_custkey")
    check = F.create_map(F.lit("2024-01-02"), F.struct((F.col("c_acctbal") > 0).alias("accessible"), F.lit(3).alias("article_count")))
    sample = F.array(F.struct(F.lit(1).alias("day"), F.array(F.struct(F.lit("/u").alias("url"), (k % 9 / F.lit(9.0)).alias("overall"))).alias("articles")))
    trial = F.struct(k.cast("string").alias("id"), check.alias("daily_checks"), sample.alias("quality_samples"))
    blocks = read("customer").groupBy(F.expr("c_custkey div 100").alias("block")).agg(F.collect_list(trial).alias("items"), F.min_by(trial, k).alias("first"))
    old = F.to_json(F.struct(F.col("first").alias("active_trial"), F.col("items").alias("history")))
    doc = F.when(F.col("block") % 3 == 0, old).otherwise(F.to_json(F.struct(F.col("items").alias("active_trials"))))
    spark, path = read("customer").sparkSession, written_text(blocks.select(doc.alias("value")), "trials", True)
    out = []
    for kind, rows in (("active", sources.read_trials(spark, path)), ("history", sources.read_trials(spark, path, history=True))):
        both = sources.daily_checks(rows).select("trial_id", "accessible").join(sources.quality_samples(rows).select("trial_id", "overall").hint("merge"), "trial_id")
        out.append(both.select(F.lit(kind).alias("kind"), F.col("trial_id").alias("id"), "accessible", "overall"))
    return status.union_all(*out)


@query("SELECT 'c' || o_orderkey AS commit_hash, o_totalprice AS \"yield\", o_orderstatus AS status, o_orderpriority AS description FROM orders")
def scan_experiments(read):
    rows = read("orders").select(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("commit_hash"), F.col("o_totalprice").alias("yield"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("description"))
    path = shared.scratch(rows.sparkSession, "experiments")
    rows.write.csv(path, sep="\t", header=True)
    return sources.read_experiments(rows.sparkSession, path)


@query("""SELECT 'T' || doc_id AS title, 'https://f.example/' || doc_id AS link, DATE '2024-01-01' + CAST(doc_id % 90 AS INT) AS date, 'about ' || source AS summary FROM documents WHERE doc_id % 3 <> 1""")
def scan_rss(read):
    key = doc_id().cast("string")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (doc_id() % 90).cast("int")), "EEE, dd MMM yyyy")
    kind = F.when(doc_id() % 3 == 0, "<category>News</category><category>White Papers</category>").when(doc_id() % 3 == 1, "<category>News</category>").otherwise("<category>market commentary</category>")
    item = F.concat(F.lit("<item><title>"), F.lit("T"), key, F.lit("</title><link>https://f.example/"), key, F.lit("</link><pubDate>"), day, F.lit(" 23:30:00 -0500</pubDate>"), kind, F.lit("<description>&lt;p&gt;about "), F.col("source"), F.lit("&lt;/p&gt;</description></item>"))
    # Feeds of a hundred items each, every other one behind a byte order mark.
    feeds = read("documents").groupBy(F.expr("doc_id div 100").alias("block")).agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"))
    value = F.concat(F.when(F.col("block") % 2 == 0, F.lit("﻿")).otherwise(""), F.lit('<rss version="2.0"><channel><title>Feed</title>'), F.col("items"), F.lit("</channel></rss>"))
    path = written_text(feeds.select(value.alias("value")), "feed", True)
    return sources.read_rss(read("documents").sparkSession, path, text.WANTED_CATEGORIES).select("title", "link", "date", "summary")


@query("SELECT source AS source_id, lang AS title, p AS pos, doc_id FROM documents, (SELECT unnest([0, 1]) AS p) WHERE doc_id % 4 > 0".replace("p AS pos", "p::BIGINT AS pos"))
def scan_listings(read):
    rows = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("lang").alias("title"), doc_id().alias("n")), F.struct(F.col("lang").alias("title"), doc_id().alias("n"))).alias("hits")).alias("insights")))
    raw = F.when(doc_id() % 4 > 0, rows).otherwise('{"insights": {}}')
    listing = sources.listing_rows(read("documents").select(F.col("source").alias("source_id"), raw.alias("raw")), "insights.hits", "title: string, n: bigint")
    return listing.select("source_id", "title", "pos", F.col("n").alias("doc_id"))


# --- sinks --------------------------------------------------------------------------------------------------------


@query("SELECT source AS source_id, count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents GROUP BY 1")
def sink_append(read):
    d, spark = read("documents").select(doc_id().alias("id"), F.col("source").alias("source_id")), read("documents").sparkSession
    path = shared.scratch(spark, "log")
    for part in (0, 1):
        sources.append(d.where(F.col("id") % 2 == part), path)
    return spark.read.parquet(path).groupBy(F.col("source_id").cast("string").alias("source_id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))


@query("SELECT doc_id AS id, doc_id % 2 = 0 OR n_chars > 500 AS summarized FROM documents")
def sink_rewrite(read):
    rows = read("documents").select(doc_id().alias("id"), (F.col("n_chars") > 500).alias("summarized"))
    root = shared.scratch(rows.sparkSession, "articles")
    first = rows.sparkSession.read.parquet(sources.write_version(rows, root, "v1"))
    second = sources.write_version(first.withColumn("summarized", F.col("summarized") | (F.col("id") % 2 == 0)), root, "v2")
    return rows.sparkSession.read.parquet(second)


@query("""WITH u AS (SELECT s_suppkey AS k, s_name AS n, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS b FROM supplier)
SELECT c_custkey, coalesce(n, c_name) AS c_name, coalesce(b, c_acctbal) AS c_acctbal, CASE WHEN k IS NOT NULL THEN 'html' END AS discovery_method, CASE WHEN k IS NOT NULL THEN 2024 END::BIGINT AS year FROM customer LEFT JOIN u ON k = c_custkey""")
def upsert_stamped(read):
    changes = read("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("c_acctbal"))
    rows = sources.stamped_patch(read("customer").select("c_custkey", "c_name", "c_acctbal"), changes, "c_custkey", "html", "2024-02-20 08:00:00")
    return rows.select("c_custkey", "c_name", "c_acctbal", "discovery_method", F.year("last_discovered_at").alias("year"))


@query(RUNS + "SELECT source_id, run, zero_streak, total FROM (SELECT source_id, run, new AS total, zero_streak, row_number() OVER (PARTITION BY source_id ORDER BY run DESC) AS rn FROM streaks) WHERE rn = 1")
def folded_runs(read):
    rows = runs(read).select("source_id", "run", F.col("new").alias("total"), "mismatch", "gated_ratio", "valid_ratio")
    spark = rows.sparkSession
    state = sources.run_state(spark, shared.scratch(spark, "source-state"), rows.schema)
    cuts = ["2024-01-01", "2024-01-05", "2024-01-06", "2024-01-15", "2024-03-01"]
    for lo, hi in (*zip(cuts, cuts[1:]), ("2024-01-05", "2024-01-15")):  # the last is folded already
        folded = sources.fold_run(rows.where((F.col("run") >= lo) & (F.col("run") < hi)), state)
    return folded.select(F.col("source_id").cast("long").alias("source_id"), "run", "zero_streak", "total")


@query("SELECT source AS source_id, count(*) AS n, round(avg(n_chars), 6) AS mean FROM documents GROUP BY 1")
def sink_reports(read):
    rows = read("documents").groupBy(F.col("source").alias("source_id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 6).alias("mean"))
    spark = rows.sparkSession
    plain, packed = shared.scratch(spark, "report"), shared.scratch(spark, "report-gz")
    sources.write_report(rows, plain)
    sources.export_gzip(rows, packed)
    schema = "source_id string, n long, mean double"
    return spark.read.schema(schema).json(plain).join(spark.read.schema(schema).json(packed), ["source_id", "n", "mean"])


@query("SELECT doc_id AS id, md5(text) AS md5 FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def body_store(read):
    bodies = read("documents").select(doc_id().alias("id"), "text")
    table = shared.scratch(bodies.sparkSession, "article-content")
    sources.write_bodies(bodies, table)
    found = sources.read_bodies(bodies.sparkSession, table, read("labels").select(doc_id().alias("id")))
    return found.select("id", F.md5(F.col("text").cast("binary")).alias("md5"))


@query("""WITH old AS (SELECT page_id, url AS address, page_id % 40 AS source_id FROM pages), changed AS (SELECT DISTINCT page_id % 40 AS source_id FROM pages WHERE page_id % 3 = 0 AND page_id % 40 < 20)
SELECT source_id, address, 'old' AS origin FROM old WHERE source_id NOT IN (SELECT source_id FROM changed) AND source_id <> 39
UNION ALL SELECT source_id, address, 'new' FROM old WHERE page_id % 3 = 0 AND source_id < 20""")
def keyed_upsert(read):
    """Entry sets of sources in a stored table: those of some sources replaced, one removed, each in a version of its own."""
    own = read("pages").select((F.col("page_id") % 40).alias("source_id"), F.col("url").alias("address"), "page_id")
    spark = own.sparkSession
    table = KeyedTable(spark, shared.scratch(spark, "entrypoints"), "source_id long, address string, origin string", "source_id", bucket_rows=100)
    table.append(lambda _: own.withColumn("origin", F.lit("old")))
    table.upsert(own.where("page_id % 3 = 0 and source_id < 20").withColumn("origin", F.lit("new")))
    table.remove(own.where("source_id = 39"))
    return table.read()


@query("SELECT doc_id AS id, doc_id % 2 = 0 OR n_chars > 500 AS summarized, CASE WHEN doc_id % 2 = 0 THEN 'm' END AS model FROM documents")
def keyed_patch(read):
    """Articles rewritten with what an analysis has found for some of them."""
    rows = read("documents").select(doc_id().alias("id"), (F.col("n_chars") > 500).alias("summarized"), F.lit(None).cast("string").alias("model"))
    table = KeyedTable(rows.sparkSession, shared.scratch(rows.sparkSession, "articles"), rows.schema, bucket_rows=200)
    table.append(lambda _: rows)
    table.patch(rows.where("id % 2 = 0").select("id", F.lit(True).alias("summarized"), F.lit("m").alias("model")))
    return table.read()


# --- one run of the ingest ----------------------------------------------------------------------------------------


@query(f"""WITH {LINKS}, firsts AS (SELECT host AS source_id, link AS url, min(page_id * 1000 + pos) AS pos FROM good_links GROUP BY 1, 2),
capped AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY pos) AS rn FROM firsts WHERE NOT ends_with(source_id, 'net') OR ends_with(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), 'example.net')),
made AS (SELECT substr(sha256(source_id || ':' || url), 1, 16) AS id, source_id, url FROM capped WHERE rn <= 3)
SELECT id, source_id, url, false AS summarized FROM made WHERE ascii(id) % 4 > 0""")
def ingest_run(read):
    rows = page_links(read).select(F.col("host").alias("source_id"), F.col("link").alias("url"), (F.col("page_id") * 1000 + F.col("pos")).alias("pos"))
    hosts = rows.select("source_id").distinct()
    registry = hosts.select("source_id", F.when(F.col("source_id").endswith("net"), "example.net").otherwise("").alias("expected_hostname"), F.lit(3).alias("max_articles"))
    listing = rows.withColumns({"source_name": F.col("source_id"), "title": F.col("url"), "date": F.lit(None).cast("date"), "date_raw": F.lit(""), "fetched_at": F.lit("2024-02-20")})
    stored = ingest.ingest(listing, registry, rows.select(F.lit("").alias("id")).limit(0)).where(F.ascii("id") % 4 == 0)
    return ingest.ingest(listing, registry, stored).select("id", "source_id", "url", "summarized")


# --- streams ------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT user_id * 100 + extract('day' FROM ts) AS id FROM events")
def stream_seen_ids(read):
    e = read("events").select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("id"), "event_id")
    spark = e.sparkSession
    arrived, root, state = (shared.scratch(spark, n) for n in ("arrived", "seen", "state"))
    table = KeyedTable(spark, root, "id long", sketches=True)
    for part in (0, 1):  # two runs; the second meets ids of the first
        e.where(F.col("event_id") % 2 == part).select("id").write.mode("append").parquet(arrived)
        streaming.ingest_keyed_stream(spark.readStream.schema("id long").parquet(arrived), table, state).awaitTermination()
    return table.read()


@query(RUNS + "SELECT source_id, datediff('day', DATE '1970-01-01', run) AS run, new AS total, zero_streak FROM streaks")
def stream_zero_streaks(read):
    rows = runs(read).select(F.col("source_id").cast("string").alias("source_id"), F.unix_date("run").cast("long").alias("run"), F.col("new").alias("total"))
    spark = rows.sparkSession
    arrived, out, state = (shared.scratch(spark, n) for n in ("runs", "streaks", "state"))
    for part in (rows.where("run < 19737"), rows.where("run >= 19737")):
        part.write.mode("append").parquet(arrived)
        found = streaming.zero_streak_stream(spark.readStream.schema(rows.schema).parquet(arrived))
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("source_id", F.col("source_id").cast("long"))


#: An event's user is tried; sign-ups ask for a start, every event is a check, those of a value over 30 are samples.
TRIAL_EVENTS = """WITH RECURSIVE ev AS (SELECT user_id AS id, ts, event_id, CAST(ts AS DATE) AS day, event_type = 'signup' AS asked, event_type <> 'error' AS accessible, CAST(floor(value) AS BIGINT) % 5 AS articles,
  CASE WHEN value > 30 THEN CAST(json_extract(props, '$.k') AS BIGINT) % 5 / 4.0::DOUBLE END AS score FROM events),
checks AS (SELECT id, day, arg_min(accessible, (ts, event_id)) AS accessible, arg_min(articles, (ts, event_id)) AS articles FROM ev GROUP BY 1, 2),
samples AS (SELECT id, day, arg_min(score, (ts, event_id)) AS score FROM ev WHERE score IS NOT NULL GROUP BY 1, 2),
asked AS (SELECT DISTINCT id, day FROM ev WHERE asked),
runs AS (SELECT a.id, a.day AS start, coalesce(c.articles, 0) AS articles, coalesce(c.days, 0) AS days, s.mean, coalesce(s.n, 0) AS n FROM asked a
  LEFT JOIN LATERAL (SELECT sum(articles) FILTER (accessible)::BIGINT AS articles, count(*) FILTER (accessible AND articles > 0) AS days FROM checks c WHERE c.id = a.id AND c.day BETWEEN a.day AND a.day + 3) c ON true
  LEFT JOIN LATERAL (SELECT avg(score) AS mean, count(*) AS n FROM samples s WHERE s.id = a.id AND s.day BETWEEN a.day AND a.day + 2) s ON true),
judged AS (SELECT id, start, start + 3 AS decided, articles, days, round(coalesce(mean, 0.0), 3) AS mean, n, CASE WHEN days < 2 THEN 'fail_quantity' WHEN n = 0 OR mean < 0.5 THEN 'fail_quality' ELSE 'pass' END AS outcome FROM runs),
taken AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY id ORDER BY start) = 1
  UNION ALL SELECT j.* FROM (SELECT id, decided + CASE outcome WHEN 'pass' THEN 7 ELSE 30 END AS free FROM taken) t JOIN LATERAL (SELECT * FROM judged j WHERE j.id = t.id AND j.start >= t.free ORDER BY j.start LIMIT 1) j ON true)
"""


@query(TRIAL_EVENTS + "SELECT id::VARCHAR AS trial_id, start AS start_date, decided AS decided_on, articles, days, mean, n AS n_samples, outcome FROM taken WHERE decided + 1 <= (SELECT max(ts)::DATE FROM events)")
def stream_trials(read):
    """The trial machine over events that arrive in three runs of the stream, each started anew from the checkpoint."""
    e = read("events")
    base = [F.col("user_id").alias("trial_id"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq")]
    of = lambda kind: e.select(*base, F.lit(kind).alias("kind"), (F.col("event_type") != "error").alias("accessible"), (F.floor("value") % 5).alias("articles"), F.array(F.get_json_object("props", "$.k").cast("long") % 5 / F.lit(4.0)).alias("scores"), "event_type", "value")
    rows = status.union_all(of("start").where("event_type = 'signup'"), of("check"), of("sample").where("value > 30")).drop("event_type", "value")
    spark = e.sparkSession
    arrived, out, state = (shared.scratch(spark, n) for n in ("trial-events", "decisions", "state"))
    for lo, hi in ((0, 11), (11, 19), (19, 99)):
        rows.where(f"dayofmonth(at) > {lo} and dayofmonth(at) <= {hi}").write.mode("append").parquet(arrived)
        trials.run_trials(spark.readStream.schema(rows.schema).parquet(arrived), out, state).awaitTermination()
    return spark.read.schema(trials.DECISION).parquet(out)
