"""The daily run over days of a store that starts empty: documents as articles, listed again from day to day."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from quillstream.operators import daily, status
from quillstream.plans.base import query
from quillstream.sources import shared

CAP = 40
DATES = ["2024-02-01", "2024-02-02", "2024-02-03"]


def _days(read, numbers):
    """What each day brings. Documents are listed on the day of doc_id % 3 and after; a seventeenth are of another host; a
    quarter of the pages cannot be fetched on the first day; some are forbidden; models answer for six of seven."""
    k = F.col("doc_id")
    key = k.cast("string")
    docs = read("documents").select("doc_id", F.col("source").alias("source_id"), F.regexp_replace("text", "[<>&]", " ").alias("text"))
    docs = docs.withColumn("url", F.concat(F.lit("https://"), F.when(k % 17 == 0, "other").otherwise(F.col("source_id")), F.lit(".example/"), key))
    listing = docs.select("doc_id", "source_id", F.col("source_id").alias("source_name"), F.concat(F.lit("T"), key).alias("title"), "url", F.date_add(F.lit("2024-01-01").cast("date"), (k % 30).cast("int")).alias("date"), F.lit("").alias("date_raw"), k.alias("pos"), (k % 3 == 0).alias("gated"), F.lit("c").alias("category"), F.when(k % 2 == 0, F.concat(F.lit("about "), key)).alias("summary"))
    registry = docs.select("source_id").distinct().select("source_id", F.concat("source_id", F.lit(".example")).alias("expected_hostname"), F.lit(CAP).alias("max_articles"))
    own = docs.select("source_id").distinct()
    rules = own.select("source_id", F.lit("body").alias("kind"), F.lit(0).alias("rank"), F.lit("article p").alias("selector"))
    rules = status.union_all(rules, own.where("source_id like '%1%'").select("source_id", F.lit("metadata").alias("kind"), F.lit(0).alias("rank"), F.lit("").alias("selector")))
    rules = shared.stored(rules, "rules")
    good = json.dumps({"summary_en": "s", "summary_zh": "z", "themes": ["macro", "AI/Tech", "nothing known"], "key_takeaway_en": "k", "key_takeaway_zh": "k"})
    article_id = F.substring(F.sha2(F.concat("source_id", F.lit(":"), "url"), 256), 1, 16)
    answer = lambda rank, raw: docs.where(k % 7 != 3).select(article_id.alias("id"), F.lit(rank).alias("rank"), F.lit(f"m{rank}").alias("model"), raw.alias("raw"))
    answers = status.union_all(answer(0, F.when(k % 5 == 0, "sorry, no").otherwise(F.lit(f"```json\n{good}\n```"))), answer(1, F.lit(f"Here it is: {good} Bye")))
    for n in numbers:
        code = F.when(k % 13 == 0, 403).when(k % 13 == 1, 500).when((k % 4 == 0) & F.lit(n == 0), None).otherwise(200)
        pages = docs.select("url", code.alias("status"), F.concat(F.lit("<html><body><nav>menu</nav><article><p>"), F.trim(F.regexp_replace("text", r"\s+", " ")), F.lit("</p></article></body></html>")).alias("html"))
        yield daily.Day(DATES[n], listing.where(k % 3 <= n).drop("doc_id"), registry, pages, rules, answers)


def _ran(read, numbers=(0, 2)) -> daily.Store:
    spark = read("documents").sparkSession
    store = daily.Store(spark, shared.scratch(spark, "daily"))
    for day in _days(read, numbers):
        if failed := daily.run_day(store, day):
            raise RuntimeError(f"{day.date}: {failed}")
    return store


DAYS = f"""WITH d AS (SELECT doc_id, source AS source_id, CASE WHEN doc_id % 17 = 0 THEN 'other' ELSE source END AS h, trim(regexp_replace(regexp_replace(text, '[<>&]', ' ', 'g'), '\\s+', ' ', 'g')) AS body FROM documents),
listed AS (SELECT *, n FROM d, (SELECT unnest([0, 2]) AS n) WHERE doc_id % 3 <= n),
kept AS (SELECT * FROM listed WHERE doc_id % 17 <> 0 QUALIFY row_number() OVER (PARTITION BY n, source_id ORDER BY doc_id) <= {CAP}),
arts AS (SELECT doc_id, any_value(source_id) AS source_id, any_value(body) AS body, min(n) AS first_day FROM kept GROUP BY doc_id),
fetched AS (SELECT *, substr(sha256(source_id || ':https://' || source_id || '.example/' || doc_id), 1, 16) AS id, CASE WHEN doc_id % 13 > 1 AND length(body) >= 100 THEN 'ok' WHEN doc_id % 13 <> 1 AND contains(source_id, '1') THEN 'metadata_only' ELSE 'failed' END AS content_status FROM arts),
final AS (SELECT *, content_status <> 'failed' AND doc_id % 7 <> 3 AS summarized FROM fetched)
"""


@query(DAYS + "SELECT id, source_id, content_status, summarized, CASE WHEN summarized THEN CASE WHEN doc_id % 5 = 0 THEN 'm1' ELSE 'm0' END END AS analysis_model, CASE WHEN summarized AND content_status = 'metadata_only' THEN 'low' END AS analysis_confidence, CASE WHEN summarized THEN 'Macro/Rates,AI/Tech' END AS themes, ('2024-02-0' || (first_day + 1)) AS fetched_at FROM final")
def daily_articles(read):
    """Articles after two daily runs."""
    rows = _ran(read).articles.read()
    return rows.select("id", "source_id", "content_status", "summarized", "analysis_model", "analysis_confidence", F.array_join("themes", ",").alias("themes"), "fetched_at")


@query(DAYS.replace("[0, 2]", "[2]") + """SELECT 'fund' AS view, source_id AS name, count(id) AS n, count(*) FILTER (summarized) AS analysed FROM (SELECT DISTINCT source_id FROM d) LEFT JOIN final USING (source_id) GROUP BY 2
UNION ALL SELECT 'cluster', CASE WHEN summarized THEN 'Macro/Rates' ELSE 'General' END, count(*), count(*) FILTER (summarized) FROM final GROUP BY 2
UNION ALL SELECT 'day', (DATE '2024-01-01' + CAST(doc_id % 30 AS INT))::VARCHAR, count(*), NULL FROM final GROUP BY 2""")
def daily_published(read):
    """What the run of a day has published."""
    store = _ran(read, [2])
    read_of = lambda name: store.published(name).read()
    funds = read_of("funds").select(F.lit("fund").alias("view"), F.col("source_id").alias("name"), "n", "analysed")
    members = read_of("clusters").join(store.articles.read().select("id", "summarized").hint("merge"), "id")
    clusters = members.groupBy(F.lit("cluster").alias("view"), F.col("cluster").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count_if("summarized").alias("analysed"))
    days = read_of("timeline").groupBy(F.lit("day").alias("view"), F.col("date").cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("analysed"))
    return status.union_all(funds, clusters, days)
