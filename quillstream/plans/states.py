"""Stages of the candidate funnel, trials and articles: filters, transitions, write-backs, unions and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import scoring, urls
from quillstream.operators import funnel, ingest, ranking, report, status
from quillstream.plans.base import query
from quillstream.plans.registry import CANDIDATES, LABELLED, SQL_HOST, TRIALS, candidates, history, production, rated, trials

# Customers as candidates with more of their columns; suppliers as fetched pages of theirs.
FUNNEL = CANDIDATES.rstrip() + """, funnel AS (SELECT c_custkey AS id, ['seed', 'discovered', 'screen_failed', 'screened', 'inaccessible', 'validated', 'rejected'][c_custkey % 7 + 1] AS status,
  CASE WHEN c_custkey % 5 > 0 THEN 'https://c' || (c_custkey % 150) || '.example/research' END AS research_url, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal > 0 END AS is_publicly_accessible, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 9 / 9.0::DOUBLE END AS fit_score, c_name AS notes, c_nationkey FROM customer)
"""


def funnel_rows(read) -> DataFrame:
    k = F.col("c_custkey")
    names = ["seed", "discovered", "screen_failed", "screened", "inaccessible", "validated", "rejected"]
    return read("customer").select(
        k.alias("id"),
        F.element_at(F.array(*map(F.lit, names)), (k % 7 + 1).cast("int")).alias("status"),
        F.when(k % 5 > 0, F.concat(F.lit("https://c"), (k % 150).cast("string"), F.lit(".example/research"))).alias("research_url"),
        F.when(k % 3 == 0, F.col("c_acctbal") > 0).alias("is_publicly_accessible"),
        F.when(k % 2 == 0, k % 9 / F.lit(9.0)).alias("fit_score"),
        F.col("c_name").alias("notes"),
        "c_nationkey",
    )


@query(FUNNEL + """SELECT stage, count(*) AS n, sum(id)::BIGINT AS ids FROM (SELECT 'discover' AS stage, id FROM funnel WHERE status = 'seed' UNION ALL SELECT 'screen', id FROM funnel WHERE status IN ('discovered', 'screen_failed')
UNION ALL SELECT 'screen again', id FROM funnel WHERE status IN ('discovered', 'screen_failed', 'screened') UNION ALL SELECT 'score again', id FROM funnel WHERE status IN ('screened', 'inaccessible') UNION ALL SELECT 'one', id FROM funnel WHERE status = 'seed' AND id = 7) GROUP BY 1""")
def stage_filters(read):
    rows = funnel_rows(read)
    parts = {"discover": status.of_stage(rows, "discover"), "screen": status.of_stage(rows, "screen"), "screen again": status.of_stage(rows, "screen", True), "score again": status.of_stage(rows, "score", True), "one": status.of_stage(rows, "discover", only=7)}
    every = status.union_all(*[r.select(F.lit(n).alias("stage"), "id") for n, r in parts.items()])
    return every.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(FUNNEL + """, fetched AS (SELECT 'https://c' || s_suppkey || '.example/research' AS url, CASE WHEN s_nationkey % 4 = 0 THEN 403 ELSE 200 END AS status_code, s_suppkey % 5 AS articles, s_suppkey % 3 AS times, s_suppkey % 4 AS h2, s_suppkey % 11 = 0 AS pw FROM supplier)
SELECT id, CASE WHEN research_url IS NULL OR status_code IS NULL THEN 'screen_failed' ELSE 'screened' END AS status, CASE WHEN research_url IS NULL THEN 'no URL' WHEN status_code IS NULL THEN 'fetch error' END AS error,
research_url IS NOT NULL AND status_code = 200 AND NOT pw AND ((articles >= 2)::INT + (times >= 2)::INT >= 2 OR h2 >= 3) IS TRUE AS passed FROM funnel LEFT JOIN fetched ON url = research_url""".replace("research_url IS NOT NULL AND status_code = 200 AND NOT pw AND ((articles", "coalesce(status_code = 200 AND NOT pw AND ((articles").replace("h2 >= 3) IS TRUE AS passed", "h2 >= 3), false) AS passed"))
def screening(read):
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    fetched = read("supplier").select(F.concat(F.lit("https://c"), s.cast("string"), F.lit(".example/research")).alias("url"), F.when(n % 4 == 0, 403).otherwise(200).alias("status_code"), (s % 5).alias("articles"), (s % 3).alias("times"), F.lit(0).alias("dates"), (s % 4).alias("h2"), (s % 11 == 0).alias("has_password"), F.lit(0).alias("login_phrases"))
    verdict = lambda rows: funnel.screen_verdict(rows.drop("status").withColumnRenamed("status_code", "status")).withColumnRenamed("status", "status_code")
    return status.screened(funnel_rows(read), fetched, verdict).select("id", "status", "error", "passed")


@query(FUNNEL + """, entry AS (SELECT o_custkey AS id, max(o_orderkey % 100 / 100.0::DOUBLE) AS best FROM orders WHERE o_orderkey % 100 >= 50 GROUP BY 1)
SELECT f.id, CASE WHEN best IS NULL THEN status WHEN coalesce(is_publicly_accessible, false) THEN 'validated' ELSE 'inaccessible' END AS status, coalesce(best, fit_score) AS fit_score FROM funnel f LEFT JOIN entry e USING (id)""")
def scoring_transition(read):
    pages = read("orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 100 / F.lit(100.0)).alias("final_score")).where("final_score >= 0.5")
    return status.scored(funnel_rows(read), pages).select("id", "status", "fit_score")


@query(FUNNEL + """, links AS (SELECT o_custkey AS id, arg_min('https://r.example/' || o_orderkey, o_orderkey) AS link FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), feeds AS (SELECT o_custkey AS id, arg_min('https://f.example/' || o_orderkey, o_orderkey) AS feed FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT id, coalesce(link, research_url) AS research_url, feed AS rss_url, CASE WHEN link IS NOT NULL THEN 'discovered' ELSE status END AS status FROM funnel LEFT JOIN links USING (id) LEFT JOIN feeds USING (id)""")
def first_links(read):
    of = lambda kind, host: read("orders").where(F.col("o_orderstatus") == kind).select(F.col("o_custkey").alias("id"), F.concat(F.lit(f"https://{host}.example/"), F.col("o_orderkey").cast("string")).alias("url"), F.col("o_orderkey").alias("pos"))
    rows = funnel_rows(read).withColumn("rss_url", F.lit(None).cast("string"))
    return status.discovered(rows, of("F", "r"), of("P", "f")).select("id", "research_url", "rss_url", "status")


@query(TRIALS.rstrip() + """, funnel AS (SELECT c_custkey AS id, c_name AS notes, c_mktsegment AS status FROM customer)
SELECT id, CASE WHEN starts_with(outcome, 'fail') THEN 'watchlist' ELSE status END AS status, coalesce(CASE WHEN outcome = 'fail_quantity' THEN 'Trial failed: articles on only ' || days || '/3 days' WHEN outcome = 'fail_quality' AND n_samples = 0 THEN 'Trial inconclusive: no quality samples obtained'
WHEN outcome = 'fail_quality' THEN 'Trial failed: low quality (' || printf('%.2f', mean + 1e-9) || ')' WHEN outcome = 'pass' THEN 'RECOMMEND: trial passed (' || days || '/3 days with articles, quality=' || printf('%.2f', mean + 1e-9) || ')' END, notes) AS notes FROM funnel LEFT JOIN rolled ON trial_id = id""")
def trial_notes(read):
    rows = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("notes"), F.col("c_mktsegment").alias("status"))
    return status.trial_writeback(rows, trials(read).withColumnRenamed("trial_id", "id")).select("id", "status", "notes")


@query("""SELECT o_orderkey AS id, o_orderkey % 20 / 20.0::DOUBLE AS final_score, 'bad' AS label FROM orders WHERE o_orderkey % 20 < 10""")
def rejected_set(read):
    rows = read("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 20 / F.lit(20.0)).alias("final_score"), F.lit(None).cast("string").alias("label"))
    return status.rejected_pages(rows)


ENTRY = f"""WITH entry AS (SELECT page_id, url, {SQL_HOST} AS source_id, page_id % 3 > 0 AS active FROM pages), checks AS (SELECT url, CASE page_id % 5 WHEN 0 THEN 'degraded' WHEN 1 THEN 'error' ELSE 'ok' END AS status FROM pages WHERE page_id % 2 = 0)
"""


@query(ENTRY + "SELECT page_id, active AND url NOT IN (SELECT url FROM checks WHERE status <> 'ok') AS active FROM entry")
def unhealthy_disabled(read):
    k = F.col("page_id")
    entry = read("pages").select("page_id", "url", (k % 3 > 0).alias("active"))
    checks = read("pages").where(k % 2 == 0).select("url", F.when(k % 5 == 0, "degraded").when(k % 5 == 1, "error").otherwise("ok").alias("status"))
    return status.disable_unhealthy(entry, checks).select("page_id", "active")


@query(f"""WITH base AS (SELECT page_id, 'c' || page_id % 40 AS fund_id, url, {SQL_HOST} AS host, CASE WHEN page_id % 3 = 0 THEN 0.8::DOUBLE END AS d, page_id % 4 = 0 AS rejected FROM pages),
known AS (SELECT fund_id, url, host FROM base WHERE page_id % 5 = 0),
every AS (SELECT fund_id, url, host, d, CASE WHEN rejected THEN 'bad' WHEN d IS NULL THEN 'good' ELSE 'good' END AS label, CASE WHEN rejected THEN 'rejected' ELSE 'entrypoint' END AS set FROM base WHERE rejected OR url NOT IN (SELECT url FROM known)
UNION ALL SELECT DISTINCT fund_id, url, host, NULL, 'bad', 'rejected' FROM known WHERE url NOT IN (SELECT url FROM base WHERE rejected))
SELECT fund_id, url, label, set, CASE WHEN d IS NOT NULL THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS domain_score FROM every""")
def backfill(read):
    k, host = F.col("page_id"), urls.host(F.col("url"))
    rows = read("pages").select("page_id", F.concat(F.lit("c"), (k % 40).cast("string")).alias("fund_id"), "url", F.when(k % 3 == 0, 0.8).alias("domain_score"), *[F.lit(0.5).alias(c) for c in ("path_score", "structure_score", "gate_penalty", "final_score")], F.when(k % 4 == 0, "bad").when(k % 3 == 0, "good").alias("label"), F.when(k % 4 == 0, "rejected").otherwise("entrypoint").alias("set"))
    domains = rows.select("fund_id").distinct().withColumn("domain", F.lit(None).cast("string"))
    return status.backfilled(rows.drop("page_id"), rows.where(k % 5 == 0).select("fund_id", "url"), domains).select("fund_id", "url", "label", "set", "domain_score")


@query("""SELECT c_custkey::VARCHAR AS fund_id, coalesce(nullif(CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment END, ''), lower('Www.' || c_custkey || '.Example')) AS domain FROM customer""")
def fund_domains(read):
    k = F.col("c_custkey")
    rows = read("customer").select(k.cast("string").alias("id"), F.when(k % 3 == 0, "").when(k % 3 == 1, F.col("c_mktsegment")).alias("official_domain"), F.concat(F.lit("https://Www."), k.cast("string"), F.lit(".Example/a?b")).alias("research_url"))
    return status.domains_of(rows)


# --- articles -----------------------------------------------------------------------------------------------------

STORED = """WITH articles AS (SELECT doc_id AS id, source AS source_id, CASE WHEN doc_id % 7 > 0 THEN doc_id % 2 = 0 END AS summarized, CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'metadata_only' WHEN 2 THEN 'failed' END AS content_status, text FROM documents)
"""


def stored_articles(read) -> DataFrame:
    k = F.col("doc_id")
    kind = F.when(k % 5 == 0, "ok").when(k % 5 == 1, "metadata_only").when(k % 5 == 2, "failed")
    return read("documents").select(k.alias("id"), F.col("source").alias("source_id"), F.when(k % 7 > 0, k % 2 == 0).alias("summarized"), kind.alias("content_status"), "text")


@query(STORED + """SELECT id, source_id, source_id = (SELECT min(source_id) FROM articles) AS of_first FROM articles WHERE NOT coalesce(summarized, false) AND coalesce(content_status, '') NOT IN ('ok', 'metadata_only') AND source_id IN (SELECT source FROM documents WHERE lang = 'en')""")
def pending_bodies(read):
    rows = stored_articles(read)
    handlers = read("documents").where("lang = 'en'").select(F.col("source").alias("source_id"))
    least = rows.agg(F.min("source_id")).first()[0]
    one = status.pending_content(rows, handlers, least).select("id", F.lit(True).alias("of_first"))
    out = status.pending_content(rows, handlers).select("id", "source_id").join(one, "id", "left")
    return out.withColumn("of_first", F.coalesce("of_first", F.lit(False)))


@query(STORED + """SELECT a.id, CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE content_status END AS content_status, CASE WHEN l.doc_id IS NOT NULL AND content_status = 'metadata_only' THEN 'low' END AS confidence, length(CASE WHEN l.doc_id IS NOT NULL THEN text END) AS n_chars
FROM articles a LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = a.id WHERE NOT coalesce(summarized, false) AND content_status IN ('ok', 'metadata_only')""")
def articles_with_body(read):
    rows = stored_articles(read)
    bodies = rows.select("id", "text").join(read("labels").select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    out = status.with_body(status.to_analyse(rows.drop("text")), bodies)
    return out.select("id", "content_status", status.confidence(F.col("content_status")).alias("confidence"), F.length("body").alias("n_chars"))


@query(STORED + """SELECT source_id, count(*) FILTER (content_status IN ('ok', 'metadata_only')) AS done, count(*) FILTER (coalesce(content_status, '') NOT IN ('ok', 'metadata_only')) AS failed FROM articles GROUP BY 1""")
def stage_counters(read):
    return status.stage_counts(stored_articles(read), ["source_id"])


@query("""WITH t AS (SELECT doc_id, CASE lang WHEN 'en' THEN ['ai-tech', 'macro-rates'] WHEN 'fr' THEN ['real-estate'] WHEN 'de' THEN [] END AS slugs FROM documents)
SELECT 'two' AS chosen, doc_id FROM t WHERE list_has_any(slugs, ['macro-rates', 'real-estate']) UNION ALL SELECT 'none', doc_id FROM t UNION ALL SELECT 'missing', doc_id FROM t WHERE list_has_any(slugs, ['esg-climate'])""")
def theme_filter(read):
    lang = F.col("lang")
    themes = F.when(lang == "en", F.array(F.lit("AI/Tech"), F.lit("Macro/Rates"))).when(lang == "fr", F.array(F.lit("Real Estate"))).when(lang == "de", F.array().cast("array<string>"))
    rows = read("documents").select("doc_id", themes.alias("themes"))
    chosen = {"two": ["macro-rates", "real-estate"], "none": [], "missing": ["esg-climate"]}
    pick = lambda slugs: status.by_themes(rows, F.array(*map(F.lit, slugs)) if slugs else F.array().cast("array<string>"))
    return status.union_all(*[pick(s).select(F.lit(n).alias("chosen"), "doc_id") for n, s in chosen.items()])


@query("""SELECT source, doc_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC NULLS LAST, doc_id) AS rn FROM (SELECT source, doc_id, CASE WHEN doc_id % 4 > 0 THEN DATE '2024-01-01' + CAST(doc_id % 50 AS INT) END AS day FROM documents)) WHERE rn <= 10""")
def newest_listing(read):
    day = F.when(F.col("doc_id") % 4 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 50).cast("int")))
    return status.newest_first(read("documents").select("source", "doc_id", day.alias("day")), ["source"], "day", "doc_id", 10).select("source", "doc_id", "rn")


@query("""WITH parts AS (SELECT doc_id % 4 AS page, source || '/' || doc_id % 60 AS url, doc_id, CASE WHEN doc_id % 3 > 0 THEN DATE '2024-01-01' + CAST(doc_id % 50 AS INT) END AS day, source FROM documents),
firsts AS (SELECT source, url, arg_min(doc_id, page * 10000000 + doc_id) AS doc_id FROM parts GROUP BY 1, 2)
SELECT source, url, doc_id, rn FROM (SELECT f.*, row_number() OVER (PARTITION BY f.source ORDER BY p.day DESC NULLS LAST, f.doc_id) AS rn FROM firsts f JOIN parts p USING (doc_id)) WHERE rn <= 10""")
def sub_listings(read):
    k = F.col("doc_id")
    day = F.when(k % 3 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int")))
    rows = read("documents").select("source", F.concat_ws("/", "source", (k % 60).cast("string")).alias("url"), "doc_id", day.alias("day"), (k % 4).alias("page"))
    pages = status.union_all(*[rows.where(F.col("page") == n) for n in range(4)])
    firsts = ingest.keep_first(pages, ["source", "url"], [F.col("page"), F.col("doc_id")])
    return status.newest_first(firsts, ["source"], "day", "doc_id", 10).select("source", "url", "doc_id", "rn")


@query("SELECT doc_id, lang, 'featured' AS kind FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT doc_id, NULL, 'list' FROM documents WHERE doc_id % 2 = 0")
def featured_and_list(read):
    d = read("documents")
    return status.union_all(d.where("doc_id % 10 = 0").select("doc_id", "lang", F.lit("featured").alias("kind")), d.where("doc_id % 2 = 0").select("doc_id", F.lit("list").alias("kind")))


@query("""WITH l AS (SELECT DISTINCT n, doc_id % 300 AS id FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS n FROM documents))
SELECT id, min(n) AS source FROM l WHERE id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""".replace("min(n) AS source", "min(n)::BIGINT AS source"))
def concatenated_sources(read):
    lang = F.col("lang")
    rows = read("documents").select((F.col("doc_id") % 300).alias("id"), F.when(lang == "en", 0).when(lang == "fr", 1).otherwise(2).alias("source"))
    return status.concatenated(read("supplier").select(F.col("s_suppkey").alias("id")), *[rows.where(F.col("source") == n) for n in range(3)]).select("id", "source")


# --- trials -------------------------------------------------------------------------------------------------------


@query(TRIALS.rstrip() + """, live AS (SELECT s_suppkey AS trial_id FROM supplier), c AS (SELECT trial_id, count(*) AS checked FROM checks GROUP BY 1)
SELECT trial_id, coalesce(checked, 0) AS checked, coalesce(articles, 0) AS articles, coalesce(days, 0) AS days, coalesce(mean, 0.0) AS mean FROM live LEFT JOIN rolled USING (trial_id) LEFT JOIN c USING (trial_id)""")
def trial_lines(read):
    e = read("events")
    checks = e.select(F.col("user_id").alias("trial_id"), F.to_date("ts").alias("date"), (F.col("event_type") != "error").alias("accessible"), (F.floor("value") % 5).alias("article_count"), "ts", "event_id")
    samples = e.where("value > 30").select(F.col("user_id").alias("trial_id"), (F.get_json_object("props", "$.k").cast("long") % 100 / F.lit(100.0)).alias("overall"))
    return report.trial_progress(funnel.first_of_day(checks, ["trial_id", "date"], ["ts", "event_id"]), samples, read("supplier").select(F.col("s_suppkey").alias("trial_id")))


@query("SELECT user_id AS trial_id, ts::DATE AS day, count(*) AS article_count, count(*) FILTER (event_type <> 'click') AS date_count FROM events GROUP BY 1, 2")
def listing_sizes(read):
    rows = read("events").select(F.col("user_id").alias("trial_id"), F.to_date("ts").alias("day"), F.when(F.col("event_type") != "click", F.to_date("ts")).alias("date"))
    return report.listing_size(rows, ["trial_id", "day"])


@query("SELECT c_custkey AS trial_id, c_custkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) AS fetcher_used FROM customer")
def handler_flags(read):
    return report.with_handler(read("customer").select(F.col("c_custkey").alias("trial_id")), read("supplier").where("s_acctbal > 3000").select(F.col("s_suppkey").alias("source_id")))


@query("""WITH s AS (SELECT n_nationkey::BIGINT AS id FROM nation WHERE n_regionkey < 4), a AS (SELECT DISTINCT s_nationkey::BIGINT AS id FROM supplier WHERE s_acctbal > 5000), b AS (SELECT DISTINCT c_nationkey::BIGINT AS id FROM customer WHERE c_nationkey <> 3), c AS (SELECT n_nationkey::BIGINT AS id FROM nation WHERE n_nationkey % 2 = 0)
SELECT id AS source_id, 'no ' || r AS gap FROM (SELECT id, 'listing handler' AS r FROM (SELECT id FROM s EXCEPT SELECT id FROM a) UNION ALL SELECT id, 'content handler' FROM (SELECT id FROM s EXCEPT SELECT id FROM b) UNION ALL SELECT id, 'colour' FROM (SELECT id FROM s EXCEPT SELECT id FROM c))
UNION ALL SELECT id, 'orphan ' || r FROM (SELECT id, 'listing handler' AS r FROM (SELECT id FROM a EXCEPT SELECT id FROM s) UNION ALL SELECT id, 'content handler' FROM (SELECT id FROM b EXCEPT SELECT id FROM s) UNION ALL SELECT id, 'colour' FROM (SELECT id FROM c EXCEPT SELECT id FROM s))""")
def registries_compared(read):
    n = read("nation")
    key = lambda c: F.col(c).cast("long").alias("source_id")
    registries = {"listing handler": read("supplier").where("s_acctbal > 5000").select(key("s_nationkey")), "content handler": read("customer").where("c_nationkey <> 3").select(key("c_nationkey")), "colour": n.where("n_nationkey % 2 = 0").select(key("n_nationkey"))}
    return report.registry_check(n.where("n_regionkey < 4").select(key("n_nationkey")), registries)


SAMPLED = """WITH sampled AS (SELECT user_id AS trial_id, dayofmonth(ts)::BIGINT AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) AS article_num FROM events),
answers AS (SELECT conv_id % 150 AS trial_id, turn + 1 AS day, turn % 3 + 1 AS article_num, conv_id AS seq, length(text) % 10 / 10.0::DOUBLE AS relevance, CASE WHEN turn % 2 = 0 THEN 0.5::DOUBLE END AS depth, 1.0::DOUBLE AS extractable FROM conversations),
last AS (SELECT * FROM answers QUALIFY row_number() OVER (PARTITION BY trial_id, day, article_num ORDER BY seq DESC) = 1),
scored AS (SELECT s.trial_id, s.day, s.article_num, round(coalesce(relevance, 0) * 0.4::DOUBLE + coalesce(depth, 0) * 0.4::DOUBLE + coalesce(extractable, 0) * 0.2::DOUBLE, 3) AS overall FROM sampled s LEFT JOIN last USING (trial_id, day, article_num))
"""


def scored_samples(read) -> DataFrame:
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("user_id", F.to_date("ts")).orderBy("event_id"))
    sampled = read("events").select(F.col("user_id").alias("trial_id"), F.dayofmonth("ts").cast("long").alias("day"), order.cast("long").alias("article_num"))
    turn = F.col("turn")
    answers = read("conversations").select((F.col("conv_id") % 150).alias("trial_id"), (turn + 1).alias("day"), (turn % 3 + 1).alias("article_num"), F.col("conv_id").alias("seq"), (F.length("text") % 10 / F.lit(10.0)).alias("relevance"), F.when(turn % 2 == 0, 0.5).alias("depth"), F.lit(1.0).alias("extractable"))
    return status.sample_scores(sampled, answers)


@query(SAMPLED + "SELECT trial_id, day, article_num, overall FROM scored")
def sample_scores(read):
    return scored_samples(read).select("trial_id", "day", "article_num", "overall")


@query(SAMPLED + "SELECT trial_id, day, round(avg(overall), 3) AS mean, count(*) AS n FROM scored GROUP BY 1, 2")
def sample_means(read):
    return status.sample_mean(scored_samples(read), ["trial_id", "day"])


@query("""WITH done AS (SELECT user_id AS trial_id, list_distinct(list(dayofmonth(ts))) AS d FROM events WHERE dayofmonth(ts) <= 3 AND value > 60 GROUP BY 1)
SELECT c_custkey AS trial_id, list_min(list_filter([1, 2, 3], lambda x: NOT list_contains(coalesce(d, []), x)))::BIGINT AS next_day FROM customer LEFT JOIN done ON trial_id = c_custkey""")
def sample_days(read):
    done = read("events").where("value > 60").select(F.col("user_id").alias("trial_id"), F.dayofmonth("ts").alias("day")).where("day <= 3")
    return status.next_sample_day(read("customer").select(F.col("c_custkey").alias("trial_id")), done)


DECIDED = TRIALS.rstrip() + """, started AS (SELECT c_custkey AS trial_id, DATE '2024-02-10' + CAST(c_custkey % 12 AS INT) AS start_date, c_custkey % 4 = 0 AS auto_decided, CASE WHEN c_custkey % 4 = 0 THEN 'skipped' END AS old FROM customer),
decided AS (SELECT trial_id, CASE WHEN DATE '2024-02-20' - start_date >= 3 AND NOT auto_decided THEN coalesce(r.outcome, 'fail_quantity') ELSE old END AS outcome, CASE WHEN auto_decided OR DATE '2024-02-20' - start_date >= 3 THEN 'history' ELSE 'active' END AS state FROM started LEFT JOIN rolled r USING (trial_id))
"""


def decided_trials(read) -> DataFrame:
    k = F.col("c_custkey")
    started = read("customer").select(k.alias("trial_id"), F.date_add(F.lit("2024-02-10").cast("date"), (k % 12).cast("int")).alias("start_date"), (k % 4 == 0).alias("auto_decided"), F.when(k % 4 == 0, "skipped").alias("outcome"))
    return funnel.decided(started, trials(read), F.lit("2024-02-20").cast("date"))


@query(DECIDED + "SELECT trial_id, outcome, state FROM decided")
def trial_machine(read):
    return decided_trials(read).select("trial_id", "outcome", "state")


@query(DECIDED + "SELECT state, outcome, count(*) AS n FROM decided GROUP BY 1, 2")
def trials_moved(read):
    active, done = status.moved(decided_trials(read))
    return status.union_all(active, done).groupBy("state", "outcome").agg(F.count(F.lit(1)).alias("n"))


# --- report -------------------------------------------------------------------------------------------------------

REPORT = CANDIDATES.rstrip() + """, active AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 6000), passed AS (SELECT id, arg_max(seq % 4, seq) AS trial_days, arg_max(seq % 50, seq) AS trial_articles, arg_max(seq % 100 / 100.0::DOUBLE, seq) AS trial_quality FROM history WHERE outcome = 'pass' GROUP BY 1),
pending AS (SELECT c.*, p.trial_days, p.trial_articles, p.trial_quality FROM candidates c JOIN passed p USING (id) WHERE id NOT IN (SELECT id FROM production))
"""
REPORT_ROWS = """SELECT 'production' AS section, id::BIGINT AS id, 'HIGH' AS quality, NULL::BIGINT AS trial_days FROM production UNION ALL SELECT 'trials', id, quality, NULL FROM candidates WHERE id IN (SELECT id FROM active) UNION ALL SELECT 'pass_pending', id, quality, trial_days FROM pending
UNION ALL SELECT 'queue', id, quality, NULL FROM candidates WHERE status = 'validated' AND id NOT IN (SELECT id FROM production) AND id NOT IN (SELECT id FROM active) AND id NOT IN (SELECT id FROM pending) UNION ALL SELECT status, id, quality, NULL FROM candidates WHERE status IN ('inaccessible', 'seed', 'rejected')"""


def report_parts(read) -> tuple[DataFrame, ...]:
    seq = F.col("seq")
    passed = history(read).select("id", "seq", "outcome", (seq % 4).alias("days"), (seq % 50).alias("articles"), (seq % 100 / F.lit(100.0)).alias("mean"))
    return candidates(read), read("supplier").where("s_acctbal > 6000").select(F.col("s_suppkey").alias("id")), passed, production(read)


@query(REPORT + f"SELECT section, id, quality, trial_days FROM ({REPORT_ROWS})")
def report_rows(read):
    return report.report(*report_parts(read)).select("section", "id", "quality", "trial_days")


@query(REPORT + f"SELECT section, count(*) AS n, min(id) AS first_id FROM ({REPORT_ROWS}) GROUP BY 1")
def report_stats(read):
    return report.report(*report_parts(read)).groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query(REPORT + "SELECT id, trial_days, trial_articles, trial_quality, row_number() OVER (ORDER BY coalesce(fit_score, 0) DESC, id) AS place FROM pending")
def passed_list(read):
    rows, _, passed, made = report_parts(read)
    return report.passed_list(report.pass_pending_rows(rows, passed, made)).select("id", "trial_days", "trial_articles", "trial_quality", "place")


@query(REPORT + "SELECT id, fit_score, priority FROM (SELECT c.id, c.fit_score, q.priority FROM candidates c JOIN active a USING (id) LEFT JOIN (SELECT id, round(" + "coalesce(nullif(quality_score, 0.0), CASE quality WHEN 'HIGH' THEN 1.0 WHEN 'MEDIUM' THEN 0.5 ELSE 0.0 END) * 0.6::DOUBLE + fit_score * 0.4::DOUBLE, 6) AS priority FROM candidates) q USING (id))")
def active_candidates(read):
    rows, active, _, _ = report_parts(read)
    priority = F.round(scoring.queue_priority(F.col("quality_score"), F.col("quality"), F.col("fit_score")), 6)
    return rows.join(active.distinct(), "id").select("id", "fit_score", priority.alias("priority"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 AND (o_orderkey % 7 = 0 OR DATE '1998-08-02' - o_orderdate::DATE >= 7)")
def validations_due(read):
    k = F.col("o_orderkey")
    rows = read("orders").select("o_orderkey", F.when(k % 5 == 0, False).when(k % 5 == 1, True).alias("active"), F.when(k % 7 > 0, F.col("o_orderdate")).alias("verified_at"))
    return status.validation_due(rows, F.lit("1998-08-02").cast("date")).select("o_orderkey")


@query(LABELLED + "SELECT fund_id, count(*) FILTER (label = 'good') AS n_good, row_number() OVER (ORDER BY fund_id) AS place FROM scored GROUP BY 1")
def evaluation_table(read):
    return status.in_order(ranking.quality_per_fund(rated(read)).select("fund_id", "n_good"), "fund_id")


@query("SELECT source AS source_id, count(*) AS n, row_number() OVER (ORDER BY min(doc_id)) AS place FROM documents GROUP BY 1")
def source_order(read):
    rows = read("documents").groupBy(F.col("source").alias("source_id")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("_pos"))
    return status.in_order(rows, "_pos").drop("_pos")


@query("""WITH l AS (SELECT doc_id % 100 AS id, quality FROM labels) SELECT 'good' AS label, id, count(*) AS n FROM l WHERE quality = 1 GROUP BY 2 UNION ALL SELECT 'bad', id, count(*) FROM l WHERE quality = 0 GROUP BY 2""")
def good_and_bad(read):
    rows = read("labels").select((F.col("doc_id") % 100).alias("id"), "quality")
    both = status.union_all(rows.where("quality = 1").select(F.lit("good").alias("label"), "id"), rows.where("quality = 0").select(F.lit("bad").alias("label"), "id"))
    return both.groupBy("label", "id").agg(F.count(F.lit(1)).alias("n"))
