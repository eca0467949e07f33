"""The reference's operators over the driver tables, each with its SQL.

Stand-ins: a page's host or a document's source is the source id, a user of the events is a monitored source,
customers are candidates and orders their history. Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import dates, html, scoring, sql, text, urls
from quillstream.operators import funnel, health, ingest, ranking, views
from quillstream.plans.base import AS_OF, as_of, query
from quillstream.sources import shared

# --- pages: scores, gates, links ---------------------------------------------------------------------------------

ALLOWED = ["example.org", "m.thntedth.example.com"]
GOOD_WORDS, BAD_WORDS = [*urls.RESEARCH_WORDS, "en"], [*urls.OTHER_WORDS, "de"]
PHRASES = [*scoring.WALL_PHRASES, *scoring.NOTICE_PHRASES, "&middot;", "is and "]
SQL_HOST = f"lower(regexp_extract(url, '{urls.HOST}', 1))"
SQL_PATH = f"regexp_extract(url, '{urls.PATH}', 1)"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _sql_scores(good_words: list[str] = GOOD_WORDS, bad_words: list[str] = BAD_WORDS, phrase_list: list[str] = PHRASES) -> str:
    domain = "greatest(" + ", ".join(f"CASE WHEN host IN ('{d}', 'www.{d}') THEN 1.0::DOUBLE WHEN ends_with(host, '.{d}') THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END" for d in ALLOWED) + ")"
    tokens = "list_distinct(regexp_split_to_array(lower(path), '[/_-]'))"
    pos, neg = (f"len(list_intersect({tokens}, {_list(w)}))" for w in (good_words, bad_words))
    count = lambda p: f"len(regexp_extract_all(low, '{_quoted(p)}'))"
    flag = lambda p, n=1: f"CASE WHEN regexp_matches(low, '{_quoted(p)}') THEN {n} ELSE 0 END"
    good = " + ".join([f"least({count(scoring.ARTICLE)}, 2)", f"least({count(scoring.TIME)}, 1)", f"least({count(scoring.PDF)}, 3)", *[flag(p) for p in scoring.SIGNS_FOR]])
    bad = " + ".join([*[flag(p, n) for p, n in scoring.SIGNS_AGAINST], f"CASE WHEN {count(scoring.ARTICLE)} + {count(scoring.PDF)} + {count(scoring.TIME)} = 0 THEN 2 ELSE 0 END"])
    phrases = " + ".join(f"CASE WHEN contains(low, '{p}') THEN 1 ELSE 0 END" for p in phrase_list)
    return f"""WITH base AS (SELECT page_id, url, html, lower(html) AS low, {SQL_HOST} AS host, {SQL_PATH} AS path FROM pages),
parts AS (SELECT page_id, url, host, html, {domain} AS domain_score, {pos} AS pos, {neg} AS neg, {good} AS good, {bad} AS bad, {phrases} AS phrases FROM base),
scored AS (SELECT page_id, url, host, html, domain_score, CASE WHEN pos + neg = 0 THEN 0.5::DOUBLE ELSE pos::DOUBLE / (pos + neg) END AS path_score,
  CASE WHEN coalesce(html, '') = '' THEN 0.0::DOUBLE WHEN good + bad = 0 THEN 0.5::DOUBLE ELSE good::DOUBLE / (good + bad) END AS structure_score,
  least(1.0::DOUBLE, phrases * 0.15::DOUBLE) AS gate_penalty FROM parts),
final AS (SELECT *, domain_score * 0.2::DOUBLE + path_score * 0.3::DOUBLE + structure_score * 0.3::DOUBLE + (1 - gate_penalty) * 0.2::DOUBLE AS final_score FROM scored)
"""


SCORES = _sql_scores()


def scored_pages(read) -> DataFrame:
    """Components and final score of every page. Stored: a filter on a score is then not pushed below the scoring, which
    would score every page twice."""
    url, page, low = F.col("url"), F.col("html"), F.col("_low")
    rows = read("pages").withColumn("_low", F.lower("html"))
    rows = rows.select("page_id", "url", page.isNotNull().alias("fetched"), urls.host(url).alias("host"), urls.domain_score(url, F.array(*map(F.lit, ALLOWED))).alias("domain_score"), urls.path_score(url, GOOD_WORDS, BAD_WORDS).alias("path_score"), scoring.structure_score(page, low).alias("structure_score"), scoring.gate_penalty(page, PHRASES, low).alias("gate_penalty"))
    return shared.stored(rows.withColumn("final_score", scoring.final_score(*[F.col(c) for c in ("domain_score", "path_score", "structure_score", "gate_penalty")])), "scores")


@query(SCORES + "SELECT page_id, domain_score, path_score, structure_score, round(gate_penalty, 6) AS gate_penalty, round(final_score, 6) AS final_score FROM final")
def page_scores(read):
    return scored_pages(read).select("page_id", "domain_score", "path_score", "structure_score", F.round("gate_penalty", 6).alias("gate_penalty"), F.round("final_score", 6).alias("final_score"))


@query(SCORES + """SELECT host, page_id, rn, rn = 1 AS active, round(final_score, 6) AS final_score FROM (
SELECT *, row_number() OVER (PARTITION BY host ORDER BY final_score DESC, page_id) AS rn FROM final WHERE final_score >= 0.5) WHERE rn <= 3""")
def page_top_entrypoints(read):
    return ranking.top_entrypoints(scored_pages(read), "host", "page_id").select("host", "page_id", "rn", "active", F.round("final_score", 6).alias("final_score"))


@query(SCORES + "SELECT CASE WHEN final_score >= 0.6 THEN 'candidate' WHEN final_score < 0.4 THEN 'rejected' ELSE 'borderline' END AS band, count(*) AS n FROM final WHERE domain_score > 0 GROUP BY 1")
def score_bands(read):
    return scored_pages(read).where("domain_score > 0").groupBy(scoring.band(F.col("final_score")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(SCORES + """SELECT host, bool_or(status <> 'ok') AS any_bad, sum((status = 'degraded')::INT)::BIGINT AS degraded FROM (
SELECT host, CASE WHEN html IS NULL THEN 'error' WHEN final_score >= 0.7 THEN 'ok' ELSE 'degraded' END AS status FROM final) GROUP BY host""")
def health_status(read):
    rows = scored_pages(read).withColumn("status", scoring.health(F.when(F.col("fetched"), ""), F.col("final_score"), 0.7))
    return rows.groupBy("host").agg(F.bool_or(F.col("status") != "ok").alias("any_bad"), F.count_if(F.col("status") == "degraded").alias("degraded"))


@query(_sql_scores(urls.RESEARCH_WORDS, urls.OTHER_WORDS, scoring.WALL_PHRASES + scoring.NOTICE_PHRASES) + "SELECT page_id, round(domain_score, 4) AS domain_score, round(path_score, 4) AS path_score, round(structure_score, 4) AS structure_score, round(gate_penalty, 4) AS gate_penalty, round(final_score, 4) AS final_score FROM final")
def page_components(read):
    return read("pages").select("page_id", scoring.page_components(F.col("url"), F.col("html"), F.array(*map(F.lit, ALLOWED))).alias("s")).select("page_id", "s.*")


def _page_score_sql(read) -> DataFrame:
    spark = read("pages").sparkSession
    sql.register(spark)
    return spark.sql(f"SELECT page_id, s.* FROM (SELECT page_id, score_page(url, html, {sql.words(ALLOWED)}) AS s FROM {{pages}})", pages=read("pages"))


@query(_sql_scores(urls.RESEARCH_WORDS, urls.OTHER_WORDS, scoring.WALL_PHRASES + scoring.NOTICE_PHRASES) + "SELECT page_id, round(domain_score, 4) AS domain_score, round(path_score, 4) AS path_score, round(structure_score, 4) AS structure_score, round(gate_penalty, 4) AS gate_penalty, round(final_score, 4) AS final_score FROM final")
def page_scores_sql(read):
    """page_components by the functions registered for SQL."""
    return _page_score_sql(read)


@query(f"SELECT w AS word, len(list_filter([w], lambda x: list_contains({_list(urls.RESEARCH_WORDS)}, x))) > 0 AS good, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_split_to_array(lower({SQL_PATH}), '[/_-]'))) AS w FROM (SELECT CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1/Research/about-team') ELSE url END AS url FROM pages)) WHERE list_contains({_list(urls.RESEARCH_WORDS + urls.OTHER_WORDS)}, w) GROUP BY 1, 2")
def path_words(read):
    """Words of paths that speak for or against a page, by a table function in a LATERAL join."""
    spark = read("pages").sparkSession
    sql.register(spark)
    pages = read("pages").withColumn("url", F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", r"^([a-z]+://[^/?#]*)", "$1/Research/about-team")).otherwise(F.col("url")))
    return spark.sql("SELECT word, good, count(*) AS n FROM {pages}, LATERAL path_words(url) GROUP BY word, good", pages=pages)


@query(f"SELECT page_id, substr(sha256({SQL_HOST} || ':' || url), 1, 16) AS article_id FROM pages")
def article_ids(read):
    return read("pages").select("page_id", urls.article_id(urls.host(F.col("url")), F.col("url")).alias("article_id"))


@query(f"""WITH p AS (SELECT page_id, {SQL_HOST} AS host FROM pages)
SELECT host = 'example.org' OR ends_with(host, '.example.org') AS admitted, count(*) AS n, min(page_id) AS first_page FROM p GROUP BY 1""")
def host_gate(read):
    registry = read("pages").sparkSession.createDataFrame([("all", "example.org")], "source_id string, expected_hostname string")
    rows = ingest.gate_by_host(read("pages").withColumn("source_id", F.lit("all")), F.broadcast(registry))
    return rows.groupBy("admitted").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))


A_HREF = r"""<a\s[^>]*href="([^"]*)\""""
LINKS = f"""links AS (SELECT page_id, host, url, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos FROM (
  SELECT page_id, url, {SQL_HOST} AS host, regexp_extract_all(html, '{A_HREF}', 1) AS l FROM pages)),
good_links AS (SELECT page_id, host, pos, regexp_extract(url, '{urls.ORIGIN}', 1) || href AS link FROM links WHERE href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(lower(href), 'javascript:'))
"""


def page_links(read) -> DataFrame:
    url = F.col("url")
    rows = read("pages").select("page_id", "url", urls.host(url).alias("host"), F.posexplode(F.regexp_extract_all("html", F.lit(A_HREF), 1)).alias("pos", "href"))
    return rows.where(urls.is_followable(F.col("href"))).select("page_id", "host", F.col("pos").cast("long").alias("pos"), urls.resolve(url, F.col("href")).alias("link"))


@query(f"WITH {LINKS} SELECT page_id, pos, link FROM good_links")
def page_links_regex(read):
    return page_links(read).select("page_id", "pos", "link")


@query(f"WITH {LINKS} SELECT host, link, page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY host, link ORDER BY page_id, pos) AS rn FROM good_links) WHERE rn = 1")
def url_dedup_first(read):
    return ingest.keep_first(page_links(read), ["host", "link"], [F.col("page_id"), F.col("pos")]).select("host", "link", "page_id", "pos")


@query(f"""WITH {LINKS}, firsts AS (SELECT host, link, min(page_id * 1000 + pos) AS place FROM good_links GROUP BY 1, 2)
SELECT host, link, rn FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY place) AS rn FROM firsts) WHERE rn <= 10""")
def per_source_cap(read):
    firsts = page_links(read).groupBy("host", "link").agg(F.min(F.col("page_id") * 1000 + F.col("pos")).alias("place"))
    return ingest.top_n(firsts, ["host"], [F.col("place")], 10).select("host", "link", "rn")


RESEARCH, OTHER = ["the", "of", "de", "la"], ["und", "is"]


@query(f"""WITH {LINKS}, s AS (SELECT *, list_filter(string_split(lower(regexp_extract(link, '{urls.PATH}', 1)), '/'), lambda x: x <> '') AS seg FROM good_links),
k AS (SELECT page_id, link, min(pos) AS pos FROM s WHERE list_has_any(seg, {_list(RESEARCH)}) AND NOT list_has_any(seg, {_list(OTHER)}) GROUP BY 1, 2)
SELECT page_id, link, rn FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM k) WHERE rn <= 20""")
def research_links(read):
    rows = page_links(read).where(urls.has_word(F.col("link"), RESEARCH) & ~urls.has_word(F.col("link"), OTHER))
    firsts = rows.groupBy("page_id", "link").agg(F.min("pos").alias("pos"))
    return ingest.top_n(firsts, ["page_id"], [F.col("pos")], 20).select("page_id", "link", "rn")


@query(f"""WITH {LINKS} SELECT l.page_id, count(*) AS n_new FROM good_links l WHERE NOT EXISTS (
SELECT 1 FROM good_links o JOIN pages q ON q.page_id = o.page_id WHERE contains(q.url, '/en/') AND o.link = l.link) AND NOT contains((SELECT url FROM pages q WHERE q.page_id = l.page_id), '/en/') GROUP BY 1""")
def new_articles_anti(read):
    stored = F.contains(F.col("url"), F.lit("/en/"))
    rows = page_links(read).join(read("pages").select("page_id", stored.alias("stored")).hint("merge"), "page_id")
    fresh = ingest.new_rows(rows.where("not stored").withColumnRenamed("link", "id"), rows.where("stored").select(F.col("link").alias("id")).distinct())
    return fresh.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_new"))


@query(f"""WITH p AS (SELECT page_id, url, {SQL_HOST} AS host FROM pages), s AS (SELECT host AS source_id, min(url) AS url FROM p GROUP BY host),
e AS (SELECT host AS source_id, arg_min(url, page_id) AS ep FROM p WHERE contains(url, '?') GROUP BY host)
SELECT source_id, coalesce(ep, url) AS url FROM s LEFT JOIN e USING (source_id)""")
def entrypoint_fallback(read):
    p = read("pages").select("page_id", "url", urls.host(F.col("url")).alias("source_id"))
    entry = p.select("source_id", "url", F.col("page_id").alias("pos"), F.when(F.contains(F.col("url"), F.lit("?")), True).alias("active"))
    return ingest.resolve_sources(p.groupBy("source_id").agg(F.min("url").alias("url")), entry)


LOGIN = ["log in", "sign in", "register", "subscribe to read", "create an account", "forgot password", "sign up"]
COUNT = lambda name: f"len(regexp_extract_all(lower(html), '<{name}[\\s>]'))"


@query(f"""WITH s AS (SELECT page_id, {COUNT('article')} AS a, {COUNT('time')} AS t, {COUNT('p')} AS h2, {COUNT('li')} AS d FROM pages)
SELECT page_id, greatest(t, d, least(h2, 20)) AS estimate, (a >= 2)::INT + (t >= 2)::INT + (d >= 2)::INT AS index_signals,
CASE WHEN page_id % 7 = 0 THEN 'not accessible' WHEN (a >= 2)::INT + (t >= 2)::INT + (d >= 2)::INT >= 2 OR h2 >= 6 THEN 'index' ELSE 'no index' END AS reason FROM s""".replace("AS estimate, (a", "::BIGINT AS estimate, ((a").replace("(d >= 2)::INT AS index_signals", "(d >= 2)::INT)::BIGINT AS index_signals"))
def screen_verdict(read):
    n = lambda tag: F.regexp_count(F.lower("html"), F.lit(rf"<{tag}[\s>]"))
    rows = read("pages").select("page_id", F.when(F.col("page_id") % 7 == 0, 404).otherwise(200).alias("status"), F.lit(False).alias("has_password"), scoring.phrase_count(F.lower("html"), ["type=\"password\""]).alias("login_phrases"), n("article").alias("articles"), n("time").alias("times"), n("li").alias("dates"), n("p").alias("h2"))
    estimate = funnel.index_estimate(F.col("times"), F.col("dates"), F.col("h2"))
    return funnel.screen_verdict(rows.withColumn("estimate", estimate).withColumn("h2", F.expr("h2 div 2"))).select("page_id", "estimate", "index_signals", "reason")


def _decoded(sql: str) -> str:
    """Character references as HTML reads them: these names need no semicolon, numbers none where a piece ends."""
    for name, char in (("&quot;?", '"'), ("&#x27(;|$)", "''"), ("&#39(;|$)", "''"), ("&lt;?", "<"), ("&gt;?", ">"), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        sql = f"regexp_replace({sql}, '{name}', '{char}', 'g')"
    return sql


def _pieces(sql: str) -> str:
    """Text between tags, white space squeezed, empty pieces left out."""
    return f"list_filter(list_transform(regexp_split_to_array({sql}, '<[^>]+>'), lambda x: trim(regexp_replace({_decoded('x')}, '\\s+', ' ', 'g'))), lambda x: x <> '')"


WITHOUT = "regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'), '<(nav|footer)>.*?</(nav|footer)>', '', 'gs'), '<!--.*?-->', '', 'gs')"
BODIES = f"""bodies AS (SELECT page_id, array_to_string({_pieces("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")}, chr(10)) AS text, array_to_string({_pieces(f"regexp_extract({WITHOUT}, '<body>(.*)$', 1, 's')")}, chr(10)) AS whole FROM pages)"""


def stored_elements(read) -> DataFrame:
    return shared.stored(html.elements(read("pages")), "elements")


@query(f"WITH {BODIES} SELECT page_id, text FROM bodies WHERE length(text) >= 101")
def body_text_dom(read):
    return html.body_text(stored_elements(read), 101)


@query(f"WITH {BODIES} SELECT page_id, CASE WHEN length(text) > 100 THEN 2 ELSE 3 END::BIGINT AS selector_rank, CASE WHEN length(text) > 100 THEN text ELSE whole END AS text FROM bodies WHERE greatest(length(text), length(whole)) > 100")
def body_by_rules(read):
    rows = stored_elements(read).withColumn("source_id", F.lit(""))
    rules = html.body_rules(rows.sparkSession, [("", 1, "main", None), ("", 2, "article", None), ("", 3, "body", None)])
    return html.body_by_rules(rows, rules)


@query(f"""SELECT page_id, coalesce(list_sum(list_transform({_pieces(WITHOUT)}, lambda x: length(x))), 0)::BIGINT AS n_chars, len(regexp_extract_all({WITHOUT}, '<[a-z]'))::BIGINT AS n_elements FROM pages""")
def chrome_removed_length(read):
    rows = html.without_chrome(html.elements(read("pages")))
    return rows.groupBy("page_id").agg(F.sum(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("n_elements"))


# --- documents as articles ---------------------------------------------------------------------------------------

ARTICLES = """WITH articles AS (SELECT doc_id AS id, doc_id AS seq, source AS source_id, substr(split_part(text, chr(10), 1), 1, 40) AS title,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(doc_id * 7 % 60 AS INT) END AS date, n_chars > 500 AS summarized, n_chars, lang, text,
  CASE WHEN lang = 'en' AND doc_id % 2 = 0 THEN ['AI/Tech', 'Macro/Rates'] WHEN lang = 'en' THEN ['AI/Tech'] WHEN lang = 'fr' THEN ['Real Estate', 'AI/Tech'] WHEN lang = 'de' THEN [] ELSE NULL END AS themes
  FROM documents)
"""
DAY = "coalesce(date, DATE '1970-01-01')"


def articles(read) -> DataFrame:
    lang, doc = F.col("lang"), F.col("doc_id")
    themes = F.when((lang == "en") & (doc % 2 == 0), F.array(F.lit("AI/Tech"), F.lit("Macro/Rates"))).when(lang == "en", F.array(F.lit("AI/Tech"))).when(lang == "fr", F.array(F.lit("Real Estate"), F.lit("AI/Tech"))).when(lang == "de", F.array().cast("array<string>"))
    day = F.when(doc % 11 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (doc * 7 % 60).cast("int")))
    return read("documents").select(doc.alias("id"), doc.alias("seq"), F.col("source").alias("source_id"), F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 40).alias("title"), day.alias("date"), (F.col("n_chars") > 500).alias("summarized"), "n_chars", "lang", "text", themes.alias("themes"))


@query(ARTICLES + f"SELECT id, position, position <= 20 AS visible, (SELECT count(*) FROM articles) - position AS remaining FROM (SELECT id, row_number() OVER (ORDER BY {DAY} DESC, seq) AS position FROM articles)")
def timeline(read):
    return views.timeline(articles(read).select("id", "seq", "date")).select("id", "position", "visible", "remaining")


@query(ARTICLES + "SELECT theme, count(*) AS n, min(seq) AS first_seq FROM (SELECT unnest(themes) AS theme, seq FROM articles WHERE summarized) GROUP BY theme")
def theme_counts(read):
    return views.theme_counts(articles(read))


CLUSTER = "coalesce(themes[1], 'General')"


@query(ARTICLES + f"""SELECT {CLUSTER} AS cluster, count(*) AS n, count(*) FILTER (date >= DATE '{AS_OF}' - 7) AS n_week, count(DISTINCT source_id) AS n_sources,
string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources, count(DISTINCT source_id) >= 2 AS cross_fund, {CLUSTER} = 'General' AS last, min(seq) AS first_seq, row_number() OVER (ORDER BY {CLUSTER} = 'General', count(*) DESC, min(seq)) AS place FROM articles GROUP BY {CLUSTER}""")
def theme_clusters(read):
    return views.theme_clusters(articles(read), as_of())


@query(ARTICLES + f"SELECT {CLUSTER} AS cluster, id, row_number() OVER (PARTITION BY {CLUSTER} ORDER BY {DAY} DESC, seq) AS position FROM articles")
def cluster_members(read):
    return views.cluster_members(articles(read))


@query(ARTICLES + f"""SELECT cluster, count(*) AS n, min(position) AS first FROM (SELECT {CLUSTER} AS cluster, themes, row_number() OVER (PARTITION BY {CLUSTER} ORDER BY {DAY} DESC, seq) AS position FROM articles) WHERE list_has_any(themes, ['Macro/Rates', 'Real Estate']) GROUP BY 1""")
def cluster_theme_filter(read):
    rows = articles(read)
    hits = views.clusters_with_theme(views.cluster_members(rows), rows, F.array(F.lit("Macro/Rates"), F.lit("Real Estate")))
    return hits.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))


@query(ARTICLES + f"""SELECT s.source_id, count(a.id) AS n, count(a.id) FILTER (a.summarized) AS analysed, arg_max_null(a.date, {DAY.replace('date,', 'a.date,')} - DATE '1960-01-01' + 1 - a.seq / 1e12) AS latest
FROM (SELECT DISTINCT source AS source_id FROM documents) s LEFT JOIN articles a ON a.source_id = s.source_id AND a.n_chars > 300 GROUP BY s.source_id""")
def fund_rollup(read):
    return views.fund_rollup(read("documents").select(F.col("source").alias("source_id")).distinct(), articles(read).where("n_chars > 300"))


@query(ARTICLES + "SELECT source_id, n, round(n / max(n) OVER () * 100, 1) AS percent, (sum(n) OVER ())::BIGINT AS total, count(*) OVER () AS funds FROM (SELECT source_id, count(*) AS n FROM articles GROUP BY 1)")
def fund_distribution(read):
    return views.fund_distribution(articles(read).groupBy("source_id").agg(F.count(F.lit(1)).alias("n")))


@query(ARTICLES + f"SELECT count(*) AS total, count(*) FILTER (date >= DATE '{AS_OF}' - 7) AS n_week, count(DISTINCT source_id) AS n_sources, count(*) FILTER (coalesce(len(themes), 0) = 0) AS unthemed FROM articles")
def headline(read):
    return views.headline(articles(read), as_of())


@query(ARTICLES + f"SELECT source_id, count(*) AS tracked, count(*) FILTER (summarized) AS analysed FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY {DAY} DESC, seq) AS rn FROM articles) WHERE rn <= 5 GROUP BY 1")
def latest_five(read):
    return views.latest_five(articles(read))


@query(ARTICLES + "SELECT source_id, t AS title, id FROM (SELECT *, trim(title) AS t, row_number() OVER (PARTITION BY source_id, trim(title) ORDER BY (lang = 'fr') DESC, seq) AS rn FROM articles) WHERE rn = 1")
def preference_dedup(read):
    rows = articles(read).select("source_id", text.without_audio_mark(F.col("title")).alias("title"), "id", "lang", F.col("seq").alias("pos"))
    return ingest.prefer(rows, ["source_id", "title"], F.col("lang") == "fr").select("source_id", "title", "id")


@query(ARTICLES + """SELECT id, length(text) > 100 AS long_enough, contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'the and ') AS gated,
  NOT summarized AND NOT coalesce(lang IN ('fr', 'de'), false) AS pending FROM articles""")
def content_gate(read):
    t = F.lower(text.squeezed(F.col("text")))
    return articles(read).select("id", text.long_enough(F.col("text")).alias("long_enough"), (scoring.phrase_count(t, ["the and "]) > 0).alias("gated"), (~F.col("summarized") & ~F.coalesce(F.col("lang").isin("fr", "de"), F.lit(False))).alias("pending"))


@query(ARTICLES + "SELECT a.source_id, count(*) FILTER (l.doc_id IS NOT NULL AND NOT a.summarized) AS eligible, count(*) FILTER (l.doc_id IS NULL) AS failed FROM articles a LEFT JOIN labels l ON l.doc_id = a.id GROUP BY 1")
def analysis_eligible(read):
    body = read("labels").select(F.col("doc_id").alias("id"), F.lit(True).alias("has_body"))
    rows = articles(read).select("id", "source_id", "summarized").join(body, "id", "left")
    has = F.coalesce("has_body", F.lit(False))
    return rows.groupBy("source_id").agg(F.count_if(has & ~F.col("summarized")).alias("eligible"), F.count_if(~has).alias("failed"))


@query(ARTICLES + """SELECT source_id, n, untitled, dated, "foreign", untitled = 0 AND dated >= n * 0.8 AND "foreign" = 0 AND n BETWEEN 1 AND 50 AS passed FROM (
SELECT source_id, count(*) AS n, count(*) FILTER (coalesce(title, '') = '') AS untitled, count(date) AS dated, count(*) FILTER (lang = 'xx') AS "foreign" FROM articles GROUP BY 1)""")
def quality_audit(read):
    rows = articles(read).withColumn("admitted", F.col("lang") != "xx")
    ranges = rows.select("source_id").distinct().withColumns({"least": F.lit(1), "most": F.lit(50)})
    return health.audit(rows, ranges)


@query(ARTICLES + """SELECT source_id, n, n_quality, n_noise, round(n_quality / n, 4) AS "yield", CASE WHEN round(n_quality / n, 4) >= 0.7 THEN 'OK' WHEN round(n_quality / n, 4) >= 0.4 THEN 'LOW' ELSE 'BAD' END AS band FROM (
SELECT source_id, count(*) AS n, count(*) FILTER (summarized AND length(title) >= 20 AND NOT regexp_matches(title, '[&!]{1}')) AS n_quality, count(*) FILTER (regexp_matches(title, '[&!]{1}')) AS n_noise FROM articles GROUP BY 1)""")
def article_yield(read):
    return health.article_yield(articles(read).withColumn("takeaway", F.col("title")), ["[&!]{1}"])


@query(ARTICLES + "SELECT id, trim(regexp_replace(lower(title), '[^\\p{L}\\p{N}]+', '-', 'g'), '-') AS slug FROM articles")
def theme_slugs(read):
    return articles(read).select("id", text.slug(F.col("title")).alias("slug"))


@query(ARTICLES + """SELECT id, CASE WHEN title <> '' OR lang = 'fr' THEN concat_ws(chr(10), CASE WHEN title <> '' THEN 'Title: ' || title END, CASE WHEN lang <> 'en' THEN 'Category: ' || lang END, CASE WHEN lang = 'fr' THEN 'Summary: ' || lang END) END AS body FROM articles""")
def metadata_bodies(read):
    lang = F.col("lang")
    return articles(read).select("id", text.metadata_body(F.col("title"), F.when(lang != "en", lang), F.when(lang == "fr", lang)).alias("body"))


# --- labelled documents: ranking quality --------------------------------------------------------------------------

LABELLED = """WITH labelled AS (SELECT d.source AS fund_id, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS label, 1.0::DOUBLE AS domain_score, (d.doc_id % 10) / 10.0::DOUBLE AS path_score,
  least(d.n_chars, 2000) / 2000.0::DOUBLE AS structure_score, l.toxic * 0.5::DOUBLE AS gate_penalty FROM documents d JOIN labels l USING (doc_id)),
scored AS (SELECT fund_id, label, domain_score * 0.2::DOUBLE + path_score * 0.3::DOUBLE + structure_score * 0.3::DOUBLE + (1 - gate_penalty) * 0.2::DOUBLE AS final_score FROM labelled)
"""


def labelled(read) -> DataFrame:
    rows = read("documents").select("doc_id", "source", "n_chars").join(read("labels"), "doc_id")
    return rows.select(F.col("source").alias("fund_id"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"), F.lit(1.0).alias("domain_score"), (F.col("doc_id") % 10 / F.lit(10.0)).alias("path_score"), (F.least("n_chars", F.lit(2000)) / F.lit(2000.0)).alias("structure_score"), (F.col("toxic") * F.lit(0.5)).alias("gate_penalty"))


PARTS = ("domain_score", "path_score", "structure_score", "gate_penalty")


def rated(read) -> DataFrame:
    return labelled(read).select("fund_id", "label", scoring.final_score(*map(F.col, PARTS)).alias("final_score"))


SQL_COUNTS = """count(*) FILTER (label = 'good') AS n_good, count(*) FILTER (label = 'bad') AS n_bad, count(*) FILTER (label = 'good' AND final_score >= 0.5) AS good_above,
count(*) FILTER (label = 'bad' AND NOT final_score >= 0.5) AS bad_below, avg(final_score) FILTER (label = 'good') AS g, avg(final_score) FILTER (label = 'bad') AS b"""


@query(LABELLED + f"""SELECT fund_id, n_good, n_bad, good_above, bad_below, round(CASE WHEN n_good > 0 THEN good_above / n_good ELSE 1.0 END, 9) AS "precision",
round(CASE WHEN n_bad > 0 THEN bad_below / n_bad ELSE 0.0 END, 9) AS reject_rate, round(coalesce(g, 0.0), 9) AS avg_good, round(coalesce(b, 0.0), 9) AS avg_bad,
round(CASE WHEN n_bad > 0 THEN coalesce(g, 0.0) - coalesce(b, 0.0) ELSE coalesce(g, 0.0) END, 9) AS separation FROM (SELECT fund_id, {SQL_COUNTS} FROM scored GROUP BY 1)""")
def ranking_quality(read):
    return ranking.quality_per_fund(rated(read), digits=9)


@query(LABELLED + f"""SELECT n_good, n_bad, round(p, 4) AS "precision", round(r, 4) AS reject_rate, round(p * 0.6 + r * 0.4, 4) AS overall FROM (
SELECT n_good, n_bad, CASE WHEN n_good > 0 THEN good_above / n_good ELSE 0.0 END AS p, CASE WHEN n_bad > 0 THEN bad_below / n_bad ELSE 0.0 END AS r FROM (SELECT {SQL_COUNTS} FROM scored))""")
def ranking_overall(read):
    return ranking.overall(rated(read))


@query(LABELLED + f"""SELECT fund_id, false AS pooled, n_good, n_bad, round(CASE WHEN n_good > 0 THEN good_above / n_good ELSE 1.0 END, 4) AS "precision", round(CASE WHEN n_bad > 0 THEN bad_below / n_bad ELSE 0.0 END, 4) AS reject_rate,
round(CASE WHEN n_bad > 0 THEN coalesce(g, 0.0) - coalesce(b, 0.0) ELSE coalesce(g, 0.0) END, 9) AS separation, NULL::DOUBLE AS overall FROM (SELECT fund_id, {SQL_COUNTS} FROM scored GROUP BY 1)
UNION ALL SELECT NULL, true, n_good, n_bad, round(p, 4), round(r, 4), NULL, round(p * 0.6 + r * 0.4, 4) FROM (
SELECT n_good, n_bad, CASE WHEN n_good > 0 THEN good_above / n_good ELSE 0.0 END AS p, CASE WHEN n_bad > 0 THEN bad_below / n_bad ELSE 0.0 END AS r FROM (SELECT {SQL_COUNTS} FROM scored))""")
def ranking_report(read):
    rows = ranking.ranking_report(rated(read), digits=9)
    return rows.select("fund_id", "pooled", "n_good", "n_bad", F.round("precision", 4).alias("precision"), F.round("reject_rate", 4).alias("reject_rate"), "separation", "overall")


SWEEP = LABELLED + """, one AS (SELECT unnest(range(1, 10)) AS k),
grid AS (SELECT a.k / 10.0::DOUBLE AS wd, b.k / 10.0::DOUBLE AS wp, c.k / 10.0::DOUBLE AS ws, (10 - a.k - b.k - c.k) / 10.0::DOUBLE AS wg, a.k * 10000 + b.k * 100 + c.k AS weight_id FROM one a, one b, one c),
fine AS (SELECT * FROM grid WHERE wd BETWEEN 0.05 AND 0.6 AND wp BETWEEN 0.05 AND 0.6 AND ws BETWEEN 0.05 AND 0.6 AND wg BETWEEN 0.05 AND 0.6),
rated AS (SELECT weight_id, label, round(domain_score * wd + path_score * wp + structure_score * ws + (1 - gate_penalty) * wg, 4) AS final_score FROM labelled, fine),
counted AS (SELECT weight_id, count(*) FILTER (label = 'good') AS n_good, count(*) FILTER (label = 'bad') AS n_bad, count(*) FILTER (label = 'good' AND final_score >= 0.5) AS good_above, count(*) FILTER (label = 'bad' AND final_score < 0.5) AS bad_below FROM rated GROUP BY 1),
swept AS (SELECT weight_id, n_good, n_bad, round(good_above / n_good, 4) AS "precision", round(bad_below / n_bad, 4) AS reject_rate, round(good_above / n_good * 0.6 + bad_below / n_bad * 0.4, 4) AS overall FROM counted),
runs AS (SELECT *, max(overall) OVER (ORDER BY weight_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM swept)
"""


def swept(read) -> DataFrame:
    rows = labelled(read).withColumn("final_score", F.lit(None).cast("double"))
    return ranking.sweep(rows, ranking.weight_grid(rows.sparkSession))


@query(SWEEP + "SELECT weight_id, n_good, n_bad, \"precision\", reject_rate, overall FROM swept")
def weight_sweep(read):
    return swept(read)


@query(SWEEP + "SELECT max(overall) AS overall, arg_max(weight_id, overall * 1000000 - weight_id / 1000000.0) AS weight_id FROM swept")
def weight_best(read):
    return swept(read).agg(F.max("overall").alias("overall"), F.max_by("weight_id", F.struct("overall", -F.col("weight_id"))).alias("weight_id"))


@query(SWEEP + "SELECT weight_id AS seq, overall AS \"yield\", CASE WHEN before IS NULL OR overall > before THEN 'IMPROVED' ELSE 'SAME' END AS status FROM runs")
def experiment_progress(read):
    return ranking.progress(swept(read).select(F.col("weight_id").alias("seq"), F.col("overall").alias("yield")))


@query(SWEEP + "SELECT count(*) AS n, count(*) FILTER (before IS NOT NULL AND overall <= before) = 5 AS saturated FROM (SELECT * FROM runs ORDER BY weight_id DESC LIMIT 5)")
def sweep_saturated(read):
    return ranking.is_saturated(ranking.progress(swept(read).select(F.col("weight_id").alias("seq"), F.col("overall").alias("yield"))))


# --- events as runs, checks and answers --------------------------------------------------------------------------

RUNS = """WITH rows AS (SELECT user_id AS source_id, CAST(ts AS DATE) AS run, event_type <> 'error' AS admitted, value > 50 AS is_new, event_type = 'view' AS is_gated FROM events),
runs AS (SELECT source_id, run, count(*) AS total, count(*) FILTER (is_new) AS new, count(*) FILTER (is_gated) AS gated, count(*) FILTER (NOT admitted) AS mismatch FROM rows GROUP BY 1, 2),
ratios AS (SELECT *, round(gated / greatest(total, 1), 2) AS gated_ratio, round(1 - gated / greatest(total, 1), 2) AS valid_ratio FROM runs),
streaks AS (SELECT *, sum((new = 0)::INT) OVER (PARTITION BY source_id, block ORDER BY run)::BIGINT AS zero_streak FROM (SELECT *, sum((new > 0)::INT) OVER (PARTITION BY source_id ORDER BY run) AS block FROM ratios))
"""


def runs(read) -> DataFrame:
    e = read("events")
    rows = e.select(F.col("user_id").alias("source_id"), F.to_date("ts").alias("run"), (F.col("event_type") != "error").alias("admitted"), (F.col("value") > 50).alias("is_new"), (F.col("event_type") == "view").alias("is_gated"))
    return health.run_metrics(rows, ["source_id", "run"])


@query(RUNS + "SELECT source_id, run, total, new, gated, mismatch, gated_ratio, valid_ratio FROM ratios")
def run_metrics(read):
    return runs(read)


@query(RUNS + "SELECT source_id, run, new, zero_streak FROM streaks")
def zero_streak(read):
    rows = health.zero_streaks(runs(read).select("source_id", "run", F.col("new").alias("total")))
    return rows.select("source_id", "run", F.col("total").alias("new"), "zero_streak")


@query(RUNS + """SELECT source_id, run, zero_streak, concat_ws(',', CASE WHEN zero_streak >= 2 THEN 'zero_streak' END, CASE WHEN gated_ratio > 0.5 THEN 'gated' END, CASE WHEN valid_ratio < 0.3 THEN 'invalid_bodies' END, CASE WHEN mismatch > 3 THEN 'mismatch' END) AS alerts
FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY run DESC) AS rn FROM streaks) WHERE rn = 1""")
def anomaly_alerts(read):
    rows = runs(read).select("source_id", "run", F.col("new").alias("total"), "mismatch", "gated_ratio", "valid_ratio")
    return health.inspection_state(rows).select("source_id", "run", "zero_streak", "alerts")


# Means are exact (sums of hundredths), then of three digits, halves up: sums of doubles depend on the order of rows.
TRIALS = """WITH checks AS (SELECT trial_id, date, accessible, article_count FROM (SELECT user_id AS trial_id, CAST(ts AS DATE) AS date, event_type <> 'error' AS accessible, CAST(floor(value) AS BIGINT) % 5 AS article_count,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1),
samples AS (SELECT user_id AS trial_id, CAST(json_extract(props, '$.k') AS BIGINT) % 100 AS hundredths FROM events WHERE value > 30),
a AS (SELECT trial_id, coalesce(sum(article_count) FILTER (accessible), 0)::BIGINT AS articles, count(*) FILTER (accessible AND article_count > 0) AS days FROM checks GROUP BY 1),
b AS (SELECT trial_id, sum(hundredths)::BIGINT AS total, count(hundredths) AS n_samples FROM samples GROUP BY 1),
rolled AS (SELECT trial_id, articles, days, coalesce(CASE WHEN n_samples > 0 THEN (20 * total + n_samples) // (2 * n_samples) END, 0) / 1000.0::DOUBLE AS mean, coalesce(n_samples, 0) AS n_samples, CASE WHEN days < 2 THEN 'fail_quantity' WHEN coalesce(n_samples, 0) = 0 OR 2 * total < 100 * n_samples THEN 'fail_quality' ELSE 'pass' END AS outcome FROM a LEFT JOIN b USING (trial_id))
"""


def trials(read) -> DataFrame:
    e = read("events")
    checks = e.select(F.col("user_id").alias("trial_id"), F.to_date("ts").alias("date"), (F.col("event_type") != "error").alias("accessible"), (F.floor("value") % 5).alias("article_count"), "ts", "event_id")
    samples = e.where("value > 30").select(F.col("user_id").alias("trial_id"), (F.get_json_object("props", "$.k").cast("long") % 100 / F.lit(100.0)).alias("overall"))
    return funnel.trial_rollup(funnel.first_of_day(checks, ["trial_id", "date"], ["ts", "event_id"]), samples)


@query(TRIALS + "SELECT trial_id, articles, days, mean, n_samples, outcome FROM rolled")
def trial_outcomes(read):
    return trials(read).select("trial_id", "articles", "days", "mean", "n_samples", "outcome")


@query(TRIALS + "SELECT outcome, count(*) AS n, sum(articles)::BIGINT AS articles FROM rolled GROUP BY 1")
def trial_summary(read):
    return trials(read).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("articles").alias("articles"))


# --- customers as candidates, orders as history ------------------------------------------------------------------

CANDIDATES = """WITH candidates AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'validated' WHEN 'MACHINERY' THEN 'inaccessible' WHEN 'AUTOMOBILE' THEN 'watchlist' WHEN 'HOUSEHOLD' THEN 'rejected' ELSE 'seed' END AS status,
  CASE WHEN c_nationkey < 8 THEN 'HIGH' WHEN c_nationkey < 16 THEN 'MEDIUM' ELSE 'LOW' END AS quality, CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE (c_custkey % 10) / 10.0 END::DOUBLE AS quality_score, (c_custkey % 7) / 7.0::DOUBLE AS fit_score FROM customer),
history AS (SELECT o_custkey AS id, o_orderkey AS seq, o_orderpriority AS priority, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail_quality' ELSE 'skipped' END AS outcome FROM orders),
production AS (SELECT DISTINCT n_nationkey AS id FROM nation),
recent AS (SELECT DISTINCT id FROM history WHERE priority = '1-URGENT')
"""
PRIORITY = "coalesce(nullif(quality_score, 0.0), CASE quality WHEN 'HIGH' THEN 1.0 WHEN 'MEDIUM' THEN 0.5 ELSE 0.0 END) * 0.6::DOUBLE + fit_score * 0.4::DOUBLE"


def candidates(read) -> DataFrame:
    seg, nation, key = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_custkey")
    status = F.when(seg == "BUILDING", "validated").when(seg == "MACHINERY", "inaccessible").when(seg == "AUTOMOBILE", "watchlist").when(seg == "HOUSEHOLD", "rejected").otherwise("seed")
    quality = F.when(nation < 8, "HIGH").when(nation < 16, "MEDIUM").otherwise("LOW")
    return read("customer").select(key.alias("id"), status.alias("status"), quality.alias("quality"), F.when(key % 4 == 0, 0.0).otherwise(key % 10 / F.lit(10.0)).alias("quality_score"), (key % 7 / F.lit(7.0)).alias("fit_score"))


def history(read) -> DataFrame:
    s = F.col("o_orderstatus")
    return read("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("priority"), F.when(s == "F", "pass").when(s == "O", "fail_quality").otherwise("skipped").alias("outcome"))


def production(read) -> DataFrame:
    return read("nation").select(F.col("n_nationkey").cast("long").alias("id"))


@query(CANDIDATES + "SELECT status, count(*) AS n FROM candidates GROUP BY 1")
def funnel_counts(read):
    return funnel.funnel_counts(candidates(read))


QUEUE = f"queue AS (SELECT id, {PRIORITY} AS priority FROM candidates WHERE status = 'validated' AND quality IN ('HIGH', 'MEDIUM') AND id NOT IN (SELECT id FROM recent) AND id NOT IN (SELECT id FROM production))"


def queue(read) -> DataFrame:
    return funnel.trial_queue(candidates(read), history(read).where("priority = '1-URGENT'"), production(read))


@query(CANDIDATES + f", {QUEUE} SELECT id, round(priority, 6) AS priority FROM queue")
def trial_queue(read):
    return queue(read).select("id", F.round("priority", 6).alias("priority"))


@query(CANDIDATES + f", {QUEUE} SELECT id, row_number() OVER (ORDER BY priority DESC, id) AS slot FROM queue QUALIFY slot <= 3 - (SELECT count(*) FROM region WHERE r_name = 'ASIA')")
def trial_slots(read):
    active = read("region").where("r_name = 'ASIA'")
    return funnel.fill_slots(queue(read), active).select("id", "slot")


@query(CANDIDATES + """, last AS (SELECT id, arg_max(outcome, seq) AS outcome, max(seq) AS seq FROM history GROUP BY id)
SELECT c.id, c.status, l.seq FROM candidates c JOIN last l USING (id) WHERE l.outcome = 'pass' AND c.id NOT IN (SELECT id FROM production)""")
def pass_pending(read):
    return funnel.pass_pending(history(read).drop("priority"), candidates(read).select("id", "status"), production(read)).select("id", "status", "seq")


@query(CANDIDATES + """, tried AS (SELECT o_custkey AS id, max(o_orderdate) AS tried_at FROM orders GROUP BY 1)
SELECT id, quality FROM candidates LEFT JOIN tried USING (id) WHERE status = 'inaccessible' AND quality <> 'LOW' AND coalesce(tried_at, TIMESTAMP '1970-01-01') <= TIMESTAMP '1998-01-01' - INTERVAL 1 DAY AND id NOT IN (SELECT id FROM production)""")
def retry_targets(read):
    tried = read("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderdate").cast("string").alias("attempted_at"))
    return funnel.retry_targets(candidates(read).join(tried, "id", "left"), production(read), F.lit("1998-01-01").cast("timestamp")).select("id", "quality")


@query(CANDIDATES + """, done AS (SELECT o_custkey AS id, CAST(max(o_orderdate) AS DATE) AS analysed FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
SELECT id, status, analysed FROM candidates LEFT JOIN done USING (id) WHERE analysed IS NULL OR DATE '1998-08-02' - analysed > CASE WHEN status IN ('rejected', 'watchlist') THEN 30 ELSE 7 END ORDER BY analysed NULLS FIRST, id LIMIT 4""")
def recheck_due(read):
    done = read("orders").where("o_orderpriority <> '1-URGENT'").groupBy(F.col("o_custkey").alias("id")).agg(F.to_date(F.max("o_orderdate")).alias("analysed"))
    return funnel.recheck_due(candidates(read).join(done, "id", "left"), F.lit("1998-08-02").cast("date")).select("id", "status", "analysed")


@query("""WITH a AS (SELECT DISTINCT s_nationkey AS id FROM supplier WHERE s_acctbal > 2000), b AS (SELECT DISTINCT n_nationkey AS id FROM nation WHERE n_regionkey > 0)
SELECT id::BIGINT AS id, CASE WHEN x IS NULL THEN 'orphan' ELSE 'missing' END AS gap FROM (SELECT coalesce(a.id, b.id) AS id, a.id AS x, b.id AS y FROM a FULL JOIN b ON a.id = b.id) WHERE x IS NULL OR y IS NULL""")
def registry_check(read):
    a = read("supplier").where("s_acctbal > 2000").select(F.col("s_nationkey").alias("id"))
    return health.registry_gaps(a, read("nation").where("n_regionkey > 0").select(F.col("n_nationkey").alias("id")), "id")


@query("""WITH u AS (SELECT s_suppkey AS k, s_name AS n, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS b FROM supplier)
SELECT c_custkey, coalesce(n, c_name) AS c_name, coalesce(b, c_acctbal) AS c_acctbal FROM customer LEFT JOIN u ON k = c_custkey""")
def upsert_partial(read):
    changes = read("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("c_acctbal"))
    return ingest.patch(read("customer").select("c_custkey", "c_name", "c_acctbal"), changes, "c_custkey")


@query("""WITH n AS (SELECT s_suppkey AS k, s_nationkey::BIGINT AS v FROM supplier) SELECT c_custkey AS k, c_nationkey::BIGINT AS v FROM customer WHERE c_custkey NOT IN (SELECT k FROM n) UNION ALL SELECT k, v FROM n""")
def upsert_replace(read):
    new = read("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").cast("long").alias("v"))
    return ingest.replace_keys(read("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("v")), new, "k")


@query("""SELECT n_name AS tag, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 5000 GROUP BY 1""")
def tag_coverage(read):
    names = read("nation").select("n_nationkey", F.col("n_name").alias("tag"))
    items = read("customer").where("c_acctbal > 5000").join(F.broadcast(names), F.col("c_nationkey") == F.col("n_nationkey")).select(F.array("tag").alias("tags"))
    return funnel.tag_coverage(names.select("tag"), items)


# --- dates, answers, samples -------------------------------------------------------------------------------------

SPARK_FORMATS = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-MM-dd", "MM/dd/yyyy", "MMMM yyyy", "MMM yyyy"]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (6, 7) THEN date_trunc('month', o_orderdate)::DATE WHEN o_orderkey % 9 = 8 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders")
def parse_dates(read):
    key = F.col("o_orderkey") % 9
    raw = F.lit("not a date")
    for i, f in enumerate(SPARK_FORMATS):
        raw = F.when(key == i, F.date_format("o_orderdate", f)).otherwise(raw)
    return read("orders").select("o_orderkey", dates.parse_date(raw).alias("parsed"))


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, (event_id % 3) AS model FROM events)
SELECT user_id, arg_min(k, model * 1000000000000 + event_id) AS k FROM e WHERE k IS NOT NULL GROUP BY 1""")
def first_answer(read):
    raw = F.when(F.col("event_type") == "click", "no json here").otherwise(F.concat(F.lit("Sure: "), F.col("props"), F.lit(" done")))
    rows = read("events").select("user_id", "event_id", (F.col("event_id") % 3).alias("model"), text.first_object(raw).alias("answer")).where("answer is not null")
    return rows.groupBy("user_id").agg(F.min_by(F.get_json_object("answer", "$.k").cast("long"), F.struct("model", "event_id")).alias("k"))


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN 'AI/Tech,Oil/Energy' WHEN 'fr' THEN 'China/EM' WHEN 'de' THEN 'Real Estate' ELSE '' END AS themes FROM documents""")
def theme_canonical(read):
    lang = F.col("lang")
    raw = F.when(lang == "en", '["AI/Tech", "bogus", {"name": "energy prices"}, "ai"]').when(lang == "fr", '[{"theme": "emerging markets"}, {"other": 1}]').when(lang == "de", '["real estate funds", "Real Estate"]').otherwise("no list")
    return read("documents").select("doc_id", F.array_join(text.canonical_themes(raw), ",").alias("themes"))


@query("""SELECT conv_id, turn, rn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE length(text) > 60 AND role <> 'system') WHERE rn <= 3""")
def sample_first_n(read):
    rows = read("conversations").where((F.length("text") > 60) & (F.col("role") != "system")).select("conv_id", "turn")
    return ingest.top_n(rows, ["conv_id"], [F.col("turn")], 3).select("conv_id", "turn", "rn")


@query("""WITH s AS (SELECT DISTINCT conv_id, text FROM conversations WHERE turn = 0), r AS (SELECT conv_id, turn, length(text) AS n FROM conversations c WHERE turn > 0 AND NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = c.conv_id AND s.text = c.text))
SELECT conv_id, count(*) AS n, round(avg(0.4 * (n % 10 / 10.0) + 0.4 * (turn % 5 / 5.0) + 0.2), 6) AS overall FROM r GROUP BY 1""")
def sample_exclude_seen(read):
    c = read("conversations")
    rest = c.where("turn > 0").join(c.where("turn = 0").select("conv_id", "text").distinct(), ["conv_id", "text"], "left_anti")
    overall = scoring.sample_overall(F.length("text") % 10 / F.lit(10.0), F.col("turn") % 5 / F.lit(5.0), F.lit(1.0))
    return rest.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(overall), 6).alias("overall"))


@query(CANDIDATES + f""", {QUEUE} SELECT section, count(*) AS n, min(id) AS first_id FROM (SELECT 'production' AS section, id::BIGINT AS id FROM production UNION ALL SELECT 'queue', id FROM queue UNION ALL SELECT status, id FROM candidates WHERE status IN ('inaccessible', 'seed', 'rejected')) GROUP BY 1""")
def report_sections(read):
    rows = production(read).select(F.lit("production").alias("section"), "id").unionByName(queue(read).select(F.lit("queue").alias("section"), "id"))
    rows = rows.unionByName(candidates(read).where("status in ('inaccessible', 'seed', 'rejected')").select(F.col("status").alias("section"), "id"))
    return rows.groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
