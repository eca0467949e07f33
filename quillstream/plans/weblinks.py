"""Links of pages: extraction from html, filters, hops, scored lists; bodies and cards.

The tables' pages lead nowhere, so each gets further links: to the page with the next id, into research and other paths,
to a feed. Text, menus and layout of a page stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import html, urls
from quillstream.operators import weblinks
from quillstream.plans.base import query
from quillstream.plans.registry import PHRASES, SCORES, SQL_HOST, SQL_PATH
from quillstream.sources import shared

#: What is put behind a page: (href, label, markup of the label).
MORE = [
    ("/insights/a{id}/", "Insight deep text", "Insight  <b>deep</b>\n text"),
    ("/Research/about", "About", "About"),
    ("/library/../research/x{id}", "", ""),
    ("#top", "Top", "Top"),
    ("JavaScript:void(0)", "Do", "Do"),
    ("/tag/x/y", "Tag", "Tag"),
    ("/a/b?page=2", "B2", "B2"),
    ("/a/b#frag", "B3", "B3"),
    ("/insights/a{id}", "Again", "Again"),
    ("http://other.example/research/z", "Out", "Out"),
]
NEXT_PAGE = "next page"
FEED = '<link rel="alternate" type="application/rss+xml" href="/feed/{id}.xml"><link rel="alternate" type="text/html" href="/no-feed">'


def linked_pages(read) -> DataFrame:
    p = read("pages").select("page_id", "url", "html")
    after = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("_next"))
    key = F.col("page_id").cast("string")
    more = [F.replace(F.lit(f'<a href="{href}">{markup}</a>'), F.lit("{id}"), key) for href, _, markup in MORE]
    to = F.when(F.col("_next").isNotNull(), F.concat(F.lit('<a href="'), "_next", F.lit(f'" aria-label="{NEXT_PAGE}">ignored</a>'))).otherwise("")
    return p.join(after.hint("merge"), "page_id", "left").select("page_id", "url", F.concat(F.replace(F.lit(FEED), F.lit("{id}"), key), "html", to, *more).alias("html"))


def found_links(read) -> DataFrame:
    """(page_id, base, host, pos, href, label) of all links, parsed once and stored."""
    pages = linked_pages(read)
    found = shared.stored(html.links(html.elements(pages, ["a"])), "links")
    base = read("pages").select("page_id", F.col("url").alias("base"), urls.host(F.col("url")).alias("host"))
    return found.join(base.hint("merge"), "page_id")


PATTERN = r"""<a href="([^"]*)">([^<]*)</a>"""
EVERY = f"""WITH p AS (SELECT page_id, url, html, {SQL_HOST} AS host, regexp_extract(url, '{urls.ORIGIN}', 1) AS origin FROM pages),
every AS (SELECT page_id, url AS base, host, origin, generate_subscripts(h, 1) AS pos, unnest(h) AS href, unnest(t) AS label FROM (SELECT *, regexp_extract_all(html, '{PATTERN}', 1) AS h, regexp_extract_all(html, '{PATTERN}', 2) AS t FROM p)
UNION ALL SELECT a.page_id, a.url, a.host, a.origin, 1000, b.url, '{NEXT_PAGE}' FROM p a JOIN p b ON b.page_id = a.page_id + 1
{" ".join(f"UNION ALL SELECT page_id, url, host, origin, {1001 + k}, replace('{href}', '{{id}}', page_id::VARCHAR), '{label}' FROM p" for k, (href, label, _) in enumerate(MORE))}),
urls AS (SELECT *, replace(CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href ELSE origin || href END, '/library/../', '/') AS url FROM every WHERE NOT starts_with(href, '#') AND NOT starts_with(lower(href), 'javascript:') AND href <> ''),
known AS (SELECT *, lower(regexp_extract(url, '{urls.HOST}', 1)) AS link_host, list_filter(string_split(lower(regexp_extract(url, '{urls.PATH}', 1)), '/'), lambda x: x <> '') AS seg, rtrim(url, '/') AS key FROM urls),
nav AS (SELECT page_id, base, host, arg_min(url, pos) AS url, arg_min(label, pos) AS label, min(pos) AS pos FROM known WHERE link_host = host OR link_host = 'www.' || host OR ends_with(link_host, '.' || host) GROUP BY page_id, base, host, key)
"""


@query(EVERY + "SELECT page_id, href, label FROM every")
def page_links_dom(read):
    return found_links(read).select("page_id", "href", "label")


@query(EVERY + "SELECT page_id, url, label FROM nav")
def nav_links(read):
    return weblinks.nav_links(found_links(read), F.array("host")).select("page_id", "url", "label")


WORDS = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(EVERY + f"""SELECT page_id, url, label, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM (SELECT page_id, arg_min(url, pos) AS url, arg_min(label, pos) AS label, min(pos) AS pos FROM known
WHERE (link_host = host OR ends_with(link_host, '.' || host)) AND list_has_any(seg, {WORDS(weblinks.RESEARCH_SEGMENTS)}) AND NOT list_has_any(seg, {WORDS(weblinks.OTHER_SEGMENTS)}) GROUP BY page_id, key) QUALIFY rn <= 20""")
def research_page_links(read):
    return weblinks.research_links(found_links(read), F.array("host")).select("page_id", "url", "label", "rn")


@query(EVERY + f"""SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM (SELECT page_id, regexp_extract(url, '{urls.ORIGIN}', 1) || path AS link, min(pos) AS pos FROM (
SELECT *, regexp_extract(url, '{urls.PATH}', 1) AS path FROM known) WHERE regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) = regexp_extract(base, '^[a-z]+://([^/?#]*)', 1) AND path NOT IN ('', '/') AND path <> regexp_extract(base, '{urls.PATH}', 1)
AND NOT ({' OR '.join(f"contains(lower(path), '{x}')" for x in weblinks.NO_ARTICLE)}) AND len(seg) >= 2 GROUP BY 1, 2) QUALIFY rn <= 3""")
def article_links(read):
    return weblinks.article_links(found_links(read)).select("page_id", "link", "rn")


@query("WITH p AS (SELECT page_id, regexp_extract(url, '" + urls.ORIGIN + "', 1) AS origin FROM pages) SELECT page_id, origin || '/feed/' || page_id || '.xml' AS feed FROM p")
def feed_discovery(read):
    base = read("pages").select("page_id", F.col("url").alias("base"))
    found = shared.stored(html.feeds(html.elements(linked_pages(read), ["link"])), "feeds")
    return found.join(base.hint("merge"), "page_id").select("page_id", urls.resolve(F.col("base"), F.col("href")).alias("feed"))


ROOTS = "roots AS (SELECT host, min(page_id) AS main, max(page_id) AS home FROM p GROUP BY host), firsts AS (SELECT * FROM nav QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 20)"
TARGETS = "targets AS (SELECT rtrim(url, '/') AS key, min(page_id) AS target FROM pages GROUP BY 1)"


def roots_of(read) -> DataFrame:
    return read("pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.min("page_id").alias("main"), F.max("page_id").alias("home"))


@query(EVERY.replace("WHERE link_host = host OR", "WHERE true OR") + ", firsts AS (SELECT * FROM nav QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 20), " + TARGETS + " SELECT f.page_id, target FROM firsts f JOIN targets t ON t.key = rtrim(f.url, '/')")
def two_hop(read):
    nav = weblinks.nav_links(found_links(read), F.array(F.lit("com"), F.lit("net"), F.lit("org"), F.lit("example"), F.lit("other.example")))
    first = nav.withColumn("rn", F.row_number().over(weblinks.Window.partitionBy("page_id").orderBy("pos"))).where("rn <= 20")
    return weblinks.followed(first, read("pages")).select("page_id", "target")


@query(EVERY + ", " + ROOTS + """, done AS (SELECT DISTINCT r.host, rtrim(f.url, '/') AS key FROM roots r JOIN firsts f ON f.page_id = r.main)
SELECT f.host, f.url FROM roots r JOIN firsts f ON f.page_id = r.home WHERE (f.host, rtrim(f.url, '/')) NOT IN (SELECT (host, key) FROM done)""")
def unscored_links(read):
    nav = shared.stored(weblinks.nav_links(found_links(read), F.array("host")), "nav")
    first = nav.withColumn("rn", F.row_number().over(weblinks.Window.partitionBy("page_id").orderBy("pos"))).where("rn <= 20")
    roots = roots_of(read)
    of = lambda name: first.join(roots.select(F.col(name).alias("page_id"), "host"), "page_id")
    return weblinks.unscored(of("home"), of("main"), "host").select("host", "url")


@query(EVERY.replace("WHERE link_host = host OR", "WHERE true OR") + ", " + ROOTS + ", " + TARGETS + """, main AS (SELECT r.host, p.url FROM roots r JOIN p ON p.page_id = r.main),
inner_links AS (SELECT m.host, f.url FROM roots r JOIN main m USING (host) JOIN firsts f ON f.page_id = r.main JOIN targets t ON t.key = rtrim(f.url, '/') WHERE rtrim(f.url, '/') <> rtrim(m.url, '/')),
scored AS (SELECT host, url, 'main' AS origin FROM main UNION ALL SELECT host, url, 'link' FROM inner_links)
SELECT * FROM scored UNION ALL SELECT r.host, f.url, 'home' FROM roots r JOIN firsts f ON f.page_id = r.home JOIN targets t ON t.key = rtrim(f.url, '/') WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.host = r.host AND rtrim(s.url, '/') = rtrim(f.url, '/'))""")
def candidate_pages(read):
    anywhere = F.array(F.lit("com"), F.lit("net"), F.lit("org"), F.lit("example"))
    nav = shared.stored(weblinks.nav_links(found_links(read), anywhere), "nav")
    roots, pages = roots_of(read), read("pages").select("page_id", "url")
    of = lambda name: nav.join(roots.select(F.col(name).alias("page_id"), "host"), "page_id")
    main = pages.join(roots.select(F.col("main").alias("page_id"), "host"), "page_id").select("host", "url")
    return weblinks.candidate_pages(main, of("main"), of("home"), pages, "host").select("host", "url", "origin")


@query(SCORES.rstrip() + ", " + EVERY.removeprefix("WITH p AS").join(["p AS", ""]).replace("WHERE link_host = host OR", "WHERE true OR").rstrip() + f""", fetched AS (SELECT url, min(structure_score) AS s, min(gate_penalty) AS g FROM scored GROUP BY url),
rated AS (SELECT n.page_id, n.url, n.pos, coalesce(s, 0.0::DOUBLE) AS s, coalesce(g, 0.0::DOUBLE) AS g, len(list_intersect(tok, {WORDS(urls.RESEARCH_WORDS)})) AS good, len(list_intersect(tok, {WORDS(urls.OTHER_WORDS)})) AS bad FROM (SELECT *, list_distinct(regexp_split_to_array(lower({SQL_PATH}), '[/_-]')) AS tok FROM nav) n LEFT JOIN fetched f ON f.url = n.url),
finals AS (SELECT page_id, url, pos, s AS structure_score, round(g, 4) AS gate_penalty, round(0.8::DOUBLE * 0.2::DOUBLE + CASE WHEN good + bad = 0 THEN 0.5::DOUBLE ELSE good / (good + bad) END * 0.3::DOUBLE + s * 0.3::DOUBLE + (1 - g) * 0.2::DOUBLE + CASE WHEN pos = 1000 THEN 0.1::DOUBLE WHEN pos = 1002 THEN -0.1::DOUBLE ELSE 0 END, 4) AS final_score FROM rated)
SELECT page_id, url, round(structure_score, 4) AS structure_score, gate_penalty, final_score, row_number() OVER (PARTITION BY page_id ORDER BY final_score DESC, pos) AS rank FROM finals QUALIFY rank <= 3""")
def scored_link_lists(read):
    anywhere = F.array(F.lit("com"), F.lit("net"), F.lit("org"), F.lit("example"))
    nav = weblinks.nav_links(found_links(read), anywhere)
    sure = F.when(F.col("label") == NEXT_PAGE, 0.9).when(F.col("url").endswith("/Research/about"), 0.8)
    nav = nav.withColumns({"is_index": F.col("label") == NEXT_PAGE, "confidence": sure})
    rows = weblinks.scored_links(nav, read("pages").select("url", "html"), anywhere, PHRASES)
    return weblinks.ranked(rows, "page_id").where("rank <= 3").select("page_id", "url", "structure_score", "gate_penalty", "final_score", "rank")


@query(f"""SELECT page_id, host, count(*) AS n FROM (SELECT page_id, {SQL_HOST} AS host, unnest(regexp_extract_all(html, '{PATTERN}', 1)) AS href FROM pages) GROUP BY 1, 2""")
def links_lateral(read):
    pages = read("pages").select("page_id", urls.host(F.col("url")).alias("host"), "html")
    spark = pages.sparkSession
    html.register(spark)
    return spark.sql("SELECT page_id, host, count(*) AS n FROM {pages}, LATERAL html_links(html) GROUP BY page_id, host", pages=pages)
