"""Queries over stored page snapshots: scans with filters, screening, trial checks and health of what was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.functions import scoring, urls
from quillstream.operators import pages
from quillstream.plans.base import query
from quillstream.plans.registry import SQL_HOST
from quillstream.sources import shared, snapshots

#: What stands behind a page's own content, by page_id: items of an index, further navigation, words and fields of a login.
ITEM = "<h2>Item</h2><h3>Part</h3><article>a</article><time>then</time><p>Jan 5, 2024</p>"
ASIDE = '<div class="top nav"><h2>N</h2><h3>N</h3><time>y</time><p>2024-03-04</p></div><header><time>z</time>6 May 2024</header>'
WALL = "<p>Please <b>log in</b> or sign up</p>"
PASSWORD = '<input name="p" type="password">'


def _key() -> Column:
    return F.col("page_id")


def stored_snapshots(read, **filters) -> DataFrame:
    """pages as they were fetched: some not found, some not at all; under urls that end in their page_id."""
    k = _key()
    extra = F.concat(F.repeat(F.lit(ITEM), (k % 6).cast("int")), F.when(k % 4 == 1, ASIDE).otherwise(""), F.when(k % 5 == 2, WALL).otherwise(""), F.when(k % 9 == 4, PASSWORD).otherwise(""))
    status = F.when(k % 11 == 0, None).when(k % 7 == 0, 404).otherwise(200)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + k * 61)
    rows = read("pages").select(F.concat(F.lit("https://"), urls.host(F.col("url")), F.lit("/p/"), k.cast("string")).alias("url"), status.alias("status"), at.alias("fetched_at"), F.when(k % 11 > 0, F.concat("html", extra)).alias("html"))
    folder = shared.scratch(rows.sparkSession, "page-snapshots")
    snapshots.write_pages(rows, folder)
    return snapshots.read_pages(rows.sparkSession, folder, **filters).withColumn("page_id", F.regexp_extract("url", r"/p/(\d+)$", 1).cast("long"))


SNAPSHOTS = f"""WITH s AS (SELECT page_id, {SQL_HOST} AS host, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS status, html, page_id % 6 AS k, page_id % 4 = 1 AS aside, page_id % 5 = 2 AS wall, page_id % 9 = 4 AS pw FROM pages),
t AS (SELECT *, regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs') AS plain FROM s),
n AS (SELECT *, regexp_replace(plain, '<(nav|footer|header)>.*?</(nav|footer|header)>', '', 'gs') AS main FROM t),
own AS (SELECT page_id, host, status, k, aside, wall, pw, CASE WHEN status = 200 THEN len(regexp_extract_all(plain, '<article[\\s>]')) + k ELSE 0 END AS articles, CASE WHEN status = 200 THEN len(regexp_extract_all(plain, '<time[\\s>]')) + k + 2 * aside::INT ELSE 0 END AS times,
  CASE WHEN status = 200 THEN len(regexp_extract_all(plain, '<h2[\\s>]')) + k + aside::INT ELSE 0 END AS h2, CASE WHEN status = 200 THEN k + 2 * aside::INT ELSE 0 END AS dates,
  CASE WHEN status = 200 THEN len(regexp_extract_all(main, '<time[\\s>]')) + k ELSE 0 END AS check_times, CASE WHEN status = 200 THEN len(regexp_extract_all(main, '<h[23][\\s>]')) + 2 * k ELSE 0 END AS check_headings, CASE WHEN status = 200 THEN k ELSE 0 END AS check_dates FROM n)
"""


@query(SNAPSHOTS + "SELECT page_id, host, status::BIGINT AS status, CASE WHEN page_id % 11 > 0 THEN md5(s.html || repeat('" + ITEM + "', k::BIGINT) || CASE WHEN aside THEN '" + ASIDE + "' ELSE '' END || CASE WHEN wall THEN '" + WALL + "' ELSE '' END || CASE WHEN pw THEN '" + PASSWORD + "' ELSE '' END) END AS md5, epoch_us(to_timestamp(1700000000 + page_id * 61)) AS fetched FROM s")
def scan_snapshots(read):
    rows = stored_snapshots(read)
    return rows.select("page_id", "host", "status", F.md5(F.col("html").cast("binary")).alias("md5"), F.unix_micros("fetched_at").alias("fetched"))


@query(SNAPSHOTS + "SELECT page_id, status::BIGINT AS status FROM s WHERE host = (SELECT min(host) FROM s) AND status IN (200, 404)")
def snapshots_of_host(read):
    host = read("pages").agg(F.min(urls.host(F.col("url")))).first()[0]
    return stored_snapshots(read, host=[host], status=[200, 404]).select("page_id", "status")


@query(SNAPSHOTS + "SELECT page_id, articles, times, dates, h2, check_times, check_headings, check_dates, (status = 200 AND pw) IS TRUE AS has_password, CASE WHEN status = 200 AND wall THEN 2 ELSE 0 END::BIGINT AS login_phrases FROM own")
def page_signals(read):
    return pages.with_signals(stored_snapshots(read)).select("page_id", "articles", "times", "dates", "h2", "check_times", "check_headings", "check_dates", "has_password", "login_phrases")


@query(SNAPSHOTS + """SELECT page_id, reason, reason = 'index' AS passed FROM (SELECT page_id, CASE WHEN status IS DISTINCT FROM 200 THEN 'not accessible' WHEN pw OR wall THEN 'login wall'
WHEN (articles >= 2)::INT + (times >= 2)::INT + (dates >= 2)::INT >= 2 OR h2 >= 3 THEN 'index' ELSE 'no index' END AS reason FROM own)""")
def screened_pages(read):
    return pages.screen(stored_snapshots(read)).select("page_id", "reason", "passed")


@query(SNAPSHOTS + """SELECT page_id, status IS NOT DISTINCT FROM 200 AS accessible, greatest(check_times, check_dates, least(check_headings, 20)) AS article_count, check_dates AS date_count,
CASE WHEN status IS NULL THEN 'fetch error' WHEN status <> 200 THEN 'HTTP ' || status END AS error FROM own""")
def trial_checks(read):
    return pages.daily_checks(stored_snapshots(read))


@query(SNAPSHOTS + "SELECT host, count(*) FILTER (status IS NULL) AS failed, count(*) FILTER (status <> 200) AS not_found, count(*) FILTER (status = 200) AS answered FROM s GROUP BY 1")
def snapshot_health(read):
    """Entrypoints of each host by what their last fetch gave."""
    status = scoring.health(F.when(F.col("status").isNotNull(), ""), F.when(F.col("status") == 200, 1.0).otherwise(0.0))
    rows = stored_snapshots(read).select("host", status.alias("health"))
    return rows.groupBy("host").agg(F.count_if(F.col("health") == "error").alias("failed"), F.count_if(F.col("health") == "degraded").alias("not_found"), F.count_if(F.col("health") == "ok").alias("answered"))
