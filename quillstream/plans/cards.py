"""Listing cards and bodies. Each page of the table becomes a listing of one source, in that source's layout, with its
page_id in titles, links and dates; and an article whose body stands in another kind of container."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.functions import scoring
from quillstream.operators import bodies, listing, status
from quillstream.plans.base import query
from quillstream.plans.registry import SQL_HOST
from quillstream.sources import shared

#: (source, what a card looks like, start of its links, rest of them, format of its dates)
PAGES = [
    ("cambridge", '<article class="c-list-article x"><h3><a class="c-link" href="{h}">{t}</a></h3><p class="c-type--body-sm">{d}</p></article>', "https://www.cambridgeassociates.com", "/i/{n}", "MMMM yyyy"),
    ("man", '<div class="teaser__wrap"><a class="teaser" href="{h}"><div class="teaser__content"><h2 class="teaser__title"><strong>Series</strong><br>{t}</h2></div><span class="details__date">{d}</span></a></div>', "", "/i/{n}", "MMMM d, yyyy"),
    ("bridgewater", '<div><div class="PromoC-date">{d}</div><div><a class="Link" href="{h}" aria-label="{t}">x</a></div></div>', "", "/research-and-insights/{n}", "MMM d, yyyy"),
    ("aqr", '<div class="search-list-v2__item"><h2><a href="{h}">{t}</a></h2><p class="article__date">{d}</p></div>', "https://www.aqr.com", "/i/{n}", "MMMM d, yyyy"),
    ("oaktree", '<div class="insight-item"><a href="#" data-link="{h}"><span class="title-link">{t}</span><time class="date" datetime="{iso}T10:00:00Z">soon</time></a></div>', "https://www.oaktreecapital.com", "/i/{n}", "yyyy-MM-dd"),
    ("wellington", '<section class="insight article"><a class="insight__title" href="{h}">{t}</a><date datetime="{iso}">{d}</date></section>', "https://www.wellington.com", "/i/{n}", "MMMM d, yyyy"),
    ("troweprice", '<div class="b-grid-item--12-col"><h2 class="beacon-article-tile__title"><a href="{h}">{t}</a></h2><span class="beacon-article-tile__eyebrow">{d} · Macro</span></div>', "https://www.troweprice.com", "/i/{n}", "MMM d, yyyy"),
    ("research-affiliates", '<a href="{h}"><img alt="{t}"><p>{D}</p></a>', "https://www.researchaffiliates.com", "/insights/publications/articles/{n}", "MMM yyyy"),
    ("pimco", '<div class="coveo-list-layout CoveoResult"><a class="CoveoResultLink" href="{h}">{t}</a><div class="result-date">{d}</div></div>', "https://www.pimco.com", "/i/{n}", "M/d/yyyy"),
    ("blackstone", '<article class="bx-article-card"><h4 class="bx-article-title"><a href="{h}">{t}</a></h4><p class="bx-article-post_date">{d}</p></article>', "https://www.blackstone.com", "/i/{n}", "MMMM d, yyyy"),
    ("aberdeen", '<a href="{h}"><h5>{t}</h5><time class="ms-auto">{d}</time></a>', "https://www.aberdeeninvestments.com", "/i/{n}", "MMM d, yyyy"),
    ("kkr", """<div class="article-teaser" data-cmp-data-layer='{"k": {"xdm:linkURL": "{h}"}}'><span class="article-teaser__title">{t}</span><div class="article-teaser__date">{d}</div></div>""", "https://www.kkr.com", "/content/kkr/sites/global/en/{n}", "MMMM d, yyyy"),
    ("msci", '<div data-test="search-result-item"><p>Research | {d}</p><a href="{h}"><h3>{t}</h3></a>trailing words</div>', "https://www.msci.com", "/research-and-insights/{n}", "MMMM d, yyyy"),
    ("schroders", '<a data-tracker-tag="insight-container" href="{h}"><span data-tracker-tag="card-heading">{t}</span><span class="sc-CardFooter__FooterLabel-1">{d}</span></a>', "https://www.schroders.com", "/i/{n}", "MM-dd-yyyy"),
    ("blackrock", '<div class="gls-related-literature"><div class="item"><h2 class="title"><a href="{h}" title="{t}">x</a></h2><div class="attribution">{d}</div></div></div>', "https://www.blackrock.com", "/literature/weekly-investment-commentary-{n}.pdf", "MMM d, yyyy"),
    ("morganstanley", '<div class="insights-index-main-tile"><a class="featured_insights_anchor" href="{h}"></a><div class="featured_insights_title">{t}</div><div class="featured_insights_createdDate">{d}</div></div>', "https://www.morganstanley.com", "/i/{n}", "MMM d, yyyy"),
    ("capital-group", '<div><h3>{t}</h3><a href="{h}">Read more</a></div>', "https://www.capitalgroup.com", "/advisor/insights/articles/{n}.html", "yyyy"),
    ("pgim", """<ul><li class="cmp-list__item" data-cmp-data-layer='{"k": {"publishDate": "{d}", "itemTitle": "{t}", "xdm:linkURL": "{h}"}}'></li></ul>""", "https://www.pgim.com", "/insights/{n}", "MMMM d, yyyy"),
]
KINDS = len(PAGES)
ABSOLUTE = ("cambridge", "pimco")
MONTHLY = ("cambridge", "research-affiliates")
OUTSIDE = "http://other.example"


def _by_kind(values: list, key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % KINDS + 1).cast("int"))


def listing_pages(read) -> DataFrame:
    """(page_id, base, source_id, html): four cards each: two of their own, one with the first one's link, one elsewhere."""
    k = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int"))
    shown = F.lit("")
    for i, kind in enumerate(PAGES):
        shown = F.when(k % KINDS == i, F.date_format(day, kind[4])).otherwise(shown)
    card = _by_kind([p[1] for p in PAGES], k)

    def filled(title: str, n: Column, start: Column) -> Column:
        link = F.concat(start, F.replace(_by_kind([p[3] for p in PAGES], k), F.lit("{n}"), n.cast("string")))
        out = card
        for name, value in (("{h}", link), ("{t}", F.concat(F.lit(title), n.cast("string"))), ("{d}", shown), ("{D}", F.upper(shown)), ("{iso}", F.date_format(day, "yyyy-MM-dd"))):
            out = F.replace(out, F.lit(name), value)
        return out

    start = _by_kind([p[2] if p[0] in ABSOLUTE else "" for p in PAGES], k)
    body = F.concat(filled("Story number ", k * 10, start), filled("Story number ", k * 10 + 1, start), filled("Second to ", k * 10, start), filled("Out of here ", k * 10 + 3, F.lit(OUTSIDE)))
    return read("pages").select("page_id", F.col("url").alias("base"), _by_kind([p[0] for p in PAGES], k).alias("source_id"), F.concat(F.lit("<html><body><nav><a href='/x'>x</a></nav><main>"), body, F.lit("</main></body></html>")).alias("html"))


RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{s}', '{start}', '{rest.replace('/content/kkr/sites/global/en', '')}', {bool(listing.LAYOUTS[s].get('once'))}, {listing.LAYOUTS[s]['host'] != ''}, {s in MONTHLY}, {s == 'capital-group'})" for i, (s, _, start, rest, _) in enumerate(PAGES)
) + ") r(kind, source_id, start, rest, once, gated, monthly, undated))"


@query(f"""WITH {RULES}, base AS (SELECT page_id, r.*, CASE WHEN start = '' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') ELSE start END AS origin, DATE '2024-01-01' + CAST(page_id % 50 AS INT) AS day FROM pages JOIN rules r ON r.kind = page_id % {KINDS}),
every AS (SELECT *, 0 AS pos, 'Story number ' || page_id * 10 AS title, origin || replace(rest, '{{n}}', (page_id * 10)::VARCHAR) AS url FROM base UNION ALL SELECT *, 1, 'Story number ' || (page_id * 10 + 1), origin || replace(rest, '{{n}}', (page_id * 10 + 1)::VARCHAR) FROM base
UNION ALL SELECT *, 2, 'Second to ' || page_id * 10, origin || replace(rest, '{{n}}', (page_id * 10)::VARCHAR) FROM base WHERE NOT once UNION ALL SELECT *, 3, 'Out of here ' || (page_id * 10 + 3), '{OUTSIDE}' || replace(rest, '{{n}}', (page_id * 10 + 3)::VARCHAR) FROM base WHERE NOT gated)
SELECT page_id, source_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn, title, url, CASE WHEN undated THEN NULL WHEN monthly THEN date_trunc('month', day)::DATE ELSE day END AS date FROM every""")
def listing_cards(read):
    pages = listing_pages(read)
    rules = listing.layout_rules(pages.sparkSession)
    found = shared.stored(listing.cards(pages, rules), "cards")
    rows = found.join(pages.select("page_id", "base").hint("merge"), "page_id")
    return listing.listing_rows(rows, rules, F.col("base")).select("page_id", "source_id", "rn", "title", "url", "date")


FEATURED = """<div class="top"><span>Old</span><span>Kind {n}</span><div><a class="insights-featured-article-v2" href="/f/{n}">Featured {n}</a></div></div><p class="article-date">March 4, 2024</p><p class="text--small-v2">Short {n}</p>"""
ADDED = {"base": "page", "host": "", "card": "li.entry", "title": "b", "link": "a@href", "date": "i", "category": "^1< h4"}


@query("""SELECT page_id, 'aqr' AS source_id, 'Featured ' || page_id AS title, 'https://www.aqr.com/f/' || page_id AS url, DATE '2024-03-04' AS date, 'Kind ' || page_id AS category, 'Short ' || page_id AS summary FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 'added', 'Entry ' || page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || '/e/' || page_id, DATE '2024-03-05', 'News ' || page_id, '' FROM pages WHERE page_id % 2 = 1""")
def cards_by_added_rules(read):
    """Featured cards with what stands before them, and those of a source that a further row of rules describes."""
    k = F.col("page_id")
    filled = lambda page: F.replace(F.lit(page), F.lit("{n}"), k.cast("string"))
    entry = '<h4>News {n}</h4><ul><li class="entry"><a href="/e/{n}"><b>Entry {n}</b></a><i>March 5, 2024</i></li></ul>'
    pages = read("pages").select("page_id", F.col("url").alias("base"), F.when(k % 2 == 0, "aqr").otherwise("added").alias("source_id"), F.when(k % 2 == 0, filled(FEATURED)).otherwise(filled(entry)).alias("html"))
    rules = status.union_all(listing.layout_rules(pages.sparkSession), listing.layout_rules(pages.sparkSession, {"added": ADDED}))
    found = shared.stored(listing.cards(pages, rules), "cards")
    rows = found.join(pages.select("page_id", "base").hint("merge"), "page_id")
    return listing.listing_rows(rows, rules, F.col("base")).select("page_id", "source_id", "title", "url", "date", "category", "summary")


@query("""WITH p AS (SELECT page_id, ['gmo', 'gsam', 'jpmam'][page_id % 3 + 1] AS source_id, DATE '2024-01-01' + CAST(page_id % 50 AS INT) AS date FROM pages)
SELECT page_id, source_id, 'T' || page_id AS title, CASE source_id WHEN 'gmo' THEN 'https://www.gmo.com/r/' WHEN 'gsam' THEN 'https://am.gs.com/r/' ELSE 'https://am.jpmorgan.com/r/' END || page_id AS url, date, CASE WHEN source_id = 'gmo' THEN 'A. Writer' ELSE '' END AS author, source_id = 'gmo' AND page_id % 2 = 0 AS gated FROM p""")
def listing_json(read):
    k = F.col("page_id")
    key, day = k.cast("string"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int"))
    made = lambda template: F.replace(F.replace(F.replace(F.replace(F.lit(template), F.lit("{n}"), key), F.lit("{iso}"), F.date_format(day, "yyyy-MM-dd")), F.lit("{us}"), F.date_format(day, "MM-dd-yyyy")), F.lit("{long}"), F.date_format(day, "MMMM d, yyyy"))
    gmo = F.concat(made('{"listing": [{"Title": " T{n} ", "URL": "/r/{n}", "Date": "soon", "dateData": "{us}", "Author": "By A. Writer", "Lock": '), F.when(k % 2 == 0, "true").otherwise("false"), F.lit('}, {"Title": "", "URL": "/x"}]}'))
    gsam = made('{"insights": {"hits": [{"title": "", "summaryTitle": "T{n}", "slug": "/r/{n}", "publishDate": "{iso}T23:00:00Z"}, {"title": "Off", "pagePath": "http://other.example/a"}, {"title": "No path"}]}}')
    jpmam = made('{"pages": [{"title": "T{n}", "url": "/r/{n}", "displayDate": "{long}"}]}')
    raw = F.when(k % 3 == 0, gmo).when(k % 3 == 1, gsam).otherwise(jpmam)
    payloads = read("pages").select("page_id", F.element_at(F.array(*map(F.lit, listing.JSON_LISTINGS)), (k % 3 + 1).cast("int")).alias("source_id"), raw.alias("raw"))
    return listing.json_rows(payloads).select("page_id", "source_id", "title", "url", "date", "author", "gated")


# --- bodies -------------------------------------------------------------------------------------------------------

#: Containers by page_id: the source that reads it, and what stands before and behind a page's body.
BODY_PAGES = [
    ("man", '<div class="field--body"><p>', "</p></div>"),
    ("aqr", '<section class="research-detail"><p>', "</p></section>"),
    ("ark", "<article><p>", "</p></article>"),
    ("cambridge", "<main><p>", "</p></main>"),
    ("wellington", '<div itemprop="articleBody"><p>', "</p></div>"),
    ("amundi", '<div class="content-body"><p>', "</p></div>"),
    ("troweprice", '<div class="beacon-article-body"><p>', "</p></div>"),
    ("man", '<div class="content">', "</div>"),
    ("aqr", "<div>", "</div>"),
]
WORDS = "trim(regexp_replace(regexp_replace(text, '[<>&]', ' ', 'g'), '\\s+', ' ', 'g'))"


def body_pages(read) -> DataFrame:
    k = F.col("doc_id")
    pick = lambda n: F.element_at(F.array(*[F.lit(b[n]) for b in BODY_PAGES]), (k % len(BODY_PAGES) + 1).cast("int"))
    words = F.trim(F.regexp_replace(F.regexp_replace("text", "[<>&]", " "), r"\s+", " "))
    whole = F.concat(F.lit("<html><body><nav>menu of it</nav>"), pick(1), words, F.when(k % 4 == 3, " Terms of  Use").otherwise(""), pick(2), F.lit("<footer>foot of it</footer></body></html>"))
    return read("documents").select(k.alias("page_id"), pick(0).alias("source_id"), whole.alias("html"))


@query(f"""WITH t AS (SELECT doc_id AS page_id, doc_id % {len(BODY_PAGES)} AS kind, {WORDS} AS w, doc_id % 4 = 3 AS gated FROM documents), u AS (SELECT *, trim(w || CASE WHEN gated THEN ' Terms of  Use' ELSE '' END) AS own FROM t)
SELECT page_id, md5(CASE WHEN length(own) >= 100 THEN own END) AS body, md5(CASE WHEN kind IN (2, 5, 7) AND length(s) >= 100 AND NOT gates THEN s END) AS strict, length(CASE WHEN length(own) > 200 THEN substr(own, 1, 3000) END) AS sample
FROM (SELECT *, regexp_replace(own, '\\s+', ' ', 'g') AS s, {' OR '.join(f"contains(lower(regexp_replace(own, '\\s+', ' ', 'g')), '{m}')" for m in scoring.GATE_MARKERS + scoring.DISCLAIMER_MARKERS)} AS gates FROM u)""")
def article_bodies(read):
    pages = body_pages(read)
    rows = bodies.bodies(pages, bodies.body_rules(pages.sparkSession), 100, scoring.GATE_MARKERS + scoring.DISCLAIMER_MARKERS)
    return rows.select("page_id", F.md5(F.col("body").cast("binary")).alias("body"), F.md5(F.col("strict").cast("binary")).alias("strict"), F.length("sample").alias("sample"))


TAGS = ["article", "p", "li", "a", "time", "h2"]


@query("SELECT page_id, " + ", ".join(f"len(regexp_extract_all(html, '<{t}[\\s>]'))::BIGINT AS n_{t}" for t in TAGS) + ", (page_id % 3 = 0)::BIGINT AS n_password FROM (SELECT page_id, regexp_replace(html, '(?s)<script.*?</script>', '', 'g') AS html FROM pages)")
def element_counts(read):
    from quillstream.functions import html

    pages = read("pages").select("page_id", F.concat("html", F.when(F.col("page_id") % 3 == 0, '<INPUT TYPE="Password">').otherwise("")).alias("html"))
    return html.tag_counts(html.elements(pages, [*TAGS, "input"]), TAGS)


@query(f"""SELECT page_id, {SQL_HOST} AS host, len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?s)<(nav|footer)>.*?</(nav|footer)>', '', 'g'), '<[a-z]'))::BIGINT AS n_elements FROM pages""")
def chrome_removed(read):
    from quillstream.functions import html, urls

    rows = html.without_chrome(html.elements(read("pages"))).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_elements"))
    host = read("pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return shared.stored(rows, "chrome").join(host.hint("merge"), "page_id").select("page_id", "host", "n_elements")


@query(f"""WITH t AS (SELECT doc_id AS page_id, doc_id % {len(BODY_PAGES)} AS kind, doc_id % 13 AS s, lang, source, {WORDS} AS w, doc_id % 4 = 3 AS gated FROM documents), u AS (SELECT *, trim(w || CASE WHEN gated THEN ' Terms of  Use' ELSE '' END) AS own, kind = 2 AS ark, CASE s WHEN 0 THEN 403 WHEN 1 THEN NULL WHEN 2 THEN 500 ELSE 200 END AS status FROM t),
v AS (SELECT *, CASE WHEN status = 200 AND length(own) >= 100 THEN own END AS body, 'Title: T' || page_id || chr(10) || 'Category: ' || lang || CASE WHEN page_id % 2 = 0 THEN chr(10) || 'Summary: about ' || source ELSE '' END AS meta FROM u)
SELECT page_id, CASE WHEN body IS NOT NULL THEN 'ok' WHEN ark AND status IN (200, 403) THEN 'metadata_only' ELSE 'failed' END AS content_status, md5(CASE WHEN body IS NOT NULL THEN body WHEN ark AND status IN (200, 403) THEN meta END) AS content FROM v""")
def article_contents(read):
    """Bodies as they were fetched, or what a feed says where the page is closed or too short, with their status."""
    k = F.col("page_id")
    pages = body_pages(read)
    rules = bodies.body_rules(pages.sparkSession)
    known = read("documents").select(F.col("doc_id").alias("page_id"), F.col("lang").alias("category"), F.concat(F.lit("about "), "source").alias("_about"))
    found = bodies.bodies(pages, rules, kinds=("body",)).select("page_id", "body").join(pages.select("page_id", "source_id").hint("merge"), "page_id").join(known.hint("merge"), "page_id")
    status_code = F.when(k % 13 == 0, 403).when(k % 13 == 1, None).when(k % 13 == 2, 500).otherwise(200)
    rows = found.withColumns({"status": status_code, "title": F.concat(F.lit("T"), k.cast("string")), "summary": F.when(k % 2 == 0, F.col("_about"))})
    return bodies.contents(rows, rules).select("page_id", "content_status", F.md5(F.col("content").cast("binary")).alias("content"))
