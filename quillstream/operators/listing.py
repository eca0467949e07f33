"""Cards of listing pages and bodies of articles by rules that are data: one parse of a page, one row for a card or body.

A rule's field says where in a card a value stands: alternatives by ||, the first that gives something. Each is a
selector, or . for the card; @attr takes an attribute; ^n in front looks inside the n-th ancestor and those before it, ^n<
among the elements before the n-th ancestor, the nearest first, / in the whole page; %c after it takes the c-th of an element's own children; ~ takes loose text, outside p, a and h3.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import dates, dom, text, urls
from quillstream.operators import ingest, status
from quillstream.sources import shared

# The layouts of listing pages. base is where relative links start, host what links must lead to, once
# whether a url counts once; drop is left out of titles, cut splits the date's text, least is a title's length.
LAYOUTS: dict[str, dict] = {
    "cambridge": {"base": "", "host": "cambridgeassociates.com", "card": "article.c-list-article", "title": "h2 a, h3 a", "link": "h2 a, h3 a@href", "date": "p.c-type--body-sm"},
    "man": {"base": "page", "host": "", "card": "div.teaser__wrap", "title": ".teaser__content .teaser__title", "link": "a.teaser@href", "date": "span.details__date", "category": "span.details__category", "summary": "div.teaser__text p", "drop": "strong, br", "least": 5, "skip": ["/insights"]},
    "bridgewater": {"base": "page", "host": "", "card": "a.Link[href*='/research-and-insights/']", "title": ".@aria-label || .", "link": ".@href", "date": "^2 .PromoC-date", "least": 5, "once": True, "skip": ["https://www.bridgewater.com/research-and-insights"], "no": ["research and insights", "read more", "learn more", "research & insights"]},
    "aqr": {"base": "https://www.aqr.com", "host": "", "card": "div.search-list-v2__item", "title": "h2 a", "link": "h2 a@href", "date": "p.article__date", "category": "p.eyebrow", "summary": "p.article__summary", "featured": {"card": "a.insights-featured-article-v2", "title": ".", "link": ".@href", "date": "/ p.article-date", "category": "^1< span", "summary": "/ p.text--small-v2"}},
    "oaktree": {"base": "https://www.oaktreecapital.com", "host": "oaktreecapital.com", "card": "div.insight-item", "title": "span.title-link", "link": "a[href]@href || a[href]@data-link", "iso": "time.date@datetime", "date": "time.date", "category": "span.insights-type", "kind": "span.read-more", "no": ["archived memos", "insights"], "prefer": "Read"},
    "wellington": {"base": "https://www.wellington.com", "host": "wellington.com", "card": "section.insight.article", "title": "a.insight__title", "link": "a.insight__link@href || a.insight__title@href", "iso": "date[datetime]@datetime", "date": "date[datetime]", "category": "div.insight__contentType span"},
    "troweprice": {"base": "https://www.troweprice.com", "host": "troweprice.com", "card": "div.b-grid-item--12-col", "title": "h2.beacon-article-tile__title a", "link": "h2.beacon-article-tile__title a@href", "date": "span.beacon-article-tile__eyebrow", "cut": "·"},
    "research-affiliates": {"base": "https://www.researchaffiliates.com", "host": "researchaffiliates.com", "card": "a[href*='/insights/publications/articles/']", "title": "img[alt]@alt || div.flex.flex-col%2", "link": ".@href", "date": ".", "month": True, "once": True},
    "pimco": {"base": "", "host": "pimco.com", "card": "div.coveo-list-layout.CoveoResult", "title": "a.CoveoResultLink", "link": "a.CoveoResultLink@href", "date": ".result-date"},
    "blackstone": {"base": "https://www.blackstone.com", "host": "blackstone.com", "card": "article.bx-article-card", "title": "h4.bx-article-title a || a", "link": "h4.bx-article-title a@href || a@href", "iso": "time[datetime]@datetime", "date": "time[datetime] || p.bx-article-post_date"},
    "aberdeen": {"base": "https://www.aberdeeninvestments.com", "host": "aberdeeninvestments.com", "card": "time.ms-auto", "up": "a", "title": "h5", "link": ".@href", "date": "time.ms-auto", "once": True},
    "kkr": {"base": "https://www.kkr.com", "host": "kkr.com", "card": ".article-teaser", "title": ".article-teaser__title", "link": "@layer || a[href]@href", "date": ".article-teaser__date time@datetime || .article-teaser__date time || .article-teaser__date", "category": ".article-teaser__category", "prefix": "/content/kkr/sites/global/en/", "once": True},
    "msci": {"base": "https://www.msci.com", "host": "msci.com", "card": "div[data-test='search-result-item']", "title": "h3", "link": "a[href*='/research-and-insights/']@href", "date": "p", "summary": "~", "cut": "|"},
    "schroders": {"base": "https://www.schroders.com", "host": "schroders.com", "card": "a[data-tracker-tag='insight-container']", "title": "span[data-tracker-tag='card-heading']", "link": ".@href", "date": "span[class*='CardFooter__FooterLabel']", "category": "span[class*='ArtemisTagLabel']", "least": 5, "once": True, "first": "MM-dd-yyyy"},
    "blackrock": {"base": "https://www.blackrock.com", "host": "blackrock.com", "card": "div.gls-related-literature div.item", "title": "h2.title a@title || h2.title a", "link": "h2.title a@href", "date": "div.attribution", "summary": "div.description", "least": 5, "once": True, "parts": ["weekly-investment-commentary", "market-commentary-weekly"]},
    "morganstanley": {"base": "https://www.morganstanley.com", "host": "morganstanley.com", "card": "div.insights-index-main-tile", "title": ".featured_insights_title", "link": "a.featured_insights_anchor@href", "date": ".featured_insights_createdDate", "category": ".featured_insights_insightHintText"},
    "capital-group": {"base": "https://www.capitalgroup.com", "host": "capitalgroup.com", "card": "a[href*='/advisor/insights/articles/'], a[href*='/advisor/practicelab/articles/']", "title": ".", "link": ".@href", "heading": "^10 h1, h2, h3, h4, p[class*='gds-base__headline']", "least": 5, "once": True, "end": ".html", "noise": True},
    "pgim": {"base": "https://www.pgim.com", "host": "pgim.com", "card": ".cmp-list__item[data-cmp-data-layer]", "title": "@layer.itemTitle", "link": "@layer.xdm:linkURL", "date": "@layer.publishDate", "once": True, "parts": ["/insights/"], "not": ["/weekly-view/"], "dated": True, "newest": True},
}
# Listings that come as JSON: where the rows are, and which fields hold what.
JSON_LISTINGS = {
    "gmo": {"path": "listing", "base": "https://www.gmo.com", "host": "", "title": ["Title"], "link": ["URL"], "date": "Date", "first": "dateData", "author": "Author", "category": "Type", "summary": "Teaser"},
    "gsam": {"path": "insights.hits", "base": "https://am.gs.com", "host": "am.gs.com", "title": ["title", "summaryTitle"], "link": ["pagePath", "slug"], "date": "publishDate"},
    "jpmam": {"path": "pages", "base": "https://am.jpmorgan.com", "host": "am.jpmorgan.com", "title": ["title"], "link": ["url"], "date": "displayDate"},
}
# Where bodies stand, the selectors tried after them, and what is no body.
BODIES = {
    "man": ".field--body p, .article-body p, .node__content p",
    "aqr": ".article-content p, .article__body p, .research-detail p",
    "ark": "article p, .post-content p, .entry-content p, .wp-block-paragraph",
    "cambridge": "main p, article p",
    "wellington": ".cmp-text p, [itemprop='articleBody'] p, .rich-text p",
    "amundi": ".article__body p, .article-body p, .content-body p, main p, article p",
    "troweprice": ".beacon-article-body p, .article-content p, [itemprop='articleBody'] p, main p",
}
FALLBACKS = ["article", "main", ".content", ".article-body"]
CHROME = "nav, footer, header, script, style, .cookie, .modal, .pagination"
STRICT_CHROME = CHROME + ", .disclaimer, .subscribe, form"
STRICT = ["article", "article p", "main article", "main article p", ".article-body", ".article-body p", ".rich-text", ".rich-text p", ".content-body", ".content-body p", ".body-content", ".body-content p", ".content", ".content p"]
SAMPLE_CHROME = "nav, footer, header, .nav, .footer, .header, script, style, aside, .sidebar"
SAMPLE = [".cmp-text", "[itemprop='articleBody']", ".rich-text", ".article-body", ".article-content", ".entry-content", ".post-content"]

RULES = "source_id string, rule string"  # a layout, as JSON
# What admits a card; the rest of a rule says where things stand in it.
ADMISSION = "base string, host string, prefix string, skip array<string>, parts array<string>, not array<string>, end string, once boolean, noise boolean, least int, no array<string>, cut string, month boolean, first string, dated boolean, prefer string, newest boolean"

CARD = "page_id long, source_id string, pos int, title string, link string, iso string, date_raw string, category string, summary string, kind string, featured boolean"


def _layer(node: dom.Node, key: str) -> str:
    """A field of the first key of a data layer, or any of its links."""
    try:
        fields = [v for v in json.loads(node.attrs.get("data-cmp-data-layer") or "{}").values()]
    except (ValueError, AttributeError):
        return ""
    if key:
        return str(fields[0].get(key) or "") if fields and isinstance(fields[0], dict) else ""
    return next((link for v in fields if isinstance(v, dict) and (link := v.get("xdm:linkURL") or v.get("linkURL"))), "")


def _before(card: dom.Node, ups: int, selector: str) -> dom.Node | None:
    """The nearest sibling before the ups-th ancestor that the selector matches."""
    node: dom.Node | None = card
    for _ in range(ups):
        node = node.parent if node is not None else None
    if node is None or node.parent is None:
        return None
    chains = dom.compiled(selector)
    siblings = [p for p in node.parent.parts if isinstance(p, dom.Node)]
    return next((s for s in reversed(siblings[: siblings.index(node)]) if any(s.matches(c[-1]) for c in chains)), None)


def value_of(card: dom.Node, field: str | None, root: dom.Node, drop: str = "", between: str = "") -> str:
    for one in (field or "").split(" || "):
        if one.startswith("@layer"):
            found = _layer(card, one[7:])
        elif one == "~":
            found = next((s for s, owner in card.strings() if owner.tag not in ("p", "a", "h3")), "")
        else:
            m = re.fullmatch(r"(?:\^(\d+)(<)? |(/) )?(.*?)(?:%(\d+))?(?:@([\w:-]+))?", one)
            ups, before, whole, selector, child, attr = m.groups()
            node = card if selector in (".", "") else None
            if before:
                node, ups = _before(card, int(ups), selector), 0
            scope: dom.Node | None = root if whole else card
            for _ in range(0 if before else int(ups or 0) or 1):
                if node is not None or not selector or scope is None:
                    break
                scope = scope.parent if ups and scope is not None else scope
                node = scope.first(selector) if scope is not None else None
            if node is not None and child:
                own = [p for p in node.parts if isinstance(p, dom.Node)]
                node = own[int(child) - 1] if len(own) >= int(child) else None
            if node is None or not one:
                continue
            if attr:
                found = node.attrs.get(attr) or ""
                found = "" if found == "#" else found
            else:
                if drop:
                    node.remove(drop)
                found = node.text(between)
        if found.strip():
            return found.strip()
    return ""


def cards_of(page: str | None, rule: dict) -> Iterator[tuple]:
    """(title, link, iso, date_raw, category, summary, kind, featured) of each card, in order."""
    root = dom.parse(page)
    for own in ([{**rule, **rule["featured"], "is": True}] if "featured" in rule else []) + [rule]:
        for card in root.select(own["card"]):
            if "up" in own:
                while card is not None and card.tag != own["up"]:
                    card = card.parent
                if card is None:
                    continue
            value = lambda name, card=card, own=own, **k: value_of(card, own.get(name), root, **k)
            title = value("title", between=" " if own.get("noise") else "", drop=own.get("drop", ""))
            heading = value("heading", between=" ") if "heading" in own else ""
            if heading and len(re.sub(r"\s+", " ", re.sub(text.NOISE, "", title)).strip()) < 10:
                title = heading
            yield title, value("link"), value("iso"), value("date", between=" " if own.get("month") else ""), value("category"), value("summary"), value("kind"), own.get("is", False)


def layout_rules(spark: SparkSession, layouts: dict[str, dict] = LAYOUTS) -> DataFrame:
    """RULES: the layouts as rows. A source is added by a row, whatever table that comes from."""
    return spark.createDataFrame([(s, json.dumps(rule)) for s, rule in layouts.items()], RULES)


def by_source(rows: DataFrame, rules: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with the rules of their source: broadcast where these are few, else by a shuffle."""
    return rows.join(shared.by_size(rules), "source_id", how)


@functools.lru_cache(1024)
def _loaded(rule: str) -> dict:
    return json.loads(rule)


def cards(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """CARD rows of pages(page_id, source_id, html) by RULES; a source without a rule has none."""
    names = [x.split()[0] for x in CARD.split(", ")]
    types = [pa.int64(), pa.string(), pa.int32(), *[pa.string()] * 7, pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                rows = []
                for page, source, html, rule in zip(*(c.to_pylist() for c in batch[a : a + 200].columns), strict=True):
                    rows += [(page, source, k, *card) for k, card in enumerate(cards_of(html, _loaded(rule)))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return by_source(pages, rules).select("page_id", "source_id", "html", "rule").mapInArrow(run, CARD)


def listing_rows(cards: DataFrame, rules: DataFrame, base: Column, most: int = 10) -> DataFrame:
    """(page_id, source_id, rn, title, url, date, date_raw, category, summary): the cards that a source's rule admits, at
    most `most` of a page. base: the page's own URL, a column of cards."""
    rows = by_source(cards, rules.select("source_id", F.from_json("rule", ADMISSION).alias("_rule")))

    def of(name: str, default, kind: str) -> Column:
        literal = F.array(*map(F.lit, default)).cast(kind) if isinstance(default, list) else F.lit(default).cast(kind)
        return F.coalesce(F.col("_rule")[name], literal)

    start = F.when(of("base", "", "string") == "page", base).otherwise(of("base", "", "string"))
    prefix = of("prefix", "", "string")
    link = F.when((prefix != "") & F.col("link").startswith(prefix), F.concat(F.lit("/"), F.expr("link").substr(F.length(prefix) + 1, F.length("link")))).otherwise(F.col("link"))
    rows = rows.where((F.col("link") != "") & ~F.array_contains(of("skip", [], "array<string>"), urls.without_slash(F.col("link"))))
    rows = rows.withColumn("url", F.when(start == "", link).otherwise(urls.resolve(start, link)))
    host = of("host", "", "string")
    low = F.lower("url")
    parts, never = of("parts", [], "array<string>"), of("not", [], "array<string>")
    rows = rows.where((host == "") | urls.host_matches(urls.host(F.col("url")), host))
    rows = rows.where(((F.size(parts) == 0) | F.exists(parts, lambda p: F.contains(low, p))) & ~F.exists(never, lambda p: F.contains(low, p)))
    rows = rows.where(F.col("link").endswith(of("end", "", "string")))
    # A url counts once, before titles are looked at.
    once = of("once", False, "boolean")
    first = F.row_number().over(ingest.Window.partitionBy("page_id", "source_id", "url").orderBy("pos"))
    rows = rows.withColumn("_n", first).where(~once | (F.col("_n") == 1)).drop("_n")
    title = F.when(of("noise", False, "boolean"), text.without_noise(F.col("title"))).otherwise(F.col("title"))
    rows = rows.withColumn("title", title).where((F.length("title") >= F.greatest(of("least", 1, "int"), F.lit(1))) & ~F.array_contains(of("no", [], "array<string>"), F.lower(F.trim("title"))))
    mark = of("cut", "", "string")
    (left, right), (own, other) = text.split_once(F.col("date_raw"), "·"), text.split_once(F.col("date_raw"), "|")
    raw = F.when(mark == "·", left).when((mark == "|") & F.contains("date_raw", F.lit("|")), other).when(of("month", False, "boolean"), text.month_year(F.col("date_raw"))).otherwise(F.col("date_raw"))
    category = F.when(mark == "·", right).when((mark == "|") & F.contains("date_raw", F.lit("|")), own).otherwise(F.col("category"))
    rows = rows.withColumns({"category": category, "date_raw": raw})
    other_first = F.when(of("first", "", "string") == "MM-dd-yyyy", F.try_to_date("date_raw", "MM-dd-yyyy"))
    date = F.coalesce(F.when(F.col("iso") != "", dates.iso_date(F.col("iso"))), other_first, dates.parse_date(F.col("date_raw")))
    rows = rows.withColumn("date", date).where(~of("dated", False, "boolean") | (F.col("date_raw") != ""))
    # Of rows with one title but for an audio mark, the preferred kind.
    wanted, plain = of("prefer", "", "string"), text.without_audio_mark(F.col("title"))
    group = ingest.Window.partitionBy("page_id", "source_id", F.when(wanted != "", plain).otherwise(F.col("pos").cast("string")))
    rows = rows.withColumn("_n", F.row_number().over(group.orderBy((F.col("kind") != wanted).cast("int"), "pos"))).where("_n = 1").drop("_n")
    newest = F.when(of("newest", False, "boolean"), F.unix_date("date"))
    order = F.row_number().over(ingest.Window.partitionBy("page_id", "source_id").orderBy(F.desc_nulls_last(newest), "pos"))
    return rows.withColumn("rn", order).where(F.col("rn") <= most).select("page_id", "source_id", "rn", "title", "url", "date", "date_raw", "category", "summary")


def json_rows(payloads: DataFrame, most: int = 10) -> DataFrame:
    """(page_id, source_id, rn, title, url, date, author, gated) of payloads(page_id, source_id, raw) in JSON_LISTINGS."""
    out = []
    for source, rule in JSON_LISTINGS.items():
        names = {*rule["title"], *rule["link"], rule["date"], *(rule[k] for k in ("first", "author", "category", "summary") if k in rule), "Lock"}
        items = F.from_json(F.get_json_object("raw", f"$.{rule['path']}"), f"array<struct<{', '.join(f'`{n}`: string' for n in sorted(names))}>>")
        rows = payloads.where(F.col("source_id") == source).select("page_id", "source_id", F.posexplode(items).alias("pos", "r"))
        field = lambda n: F.coalesce(F.col("r")[n], F.lit(""))
        title, link = (F.trim(F.coalesce(text.first_filled(*[F.col("r")[n] for n in rule[k]]), F.lit(""))) for k in ("title", "link"))
        date = dates.iso_date(field(rule["date"]))
        if "first" in rule:
            date = F.coalesce(F.try_to_date(field(rule["first"]), "MM-dd-yyyy"), dates.parse_date(field(rule["date"])))
        author = F.trim(text.without_prefix(field(rule["author"]), "By ")) if "author" in rule else F.lit("")
        url = urls.resolve(F.lit(rule["base"]), link)
        out.append(rows.select("page_id", "source_id", "pos", title.alias("title"), link.alias("_link"), url.alias("url"), date.alias("date"), author.alias("author"), F.coalesce(F.col("r")["Lock"] == "true", F.lit(False)).alias("gated")).where("title <> '' and _link <> ''").where(F.lit(rule["host"] == "") | urls.host_matches(urls.host(F.col("url")), F.lit(rule["host"]))))
    return ingest.top_n(status.union_all(*out), ["page_id", "source_id"], [F.col("pos")], most).drop("pos", "_link")
