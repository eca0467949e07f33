"""Links of pages by their rules, pages that they lead to, and scored link lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import scoring, urls
from quillstream.operators import ingest

# Path segments of research links and of others, parts of paths that are no articles.
RESEARCH_SEGMENTS = ["research", "insight", "insights", "perspectives", "commentary", "white-paper", "white-papers", "publications", "reports", "outlook", "thinking", "ideas", "library", "letters", "quarterly", "viewpoints"]
OTHER_SEGMENTS = ["about", "careers", "career", "contact", "team", "leadership", "events", "podcast", "video", "subscribe", "login", "register", "privacy", "legal", "terms", "cookie", "press", "media-kit", "investor-relations", "ir", "newsroom"]
NO_ARTICLE = ["/tag/", "/category/", "/page/", "/author/", "/login", "/search"]


def resolved(links: DataFrame) -> DataFrame:
    """links(base, href, ..) that can be followed, with their `url` and its `key`, which ignores trailing slashes."""
    rows = links.where(urls.is_followable(F.col("href"))).withColumn("url", urls.resolve(F.col("base"), F.col("href")))
    return rows.withColumn("key", urls.without_slash(F.col("url")))


def nav_links(links: DataFrame, allowed: Column) -> DataFrame:
    """(page_id, url, label, pos): links on an allowed domain, each once by its key, in order."""
    rows = resolved(links).where(urls.domain_score(F.col("url"), allowed) > 0)
    return ingest.keep_first(rows.select("page_id", "key", "url", "label", "pos"), ["page_id", "key"], [F.col("pos")]).drop("key")


def research_links(links: DataFrame, allowed: Column, most: int = 20) -> DataFrame:
    """At most `most` links of each page whose path has a research segment and none of the others, on an allowed host."""
    name = urls.host(F.col("url"))
    on = F.exists(allowed, lambda d: (name == d) | name.endswith(F.concat(F.lit("."), d)))
    rows = resolved(links).where(on & urls.has_word(F.col("url"), RESEARCH_SEGMENTS) & ~urls.has_word(F.col("url"), OTHER_SEGMENTS))
    firsts = ingest.keep_first(rows.select("page_id", "key", "url", "label", "pos"), ["page_id", "key"], [F.col("pos")])
    return ingest.top_n(firsts, ["page_id"], [F.col("pos")], most).drop("key")


def is_article(base: Column, url: Column) -> Column:
    """On the page's own host and port, neither its own path nor the root, at least two segments, no listing."""
    authority = lambda u: F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    own, low = urls.path(url), F.lower(urls.path(url))
    listing = scoring.phrase_count(low, NO_ARTICLE) > 0
    return (authority(url) == authority(base)) & ~own.isin("", "/") & (own != urls.path(base)) & ~listing & (F.size(urls.segments(url)) >= 2)


def article_links(links: DataFrame, most: int = 3) -> DataFrame:
    """At most `most` article links of each page, by scheme, host and path alone."""
    rows = links.where(F.col("href").isNotNull()).withColumn("url", urls.resolve(F.col("base"), F.col("href")))
    rows = rows.where(is_article(F.col("base"), F.col("url"))).withColumn("link", urls.canonical(F.col("url")))
    firsts = rows.groupBy("page_id", "link").agg(F.min("pos").alias("pos"))
    return ingest.top_n(firsts, ["page_id"], [F.col("pos")], most)


def unscored(links: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Links whose url none of the scored pages of the same `key` has, trailing slashes ignored."""
    done = scored.select(key, urls.without_slash(F.col("url")).alias("_url")).distinct()
    return links.withColumn("_url", urls.without_slash(F.col("url"))).join(done, [key, "_url"], "left_anti").drop("_url")


def followed(links: DataFrame, pages: DataFrame) -> DataFrame:
    """links(.., url) joined with the pages(url, page_id) that they lead to, trailing slashes ignored. Both sides are
    shuffled: a link table may be larger than what Spark expects of it."""
    to = pages.select(urls.without_slash(F.col("url")).alias("_url"), F.col("page_id").alias("target")).groupBy("_url").agg(F.min("target").alias("target"))
    return links.withColumn("_url", urls.without_slash(F.col("url"))).join(to.hint("merge"), "_url").drop("_url")


def candidate_pages(main: DataFrame, main_links: DataFrame, home_links: DataFrame, pages: DataFrame, key: str, most: int = 20) -> DataFrame:
    """(key, url, origin): the main page, the pages that its first links lead to, and those of the homepage's first links
    that are not among them. main(key, url), links(key, url, pos)."""
    first = lambda rows: ingest.top_n(rows, [key], [F.col("pos")], most)
    own = main.select(key, urls.without_slash(F.col("url")).alias("_main"))
    inner = first(main_links).join(own, key).where(urls.without_slash(F.col("url")) != F.col("_main")).drop("_main")
    scored = main.select(key, "url", F.lit("main").alias("origin")).unionByName(followed(inner, pages).select(key, "url", F.lit("link").alias("origin")))
    extra = followed(unscored(first(home_links), scored, key), pages).select(key, "url", F.lit("home").alias("origin"))
    return scored.unionByName(extra)


def page_parts(pages: DataFrame, phrases: list[str] | None = None) -> DataFrame:
    """(url, structure_score, gate_penalty) of pages(url, html): each page is scored where it is and its html goes no
    further; of several pages of one url the lowest structure counts, with the lowest penalty of those."""
    low = F.lower("html")
    gate = scoring.gate_penalty(F.col("html"), phrases, low=low) if phrases else scoring.gate_penalty(F.col("html"), low=low)
    each = pages.select("url", F.struct(scoring.structure_score(F.col("html"), low).alias("s"), gate.alias("g")).alias("_parts"))
    return each.groupBy("url").agg(F.min("_parts").alias("_parts")).select("url", F.col("_parts.s").alias("structure_score"), F.col("_parts.g").alias("gate_penalty"))


def scored_links(links: DataFrame, pages: DataFrame, allowed: Column, phrases: list[str] | None = None) -> DataFrame:
    """links(page_id, url, pos, ..) with components and final score, to four digits, by the html of pages(url, html); a
    link whose page was not fetched has no structure and no penalty. Links off the allowed domains are left out."""
    rows = links.withColumn("domain_score", urls.domain_score(F.col("url"), allowed)).where("domain_score > 0")
    rows = rows.join(page_parts(pages, phrases).hint("merge"), "url", "left")
    rows = rows.withColumns({"path_score": urls.path_score(F.col("url")), "structure_score": F.coalesce("structure_score", F.lit(0.0)), "gate_penalty": F.coalesce("gate_penalty", F.lit(0.0))})
    names = ("domain_score", "path_score", "structure_score", "gate_penalty")
    final = scoring.final_score(*map(F.col, names))
    if "is_index" in links.columns:
        final = scoring.adjusted(final, F.col("is_index"), F.col("confidence"))
    return rows.withColumn("final_score", F.round(final, 4)).withColumns({n: F.round(n, 4) for n in names})


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key by score, best first, in stored order where equal."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("final_score"), "pos")))
