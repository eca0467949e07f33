"""URL expressions. Each takes and returns Columns and stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: path words that speak for or against research content.
RESEARCH_WORDS = ["research", "insight", "insights", "publication", "publications", "commentary", "market-commentary", "white-paper", "report", "reports", "quarterly", "annual", "letters", "outlook", "papers", "library", "perspectives", "thinking"]
OTHER_WORDS = ["about", "careers", "contact", "team", "leadership", "events", "podcast", "video", "subscribe", "login", "register"]

HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
ORIGIN = r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)"


def _words(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def host(url: Column) -> Column:
    """Lower-case host, '' where there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def host_matches(name: Column, expected: Column) -> Column:
    """The host is the expected one or one below it."""
    return (name == F.lower(expected)) | name.endswith(F.concat(F.lit("."), F.lower(expected)))


def without_slash(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def canonical(url: Column) -> Column:
    """Scheme, host and path alone."""
    return F.concat(F.regexp_extract(url, ORIGIN, 1), path(url))


def _without_dots(url: Column) -> Column:
    """Dot segments of the path are taken out, as browsers do: /a/./b/../c is /a/c; those above the root vanish."""
    origin, tail = F.regexp_extract(url, ORIGIN, 1), F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(path(url), "/")

    def walk(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), walk)
    # A path that ends in a dot segment ends in a slash.
    ends = F.when(path(url).rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(path(url).rlike(r"/\.{1,2}(/|$)"), F.concat(origin, F.array_join(kept, "/"), ends, tail)).otherwise(url)


def resolve(base: Column, href: Column) -> Column:
    """href against the page's URL: absolute, scheme-relative, root-relative, query, fragment, or relative to the
    directory; dot segments are taken out."""
    origin, bare = F.regexp_extract(base, ORIGIN, 1), F.regexp_replace(base, r"[?#].*$", "")
    directory = F.concat(origin, F.coalesce(F.nullif(F.regexp_extract(path(base), r"^(.*/)", 1), F.lit("")), F.lit("/")))
    found = (
        F.when(href.rlike(SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, SCHEME, 1), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#") | (href == ""), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .otherwise(F.concat(directory, href))
    )
    return _without_dots(found)


def is_followable(href: Column) -> Column:
    """Neither empty nor a fragment nor a script link."""
    return (href != "") & ~href.startswith("#") & ~F.lower(href).startswith("javascript:")


def article_id(source: Column, url: Column) -> Column:
    """The first 16 hex digits of SHA-256 of source:url."""
    return F.substring(F.sha2(F.concat(source, F.lit(":"), url), 256), 1, 16)


def domain_score(url: Column, allowed: Column) -> Column:
    """1.0 on an allowed domain or its www host, 0.8 below one, else 0.0; the best over the array `allowed`."""
    name = host(url)

    def one(domain: Column) -> Column:
        domain = F.lower(F.trim(domain))
        exact = (name == domain) | (name == F.concat(F.lit("www."), domain))
        return F.when(exact, 1.0).when(name.endswith(F.concat(F.lit("."), domain)), 0.8).otherwise(0.0)

    best = F.array_max(F.transform(allowed, one))
    return F.when(F.coalesce(name, F.lit("")) == "", 0.0).otherwise(F.coalesce(best, F.lit(0.0)))


def path_score(url: Column, good: list[str] = RESEARCH_WORDS, bad: list[str] = OTHER_WORDS) -> Column:
    """Share of research words among the distinct path tokens found in either list; 0.5 where none is."""
    tokens = F.array_distinct(F.split(F.lower(path(url)), r"[/_\-]"))
    pos, neg = (F.size(F.array_intersect(tokens, _words(w))) for w in (good, bad))
    return F.coalesce(F.when(pos + neg > 0, pos / (pos + neg)), F.lit(0.5))


def segments(url: Column) -> Column:
    return F.filter(F.split(F.lower(path(url)), "/"), lambda x: x != "")


def has_word(url: Column, words: list[str]) -> Column:
    """A whole path segment is one of the words."""
    return F.arrays_overlap(segments(url), _words(words))
