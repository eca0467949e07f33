"""Page scores from html, and scores derived from stored components."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions import urls

# Fixed values of the data model: default weights, phrases of access walls and of consent notices.
WEIGHTS = {"domain": 0.2, "path": 0.3, "structure": 0.3, "gate": 0.2}
WALL_PHRASES = ["subscribe to read", "register to continue", "log in to read", "log in to continue", "sign up to read", "register to read", "for clients only"]
NOTICE_PHRASES = ["cookie preferences", "privacy policy", "terms of use", "manage cookies", "accept all cookies"]

# What a page's markup counts for. SIGNS_FOR give a point each; SIGNS_AGAINST are (pattern, points).
ARTICLE, TIME, PDF = r"<article[\s>]", r"<time[\s>]", r"""href=["'][^"']*\.pdf["']"""
SIGNS_FOR = [
    r"""class=["'][^"']*\b(author|byline)\b[^"']*["']""",
    r"read\s+more",
    r"download\s+report",
    r"""class=["'][^"']*\bpagination\b[^"']*["']""",
    r"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s+\d{4}\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
]
SIGNS_AGAINST = [
    (r"newsletter[- ]signup|newsletter_signup", 2),
    (r"""type=["']email["']""", 1),
    (r"""class=["'][^"']*\bcta[- _]?button\b[^"']*["']""", 1),
    (r"""class=["'][^"']*\bbtn[- _]?primary\b[^"']*["']""", 1),
]


# Markers of a body that is a gate or a disclaimer, and what URLs say of a page that was not fetched.
GATE_MARKERS = ["subscribe to read", "sign up to read", "register to continue", "register to read", "log in to continue", "log in to read", "accept all cookies", "cookie preferences", "manage cookies", "manage preferences", "privacy policy", "terms of use"]
DISCLAIMER_MARKERS = ["this content is available", "disclaimer"]
URL_AGAINST = ["career", "cookie", "privacy", "legal", "terms", "contact", "login", "subscribe", "account"]
URL_FOR = ["insight", "research", "library", "publication", "white", "perspective", "commentary", "analysis"]
# Dates as screening and as trial checks count them.
SCREEN_DATES = r"(?i)\b(?:\d{4}[-/]\d{1,2}[-/]\d{1,2})|(?:(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+\d{1,2},?\s+\d{4})|(?:\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+\d{4})\b"
CHECK_DATES = r"(?i)\b20\d{2}[-/]\d{2}[-/]\d{2}\b|\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{1,2},? 20\d{2}\b|\b\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* 20\d{2}\b"


def _points(test: Column, n: int = 1) -> Column:
    return F.when(test, n).otherwise(0)


def structure_score(html: Column, low: Column | None = None) -> Column:
    """Share of positive points among all points of the markup's signs; 0.0 for empty html. low: lower(html), where it
    stands in a column of its own already."""
    page = F.lower(html) if low is None else low
    articles, times, pdfs = (F.regexp_count(page, F.lit(p)) for p in (ARTICLE, TIME, PDF))
    good = reduce(add, [F.least(articles, F.lit(2)), F.least(times, F.lit(1)), F.least(pdfs, F.lit(3))] + [_points(page.rlike(p)) for p in SIGNS_FOR])
    bad = reduce(add, [_points(page.rlike(p), n) for p, n in SIGNS_AGAINST] + [_points((articles == 0) & (pdfs == 0) & (times == 0), 2)])
    return F.when(F.coalesce(html, F.lit("")) == "", 0.0).when(good + bad == 0, 0.5).otherwise(good / (good + bad))


def phrase_count(text: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur."""
    return reduce(add, [_points(F.contains(text, F.lit(p))) for p in phrases])


def gate_penalty(html: Column, phrases: list[str] = WALL_PHRASES + NOTICE_PHRASES, low: Column | None = None) -> Column:
    return F.least(F.lit(1.0), F.coalesce(phrase_count(F.lower(html) if low is None else low, phrases), F.lit(0)) * F.lit(0.15))


def final_score(domain: Column, path: Column, structure: Column, gate: Column, weights: dict[str, float | Column] = WEIGHTS) -> Column:
    w = {k: v if isinstance(v, Column) else F.lit(v) for k, v in weights.items()}
    return domain * w["domain"] + path * w["path"] + structure * w["structure"] + (1 - gate) * w["gate"]


def page_score(url: Column, html: Column, allowed: Column, weights: dict = WEIGHTS) -> Column:
    """All components and the final score of a page, as a struct."""
    d, p, s, g = urls.domain_score(url, allowed), urls.path_score(url), structure_score(html), gate_penalty(html)
    return F.struct(d.alias("domain_score"), p.alias("path_score"), s.alias("structure_score"), g.alias("gate_penalty"), final_score(d, p, s, g, weights).alias("final_score"))


def looks_gated(text: Column, markers: list[str] = GATE_MARKERS + DISCLAIMER_MARKERS) -> Column:
    """One of the markers occurs in the lower-cased text with its white space squeezed."""
    low = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))
    return phrase_count(low, markers) > 0


def page_components(url: Column, html: Column, allowed: Column, weights: dict = WEIGHTS) -> Column:
    """page_score with every number rounded to four digits, as rows are stored."""
    s = page_score(url, html, allowed, weights)
    names = ("domain_score", "path_score", "structure_score", "gate_penalty", "final_score")
    return F.struct(*[F.round(s[n], 4).alias(n) for n in names])


def url_only_score(url: Column, allowed: Column, weights: dict = WEIGHTS) -> Column:
    """Components of a page that was never fetched: structure and gate are estimated from its URL."""
    low = F.lower(url)
    against, speaks_for = phrase_count(low, URL_AGAINST) > 0, phrase_count(low, URL_FOR) > 0
    d, p = urls.domain_score(url, allowed), urls.path_score(url)
    s, g = F.when(against, 0.1).when(speaks_for, 0.8).otherwise(0.5), F.when(against, 0.5).otherwise(0.1)
    final = final_score(d, p, s, g, weights)
    return F.struct(*[F.round(c, 4).alias(n) for n, c in (("domain_score", d), ("path_score", p), ("structure_score", s), ("gate_penalty", g), ("final_score", final))])


def weights_or_default(weights: Column) -> Column:
    """A struct of four weights where all are there and sum to 1 within 0.01, else the defaults."""
    total = reduce(add, [weights[k] for k in WEIGHTS])
    default = F.struct(*[F.lit(v).alias(k) for k, v in WEIGHTS.items()])
    return F.when(F.coalesce(F.round(F.abs(total - 1), 9) <= 0.01, F.lit(False)), F.struct(*[weights[k].alias(k) for k in WEIGHTS])).otherwise(default)


def valid_weights(weights: dict[str, float | None]) -> dict[str, float]:
    """The weights if all four are there and sum to 1 within 0.01, else the defaults."""
    got = [weights.get(k) for k in WEIGHTS]
    return {k: float(weights[k]) for k in WEIGHTS} if None not in got and abs(sum(got) - 1) <= 0.01 else dict(WEIGHTS)


def rescored(final: Column, domain: Column, path: Column, structure: Column, gate: Column, weights: dict = WEIGHTS) -> Column:
    """The score under other weights, or the stored one where a component is missing."""
    parts = [domain, path, structure, gate]
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in parts])
    return F.when(whole, F.round(final_score(*parts, weights), 4)).otherwise(F.coalesce(final, F.lit(0.0)))


def adjusted(score: Column, is_index: Column, confidence: Column) -> Column:
    """0.1 more or less where a classifier is at least 0.8 sure."""
    return F.when(confidence >= 0.8, score + F.when(is_index, 0.1).otherwise(-0.1)).otherwise(score)


def band(score: Column, high: float = 0.6, low: float = 0.4) -> Column:
    return F.when(score >= high, "candidate").when(score < low, "rejected").otherwise("borderline")


def health(html: Column, score: Column, least: float = 0.4) -> Column:
    return F.when(html.isNull(), "error").when(score >= least, "ok").otherwise("degraded")


def sample_overall(relevance: Column, depth: Column, extractable: Column) -> Column:
    """To three digits."""
    return F.round(relevance * 0.4 + depth * 0.4 + extractable * 0.2, 3)


def queue_priority(score: Column, label: Column, fit: Column) -> Column:
    """0.6 quality + 0.4 fit; a missing or zero quality score falls back on the label's value."""
    value = F.when(label == "HIGH", 1.0).when(label == "MEDIUM", 0.5).otherwise(0.0)
    return F.coalesce(F.nullif(score, F.lit(0.0)), value) * 0.6 + F.coalesce(fit, F.lit(0.0)) * 0.4


def exact(score: Column) -> Column:
    """A score as a decimal of 15 digits, for sums and means: doubles added in another order differ in their last bits, which
    tell at a threshold and where a mean is rounded. What is no number is null."""
    return score.try_cast("decimal(22,15)")


def trial_outcome(days: Column, mean: Column, n: Column, least_days: int = 2) -> Column:
    """Too few days with articles fails on quantity; then no sample or a mean under 0.5 fails on quality."""
    low = mean < F.lit(0.5).cast("decimal(2,1)")
    return F.when(days < least_days, "fail_quantity").when((n == 0) | F.coalesce(low, F.lit(True)), "fail_quality").otherwise("pass")


def rounded_mean(mean: Column) -> Column:
    """Three digits, halves up; 0.0 without a mean."""
    return F.coalesce(F.round(mean, 3).cast("double"), F.lit(0.0))
