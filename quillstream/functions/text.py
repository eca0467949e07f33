"""Text, JSON and array expressions over articles and model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: themes, and the keys that a model answer must have.
THEMES = ["AI/Tech", "Macro/Rates", "Oil/Energy", "Credit/Fixed Income", "Equities/Value", "China/EM", "Risk/Volatility", "Geopolitics", "ESG/Climate", "Quant/Factor", "Asset Allocation", "Crypto/Digital", "Real Estate", "Private Markets", "Behavioral/Sentiment"]
ANSWER_KEYS = ["summary_en", "summary_zh", "themes", "key_takeaway_en", "key_takeaway_zh"]
# Fixed value: a fenced block of an answer.
FENCE = "(?s)```(?:json)?\\s*\\n?(.*?)\\n?\\s*```"


# Icon names and calls to action in card titles; categories that are kept; labels of strategy tags.
NOISE = r"(?i)\b(arrow_forward|mail_outline|expand_more|GET\s+INSIGHTS|LEARN\s+MORE|READ\s+MORE|PRO)\b"
WANTED_CATEGORIES = ["analyst research", "market commentary", "white papers", "market insights"]
STRATEGY_LABELS = {
    "macro": "Macro", "quant": "Quant/CTA", "fixed_income": "Fixed Income", "multi_asset": "Multi-Asset", "equity": "Equity",
    "emerging_markets": "Emerging Markets", "esg_climate": "ESG/Climate", "private_equity": "Private Equity",
    "venture_capital": "VC", "private_credit": "Private Credit", "event_driven": "Event Driven",
}
# How links to PDF files are written, and suffixes of translations that give way to others.
PDF_HREF = r"""href=["']([^"']*\.pdf[^"']*)["']"""
PDF_CALL = r"""openPDF\(['"][^'"]+['"],\s*['"]([^'"]+\.pdf[^'"]*)['"]"""
TRANSLATED = r"(?i)_(jpn|krn|sc|tc)\."


def slug(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_tags(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"<[^>]+>", ""))


def without_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^﻿", "")


def without_audio_mark(title: Column) -> Column:
    return F.trim(F.replace(title, F.lit(" (Audio)"), F.lit("")))


def shortened(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def without_noise(text: Column) -> Column:
    """Without icon names and calls to action, white space squeezed."""
    return squeezed(F.regexp_replace(F.coalesce(text, F.lit("")), NOISE, ""))


def without_prefix(text: Column, prefix: str, instead: str = "") -> Column:
    return F.when(text.startswith(prefix), F.concat(F.lit(instead), F.substring(text, len(prefix) + 1, 1 << 30))).otherwise(text)


def split_once(text: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and behind the first mark, trimmed; the second is '' without one."""
    parts = F.split(text, "\\Q" + mark + "\\E", 2)
    return F.trim(parts[0]), F.coalesce(F.trim(F.try_element_at(parts, F.lit(2))), F.lit(""))


def cut(text: Column, most: int) -> Column:
    """The first `most` characters (100 of a label, 3000 of a sample, 15000 of a prompt)."""
    return F.substring(text, 1, most)


def pdf_link(page: Column, origin: Column) -> Column:
    """The first openPDF call's URL that is no translation, else the first such call, else the first PDF href; null
    without any. Relative ones get the origin."""
    calls = F.regexp_extract_all(page, F.lit(PDF_CALL), F.lit(1))
    plain = F.filter(calls, lambda x: ~x.rlike(TRANSLATED))
    found = F.coalesce(F.try_element_at(plain, F.lit(1)), F.try_element_at(calls, F.lit(1)), F.nullif(F.regexp_extract(page, PDF_HREF, 1), F.lit("")))
    return F.when(found.startswith("http"), found).otherwise(F.concat(origin, found))


def month_year(text: Column) -> Column:
    """A capital month and year (APR 2026) as the date parser reads it, '' where there is none."""
    return F.initcap(F.regexp_extract(text, r"\b([A-Z]{3}\s+\d{4})\b", 1))


def prompt(template: Column, fields: dict[str, Column], most: int = 15_000) -> Column:
    """The template with each {name} filled in, the field `content` cut to `most` characters."""
    out = template
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(cut(value, most) if name == "content" else value, F.lit("")))
    return out


def tag_labels(tags: Column, labels: dict[str, str] = STRATEGY_LABELS) -> Column:
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.transform(tags, lambda t: F.coalesce(F.try_element_at(known, t), t))


def wanted_category(categories: Column, wanted: list[str] = WANTED_CATEGORIES) -> Column:
    return F.arrays_overlap(F.transform(categories, lambda c: F.lower(F.trim(c))), F.array(*map(F.lit, wanted)))


def published_in_json_ld(raw: Column) -> Column:
    """datePublished (10 characters) of a JSON-LD object, or of the first object of a list that has one."""
    one = F.get_json_object(raw, "$.datePublished")
    items = F.from_json(raw, "array<struct<datePublished: string>>")
    named = F.filter(F.transform(items, lambda x: x["datePublished"]), lambda x: F.coalesce(x, F.lit("")) != "")
    found = F.when(F.ltrim(raw).startswith("["), F.try_element_at(named, F.lit(1))).otherwise(F.nullif(one, F.lit("")))
    return F.substring(found, 1, 10)


def data_layer(raw: Column) -> tuple[Column, Column]:
    """Of a data layer's JSON (an object of objects): the fields of its first key, and the first link of any key."""
    fields = "struct<publishDate: string, itemTitle: string, `xdm:linkURL`: string, linkURL: string>"
    values = F.map_values(F.from_json(raw, f"map<string, {fields}>"))
    link = lambda v: first_filled(v["xdm:linkURL"], v["linkURL"])
    return F.try_element_at(values, F.lit(1)), F.try_element_at(F.filter(F.transform(values, link), lambda x: x.isNotNull()), F.lit(1))


def fit_band(score: Column) -> Column:
    """high from 70 whole percent, middle from 50, else low; none without a score."""
    percent = F.floor(score * 100)
    return F.when(score.isNull(), "none").when(percent >= 70, "high").when(percent >= 50, "middle").otherwise("low")


def quality_band(score: Column, high: float, low: float) -> Column:
    """Of a trial 0.7 and 0.5, of a sample 0.6 and 0.4; a missing score is 0."""
    value = F.coalesce(score, F.lit(0.0))
    return F.when(value >= high, "high").when(value >= low, "middle").otherwise("low")


def is_recommended(notes: Column) -> Column:
    return F.coalesce(notes.startswith("RECOMMEND"), F.lit(False))


def long_enough(text: Column, least: int = 100) -> Column:
    return F.coalesce(F.length(text) > least, F.lit(False))


def is_pdf_response(status: Column, kind: Column, size: Column) -> Column:
    return status.between(200, 299) & F.contains(F.lower(F.coalesce(kind, F.lit(""))), F.lit("application/pdf")) & (size > 1024)


def is_json_payload(text: Column) -> Column:
    return ~F.ltrim(text).startswith("<") & F.try_parse_json(text).isNotNull()


def metadata_body(title: Column, category: Column, summary: Column) -> Column:
    """Title, category and summary lines; null where title and summary are both empty."""
    t, c, s = (F.coalesce(x, F.lit("")) for x in (title, category, summary))
    lines = [F.when(x != "", F.concat(F.lit(f"{name}: "), x)) for name, x in (("Title", t), ("Category", c), ("Summary", s))]
    return F.when((t != "") | (s != ""), F.concat_ws("\n", *lines))


def answer_json(raw: Column) -> Column:
    """The JSON object of a model answer (inside a fence, if there is one), null unless it has all required keys."""
    inner = F.coalesce(F.nullif(F.regexp_extract(raw, FENCE, 1), F.lit("")), raw)
    keys = F.expr("array(" + ", ".join(f"'{k}'" for k in ANSWER_KEYS) + ")")
    whole = F.size(F.array_except(keys, F.json_object_keys(F.to_json(F.try_parse_json(inner))))) == 0
    return F.when(whole, inner)


def first_object(raw: Column) -> Column:
    """From the first opening brace to the last closing one, null unless that is JSON."""
    found = F.regexp_extract(raw, r"\{[\s\S]*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def theme_names(raw: Column) -> Column:
    """Names of a JSON list of strings or objects (name, theme or label), in order."""
    items = F.from_json(raw, "array<string>")
    name = lambda x: F.when(x.startswith("{"), first_filled(*[F.get_json_object(x, f"$.{k}") for k in ("name", "theme", "label")])).otherwise(x)
    return F.coalesce(F.filter(F.transform(items, name), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def canonical_theme(name: Column, themes: list[str] = THEMES) -> Column:
    """The theme itself, or the one that has a /-part which the lower-cased name equals or begins with."""
    low = F.lower(F.trim(name))
    out = F.when(name.isin(themes), name)
    for theme in themes:
        for part in theme.lower().split("/"):
            out = out.when(low.startswith(part), theme)
    return out


def canonical_themes(raw: Column, themes: list[str] = THEMES) -> Column:
    return F.array_distinct(F.filter(F.transform(theme_names(raw), lambda x: canonical_theme(x, themes)), lambda x: x.isNotNull()))


def safe_float(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def alerts(zero_streak: Column, gated_ratio: Column, valid_ratio: Column, mismatches: Column) -> Column:
    """Names of the alarms that a source's metrics raise."""
    rules = [("zero_streak", zero_streak >= 2), ("gated", gated_ratio > 0.5), ("invalid_bodies", valid_ratio < 0.3), ("mismatch", mismatches > 3)]
    return F.array_compact(F.array(*[F.when(test, name) for name, test in rules]))
