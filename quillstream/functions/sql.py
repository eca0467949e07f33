"""The page score and its parts as SQL functions of a session, which Catalyst inlines: no Python, no table.

    SELECT score_page(url, html, array('a.example')).final_score FROM pages
    SELECT page_id, word, good FROM pages, LATERAL path_words(url)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillstream.functions import scoring, urls


def text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def words(values: list[str]) -> str:
    return f"array({', '.join(map(text, values))})"


def _points(tests: list[tuple[str, int]]) -> str:
    return " + ".join(f"CASE WHEN {test} THEN {n} ELSE 0 END" for test, n in tests)


def _count(pattern: str) -> str:
    return f"regexp_count(lower(html), {text(pattern)})"


def _structure() -> str:
    articles, times, pdfs = map(_count, (scoring.ARTICLE, scoring.TIME, scoring.PDF))
    good = f"least({articles}, 2) + least({times}, 1) + least({pdfs}, 3) + " + _points([(f"lower(html) RLIKE {text(p)}", 1) for p in scoring.SIGNS_FOR])
    bad = _points([(f"lower(html) RLIKE {text(p)}", n) for p, n in scoring.SIGNS_AGAINST] + [(f"{articles} = 0 AND {pdfs} = 0 AND {times} = 0", 2)])
    # Both sums stand once, in a struct that the formula reads.
    return f"""CASE WHEN coalesce(html, '') = '' THEN 0D ELSE element_at(transform(array(named_struct('good', {good}, 'bad', {bad})),
        x -> CASE WHEN x.good + x.bad = 0 THEN 0.5D ELSE CAST(x.good AS DOUBLE) / (x.good + x.bad) END), 1) END"""


def _gate(phrases: list[str]) -> str:
    found = _points([(f"contains(lower(html), {text(p)})", 1) for p in phrases])
    return f"least(1D, coalesce({found}, 0) * 0.15D)"


def _final(part: str) -> str:
    w = scoring.WEIGHTS
    return f"{part}domain_score * {w['domain']}D + {part}path_score * {w['path']}D + {part}structure_score * {w['structure']}D + (1 - {part}gate_penalty) * {w['gate']}D"


PARTS = ("domain_score", "path_score", "structure_score", "gate_penalty")


def definitions(phrases: list[str] = scoring.WALL_PHRASES + scoring.NOTICE_PHRASES, good: list[str] = urls.RESEARCH_WORDS, bad: list[str] = urls.OTHER_WORDS) -> dict[str, str]:
    """Of each function: what follows its name in a definition. Later ones call earlier ones."""
    fields = ", ".join(f"{n}: DOUBLE" for n in (*PARTS, "final_score"))
    rounded = ", ".join(f"'{n}', round(x.{n}, 4)" for n in PARTS)
    return {
        "url_host": f"(url STRING) RETURNS STRING RETURN lower(regexp_extract(url, {text(urls.HOST)}, 1))",
        "url_path": f"(url STRING) RETURNS STRING RETURN regexp_extract(url, {text(urls.PATH)}, 1)",
        "domain_score": """(url STRING, allowed ARRAY<STRING>) RETURNS DOUBLE RETURN CASE WHEN coalesce(url_host(url), '') = '' THEN 0D ELSE coalesce(array_max(transform(allowed,
            d -> CASE WHEN url_host(url) IN (lower(trim(d)), concat('www.', lower(trim(d)))) THEN 1D WHEN endswith(url_host(url), concat('.', lower(trim(d)))) THEN 0.8D ELSE 0D END)), 0D) END""",
        "path_score": f"""(url STRING) RETURNS DOUBLE RETURN coalesce(element_at(transform(array(array_distinct(split(lower(url_path(url)), '[/_\\\\-]'))),
            t -> size(array_intersect(t, {words(good)})) / nullif(size(array_intersect(t, {words(good)})) + size(array_intersect(t, {words(bad)})), 0)), 1), 0.5D)""",
        "structure_score": f"(html STRING) RETURNS DOUBLE RETURN {_structure()}",
        "gate_penalty": f"(html STRING) RETURNS DOUBLE RETURN {_gate(phrases)}",
        "score_page": f"""(url STRING, html STRING, allowed ARRAY<STRING>) RETURNS STRUCT<{fields}> RETURN element_at(transform(array(named_struct('domain_score', domain_score(url, allowed), 'path_score', path_score(url),
            'structure_score', structure_score(html), 'gate_penalty', gate_penalty(html))), x -> named_struct({rounded}, 'final_score', round({_final("x.")}, 4))), 1)""",
        "path_words": f"""(url STRING) RETURNS TABLE (word STRING, good BOOLEAN) RETURN SELECT w AS word, array_contains({words(good)}, w) AS good
            FROM explode(array_distinct(split(lower(regexp_extract(url, {text(urls.PATH)}, 1)), '[/_\\\\-]'))) AS t(w) WHERE array_contains({words(good)}, w) OR array_contains({words(bad)}, w)""",
    }


def register(spark: SparkSession, **lists: list[str]) -> None:
    """The functions, as temporary ones of the session; lists: other phrases, good or bad words."""
    for name, body in definitions(**lists).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
