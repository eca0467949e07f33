import math

import pytest
from pyspark.sql import functions as F

from quillstream.functions import dates, scoring, text, urls

INDEX = '<html><body><article><time>Mar 2026</time></article><article class="author box">read more</article><a href="/a.pdf">x</a></body></html>'
GATED = "<html><body>Subscribe to read. Register to continue. Cookie preferences</body></html>"


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("url", "want"),
    [("https://www.man.com/x", 1.0), ("https://man.com", 1.0), ("https://a.man.com/", 0.8), ("https://woman.com", 0.0), ("", 0.0), ("https://MAN.com:443/x", 1.0), (None, 0.0)],
)
def test_domain_score(spark, url, want):
    assert one(spark, urls.domain_score(F.lit(url).cast("string"), F.array(F.lit(" man.com"), F.lit("aqr.com")))) == want


@pytest.mark.parametrize(("url", "want"), [("https://x.com/research", 1.0), ("https://x.com/about/research", 0.5), ("https://x.com/market-commentary", 1.0), ("https://x.com/white-paper", 0.5), ("https://x.com/", 0.5), ("https://x.com/about/about", 0.0)])
def test_path_score_counts_distinct_tokens(spark, url, want):
    assert one(spark, urls.path_score(F.lit(url))) == want


def test_page_scores(spark):
    score = lambda url, page: one(spark, scoring.page_score(F.lit(url), F.lit(page), F.array(F.lit("x.com"))))
    s = score("https://x.com/research", INDEX)
    assert (s.domain_score, s.path_score, s.structure_score, s.gate_penalty) == (1.0, 1.0, 1.0, 0.0) and math.isclose(s.final_score, 1.0)
    about = score("https://x.com/about", "<html><p>We are</p></html>")
    assert about.structure_score == 0.0 and math.isclose(about.final_score, 0.4)
    assert math.isclose(one(spark, scoring.gate_penalty(F.lit(GATED))), 0.45)
    assert one(spark, scoring.gate_penalty(F.lit(" ".join(scoring.WALL_PHRASES + scoring.NOTICE_PHRASES)))) == 1.0
    assert one(spark, scoring.structure_score(F.lit(""))) == 0.0


def test_weights_and_rescore(spark):
    assert scoring.valid_weights(dict.fromkeys(scoring.WEIGHTS, 0.5)) == scoring.WEIGHTS
    assert scoring.valid_weights({"domain": 0.25, "path": 0.25, "structure": 0.25, "gate": 0.25})["gate"] == 0.25
    none = F.lit(None).cast("double")
    assert one(spark, scoring.rescored(none, F.lit(1.0), F.lit(1.0), F.lit(0.8), F.lit(0.1))) == 0.92
    assert one(spark, scoring.rescored(F.lit(0.75), none, F.lit(1.0), F.lit(0.8), F.lit(0.1))) == 0.75
    assert math.isclose(one(spark, scoring.final_score(F.lit(1.0), F.lit(0.5), F.lit(0.5), F.lit(0.0), {"domain": 0.1, "path": 0.4, "structure": 0.4, "gate": 0.1})), 0.6)
    assert math.isclose(one(spark, scoring.sample_overall(F.lit(1.0), F.lit(0.5), F.lit(0.0))), 0.6)


@pytest.mark.parametrize(("raw", "want"), [("March 18, 2026", "2026-03-18"), (" Mar 18, 2026 ", "2026-03-18"), ("18 March 2026", "2026-03-18"), ("2026-03-18", "2026-03-18"), ("March 2026", "2026-03-01"), ("03/18/2026", "2026-03-18"), ("18/03/2026", "2026-03-18"), ("not a date", "None"), ("", "None")])
def test_parse_date(spark, raw, want):
    assert str(one(spark, dates.parse_date(F.lit(raw)))) == want


def test_more_dates(spark):
    assert str(one(spark, dates.mail_date(F.lit("Tue, 03 Mar 2026 10:00:00 +0000")))) == "2026-03-03"
    assert str(one(spark, dates.iso_date(F.lit("2026-03-18T23:30:00Z")))) == "2026-03-18"
    assert one(spark, dates.looks_like_date(F.lit("March 3"))) and not one(spark, dates.looks_like_date(F.lit("Equities")))


def test_article_id(spark):
    a = one(spark, urls.article_id(F.lit("man"), F.lit("https://x/1")))
    assert len(a) == 16 and a != one(spark, urls.article_id(F.lit("aqr"), F.lit("https://x/1"))) and a == one(spark, urls.article_id(F.lit("man"), F.lit("https://x/1")))


@pytest.mark.parametrize(("href", "want"), [("/a", "https://x.com/a"), ("b.html", "https://x.com/p/b.html"), ("https://y.org/", "https://y.org/"), ("//z.org/q", "https://z.org/q"), ("?p=2", "https://x.com/p/i?p=2")])
def test_resolve(spark, href, want):
    assert one(spark, urls.resolve(F.lit("https://x.com/p/i?a=1#f"), F.lit(href))) == want


def test_answers_and_themes(spark):
    whole = '{"summary_en": "a", "summary_zh": "b", "themes": [], "key_takeaway_en": "c", "key_takeaway_zh": "d"}'
    assert one(spark, text.answer_json(F.lit(f"Here:\n```json\n{whole}\n```"))) == whole
    assert one(spark, text.answer_json(F.lit('{"summary_en": "a"}'))) is None and one(spark, text.answer_json(F.lit("no"))) is None
    assert one(spark, text.canonical_themes(F.lit('["AI/Tech","BogusTheme","NotReal"]'))) == ["AI/Tech"]
    assert one(spark, text.canonical_themes(F.lit('[{"name": "ai"}, {"label": "emerging markets"}, {"x": 1}]'))) == ["AI/Tech", "China/EM"]
    assert one(spark, text.canonical_themes(F.lit('"AI/Tech"'))) == []
    assert [one(spark, text.slug(F.lit(t))) for t in ("AI/Tech", "Equities/Value")] == ["ai-tech", "equities-value"]
    assert one(spark, text.metadata_body(F.lit(""), F.lit("c"), F.lit(None).cast("string"))) is None
    assert one(spark, text.alerts(F.lit(2), F.lit(0.6), F.lit(0.2), F.lit(4))) == ["zero_streak", "gated", "invalid_bodies", "mismatch"]
