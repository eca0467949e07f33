"""Daily runs over one store: repeated, broken off, and on the days after."""

import json

import pytest

from quillstream.operators import daily
from quillstream.sources import shared

ANSWER = json.dumps({"summary_en": "s", "summary_zh": "z", "themes": ["macro"], "key_takeaway_en": "k", "key_takeaway_zh": "k"})
BODY = "word " * 40


def a_day(spark, date, urls, statuses, listed=None):
    rows = [("a", "A", f"T{u}", f"https://{'x' if u == 'foreign' else 'a'}.example/{u}", None, "", k, False, None, "sum") for k, u in enumerate(listed or urls)]
    from quillstream.functions.urls import article_id
    from pyspark.sql import functions as F

    listing = spark.createDataFrame(rows, daily.LISTED)
    pages = spark.createDataFrame([(f"https://a.example/{u}", s, f"<article><p>{BODY}{u}</p></article>" if s == 200 else None) for u, s in zip(urls, statuses, strict=True)], "url string, status int, html string")
    answers = listing.select(article_id(F.col("source_id"), F.col("url")).alias("id"), F.lit(0).alias("rank"), F.lit("m").alias("model"), F.lit(ANSWER).alias("raw"))
    registry = spark.createDataFrame([("a", "a.example", 3), ("b", "", 3)], "source_id string, expected_hostname string, max_articles int")
    rules = spark.createDataFrame([("a", "body", 0, "article p")], "source_id string, kind string, rank int, selector string")
    return daily.Day(date, listing, registry, pages, rules, answers)


def articles(store):
    return sorted((r["title"], r["content_status"], r["summarized"], r["fetched_at"], r["seq"]) for r in store.articles.read().collect())


def test_days_build_on_each_other(spark):
    store = daily.Store(spark, shared.scratch(spark, "daily"))
    one = a_day(spark, "2024-02-01", ["u1", "u2", "foreign", "u3", "u4"], [200, None, 200, 404, 200])
    assert daily.run_day(store, one) == []
    first = articles(store)
    assert first == [("Tu1", "ok", True, "2024-02-01", 1), ("Tu2", "failed", False, "2024-02-01", 2), ("Tu3", "failed", False, "2024-02-01", 3)]  # u4 is over the cap
    assert daily.run_day(store, one) == [] and articles(store) == first
    assert [(r["source_id"], r["total"], r["new"], r["mismatch"]) for r in daily.state(store).collect()] == [("a", 5, 3, 1)]
    before = store.published("timeline").read()
    two = a_day(spark, "2024-02-02", ["u1", "u2", "u5", "u3"], [404, 200, 200, 200])
    assert daily.run_day(store, two) == []
    assert articles(store) == [("Tu1", "ok", True, "2024-02-01", 1), ("Tu2", "ok", True, "2024-02-01", 2), ("Tu3", "ok", True, "2024-02-01", 3), ("Tu5", "ok", True, "2024-02-02", 4)]
    assert before.count() == 3 and store.published("timeline").read().count() == 4
    funds = {r["source_id"]: (r["n"], r["analysed"]) for r in store.published("funds").read().collect()}
    assert funds == {"a": (4, 4), "b": (0, 0)}
    assert [(r["total"], r["new"], r["zero_streak"]) for r in daily.state(store).collect()] == [(4, 1, 0)]


@pytest.mark.parametrize("broken", ["ingest", "content"])
def test_a_broken_stage_leaves_the_next_ones_out(spark, monkeypatch, broken):
    def dies(*_):
        raise RuntimeError("lost")

    stages = tuple((n, dies if n == broken else f) for n, f in daily.STAGES)
    store = daily.Store(spark, shared.scratch(spark, "daily"))
    day = a_day(spark, "2024-02-01", ["u1"], [200])
    monkeypatch.setattr(daily, "STAGES", stages)
    names = [n for n, _ in stages]
    assert daily.run_day(store, day) == names[names.index(broken) :]
    assert store.published("timeline").read().count() == (broken != "ingest")
    monkeypatch.undo()
    assert daily.run_day(store, day) == []
    assert articles(store) == [("Tu1", "ok", True, "2024-02-01", 1)]
