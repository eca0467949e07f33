import datetime as dt

from pyspark.sql import functions as F

import quillstream.sources as sources
from quillstream import streaming
from quillstream.functions import html
from quillstream.operators import funnel, health, ingest, ranking, report, views


def test_ingest_is_idempotent_and_filters_before_the_cap(spark, tmp_path):
    rows = [("a", f"https://evil.org/{i}", i) for i in range(3)] + [("a", f"https://www.a.com/{i % 4}", 10 + i) for i in range(9)]
    listing = spark.createDataFrame(rows, "source_id string, url string, pos int").withColumns({c: F.lit(None).cast("string") for c in ("source_name", "title", "date", "date_raw", "fetched_at")}).repartition(4)
    registry = spark.createDataFrame([("a", "a.com", 2)], "source_id string, expected_hostname string, max_articles int")
    stored = spark.createDataFrame([], "id string")
    first = ingest.ingest(listing, registry, stored)
    assert sorted(r.url for r in first.collect()) == ["https://www.a.com/0", "https://www.a.com/1"]
    first.write.parquet(f"{tmp_path}/articles")
    assert ingest.ingest(listing, registry, spark.read.parquet(f"{tmp_path}/articles")).count() == 0


def test_preference_dedup(spark):
    rows = spark.createDataFrame([("t", "Listen", 1), ("t", "Read", 2), ("t", "Read", 3), ("u", "Listen", 4), ("u", None, 0)], "title string, kind string, pos int").repartition(3)
    got = {(r.title, r.kind, r.pos) for r in ingest.prefer(rows, ["title"], F.col("kind") == "Read").collect()}
    assert got == {("t", "Read", 2), ("u", None, 0)}


def test_patch_and_replace(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, x double")
    new = spark.createDataFrame([(2, None, 5.0)], "id int, name string, x double")
    assert {tuple(r) for r in ingest.patch(old, new, "id").collect()} == {(1, "a", 1.0), (2, "b", 5.0)}
    assert {tuple(r) for r in ingest.replace_keys(old, new, "id").collect()} == {(1, "a", 1.0), (2, None, 5.0)}


def test_ranking_defaults(spark):
    scored = spark.createDataFrame([("a", "good", 0.9), ("b", "good", 0.6), ("b", "good", 0.2), ("c", "bad", 0.7), ("c", "bad", 0.1)], "fund_id string, label string, final_score double")
    got = {r.fund_id: (r.precision, r.reject_rate) for r in ranking.quality_per_fund(scored).collect()}
    assert got == {"a": (1.0, 0.0), "b": (0.5, 0.0), "c": (1.0, 0.5)}
    assert ranking.overall(scored.where("fund_id = 'a'")).first().overall == 0.6
    log = ranking.progress(spark.createDataFrame([(1, 0.9), (2, 0.9), (3, 0.95), (4, 0.95), (5, 0.9), (6, 0.9), (7, 0.1), (8, 0.2)], "seq int, yield double"))
    assert [r.status for r in log.orderBy("seq").collect()] == ["IMPROVED", "SAME", "IMPROVED"] + ["SAME"] * 5
    assert ranking.is_saturated(log).first().saturated


def test_views(spark):
    d = lambda n: dt.date(2026, 3, n)
    rows = [(1, 1, "m", d(2), True, ["AI/Tech"]), (2, 2, "m", None, False, None), (3, 3, "q", d(2), True, ["AI/Tech", "Crypto/Digital"]), (4, 4, "q", d(9), False, [])]
    articles = spark.createDataFrame(rows, "id int, seq int, source_id string, date date, summarized boolean, themes array<string>").repartition(3)
    assert [r.id for r in views.timeline(articles, 2).orderBy("position").collect()] == [4, 1, 3, 2]
    clusters = {r.cluster: (r.n, r.n_week, r.cross_fund, r.sources) for r in views.theme_clusters(articles, F.lit("2026-03-10").cast("date")).collect()}
    assert clusters == {"AI/Tech": (2, 0, True, "m,q"), "General": (2, 1, True, "m,q")}
    funds = spark.createDataFrame([("m",), ("q",), ("z",)], "source_id string")
    roll = views.fund_rollup(funds, articles)
    assert {tuple(r) for r in roll.collect()} == {("m", 2, 1, d(2)), ("q", 2, 1, d(9)), ("z", 0, 0, None)}
    assert {r.source_id: r.percent for r in views.fund_distribution(roll).collect()} == {"m": 100.0, "q": 100.0}


def test_zero_streak_batch_equals_stream(spark, tmp_path):
    runs = [("a", 1, 0), ("a", 2, 0), ("a", 3, 5), ("a", 4, 0), ("b", 1, 1), ("b", 2, 0)]
    table = spark.createDataFrame(runs, "source_id string, run long, total long")
    want = {(r.source_id, r.run): r.zero_streak for r in health.zero_streaks(table).collect()}
    assert want == {("a", 1): 1, ("a", 2): 2, ("a", 3): 0, ("a", 4): 1, ("b", 1): 0, ("b", 2): 1}
    table.write.parquet(f"{tmp_path}/in")
    stream = streaming.zero_streak_stream(spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName("streaks").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(100)
    assert {(r.source_id, r.run): r.zero_streak for r in spark.table("streaks").collect()} == want


def test_ingest_stream_adds_each_id_once(spark, tmp_path):
    for k, ids in enumerate((["a", "b", "a"], ["b", "c"])):
        spark.createDataFrame([(i,) for i in ids], "id string").write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema("id string").parquet(f"{tmp_path}/in")
        streaming.ingest_stream(source, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination(100)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_trials_and_queue(spark):
    checks = spark.createDataFrame([("t", True, 5), ("t", True, 3), ("t", False, 9), ("u", True, 1), ("v", True, 2), ("v", True, 2)], "trial_id string, accessible boolean, article_count int")
    samples = spark.createDataFrame([("t", 0.8), ("t", 0.4), ("v", 0.2)], "trial_id string, overall double")
    got = {r.trial_id: (r.articles, r.days, r.mean, r.outcome) for r in funnel.trial_rollup(checks, samples).collect()}
    assert got == {"t": (8, 2, 0.6, "pass"), "u": (1, 1, 0.0, "fail_quantity"), "v": (4, 2, 0.2, "fail_quality")}
    people = spark.createDataFrame([("a", "validated", "HIGH", 0.9, 0.5), ("b", "validated", "HIGH", 0.6, 1.0), ("c", "validated", "HIGH", 0.7, 0.7), ("d", "validated", "MEDIUM", None, 0.5), ("e", "validated", "HIGH", 0.0, 0.5), ("f", "seed", "HIGH", 1.0, 1.0)], "id string, status string, quality string, quality_score double, fit_score double")
    queue = funnel.trial_queue(people, spark.createDataFrame([("x",)], "id string"))
    assert [r.id for r in queue.orderBy(F.desc("priority"), "id").collect()] == ["e", "b", "a", "c", "d"]
    assert [r.id for r in funnel.fill_slots(queue, spark.createDataFrame([("z",)], "id string")).collect()] == ["e", "b"]


def test_means_of_trials_do_not_depend_on_the_order_of_rows(spark):
    """Sums of doubles are a bit under the threshold, or beside the half that is rounded, in some orders."""
    checks = spark.createDataFrame([(t, True, 5) for t in ("even", "tie") for _ in range(2)], "trial_id string, accessible boolean, article_count int")
    hundredths = {"even": [20, 95, 13, 55, 48, 69], "tie": [90, 10] * 19 + [55, 75]}
    for turn in (1, -1):
        samples = spark.createDataFrame([(t, h / 100) for t, own in hundredths.items() for h in own[::turn]], "trial_id string, overall double").coalesce(1)
        got = {r.trial_id: (r.mean, r.n_samples, r.outcome) for r in funnel.trial_rollup(checks, samples).collect()}
        assert got == {"even": (0.5, 6, "pass"), "tie": (0.508, 40, "pass")}
        lines = report.trial_progress(checks, samples, checks.select("trial_id").distinct())
        assert {r.trial_id: r.mean for r in lines.collect()} == {"even": 0.5, "tie": 0.508}


def test_screen_verdict(spark):
    rows = [(404, False, 0, 9, 9, 9, 9), (200, True, 0, 9, 9, 9, 9), (200, False, 2, 9, 9, 9, 9), (200, False, 1, 2, 2, 0, 0), (200, False, 0, 0, 0, 0, 3), (200, False, 0, 2, 1, 1, 2)]
    got = funnel.screen_verdict(spark.createDataFrame(rows, "status int, has_password boolean, login_phrases int, articles int, times int, dates int, h2 int").coalesce(1))
    assert [r.reason for r in got.collect()] == ["not accessible", "login wall", "login wall", "index", "index", "no index"]


def test_html_elements(spark):
    page = '<html><body><nav><a href="/n">N</a></nav><article><h1>T</h1><p>One <b>two</b><br>three<p>four</article><script>"</p>"</script><input type=PASSWORD></body></html>'
    rows = html.elements(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string"))
    assert [(r.href, r.label) for r in html.links(rows).collect()] == [("/n", "N")]
    counts = html.tag_counts(rows, ["article", "p"]).first()
    assert (counts.n_article, counts.n_p, counts.n_password) == (1, 2, 1)
    body = html.body_text(rows).first().text
    assert "N" not in body.split("\n") and body.startswith("T") and "four" in body


def test_sources(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"id": "1", "title": "x"}\n\nnot json\n{"title": "no id"}\n')
    assert [r.id for r in sources.read_ids(spark, f"{tmp_path}/log.jsonl").collect()] == ["1"]
    assert sources.read_json_lines(spark, f"{tmp_path}/log.jsonl", "id string", keep_bad=True).cache().where("_corrupt_record is not null").count() == 1
    (tmp_path / "e.json").write_text('{"sources": {"man": {"entrypoints": [{"url": "u1", "active": true}, {"url": "u2"}]}, "aqr": {"entrypoints": []}}}')
    assert [(r.source_id, r.pos, r.url, r.active) for r in sources.read_entrypoints(spark, f"{tmp_path}/e.json").collect()] == [("man", 0, "u1", True), ("man", 1, "u2", None)]
    (tmp_path / "broken.json").write_text("{oops")
    assert sources.read_entrypoints(spark, f"{tmp_path}/broken.json").count() == 0
    for name, body in (("list", '[{"id": "a"}, {"id": "b"}]'), ("object", '{"candidates": [{"id": "a"}, {"id": "b"}]}')):
        (tmp_path / f"{name}.json").write_text(body)
        assert [r.id for r in sources.read_list(spark, f"{tmp_path}/{name}.json", "candidates", "id string").orderBy("pos").collect()] == ["a", "b"]
    (tmp_path / "old.json").write_text('{"active_trial": {"id": "t", "daily_checks": {"2026-03-01": {"accessible": true, "article_count": 3}}}}')
    trials = sources.read_trials(spark, f"{tmp_path}/old.json")
    assert [(r.trial_id, str(r.date), r.article_count) for r in sources.daily_checks(trials).collect()] == [("t", "2026-03-01", 3)]
    (tmp_path / "x.tsv").write_text("commit\tyield\tstatus\tdescription\nabc\t0.97\tSAME\tnone\n")
    assert sources.read_experiments(spark, f"{tmp_path}/x.tsv").first()["yield"] == 0.97
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>L</link><pubDate>P</pubDate><category>a</category></item></channel></rss>")
    assert [(r.title, r.link) for r in sources.read_rss(spark, f"{tmp_path}/feed.xml").collect()] == [("T", "L")]
    raw = spark.createDataFrame([("g", '{"insights": {"hits": [{"title": "a"}, {"title": "b"}]}}')], "source_id string, raw string")
    assert [r.title for r in sources.listing_rows(raw, "insights.hits", "title: string").collect()] == ["a", "b"]
    sources.append(spark.createDataFrame([("1", "man")], "id string, source_id string"), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1
    sources.export_gzip(raw, f"{tmp_path}/view")
    assert spark.read.json(f"{tmp_path}/view").count() == 1


def test_body_rules(spark):
    long = "<main>short</main><div class='body text'><nav>menu</nav><p>" + "words " * 30 + "</p></div>"
    rows = html.elements(spark.createDataFrame([(1, long)], "page_id long, html string")).withColumn("source_id", F.lit("m"))
    best = html.body_by_rules(rows, html.body_rules(spark, [("m", 1, "main", None), ("m", 2, "div", "body")])).first()
    assert best.selector_rank == 2 and best.text == ("words " * 30).strip()
