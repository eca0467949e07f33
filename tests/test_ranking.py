"""Weight sweeps without products of rows, the pooled report, SQL functions of the page score, folds of run states."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream import sources
from quillstream.functions import scoring, sql
from quillstream.operators import health, ranking
from quillstream.sources import shared

LABELLED = "fund_id string, label string, final_score double, domain_score double, path_score double, structure_score double, gate_penalty double"


def labelled(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    part = lambda: None if rng.random() < 0.05 else float(rng.choice([0, 0.3, 0.5, 0.8, 1.0, rng.random()]))
    rows = [(f"f{k % 7}" if k % 11 else None, str(rng.choice(["good", "bad", "other"])) if k % 13 else None, part(), part(), part(), part(), part()) for k in range(n)]
    return rows, spark.createDataFrame(rows, LABELLED)


def by_rows(df, weights):
    """Every page times every weight vector, as columns."""
    each = df.crossJoin(weights)
    final = scoring.rescored(*map(F.col, ("final_score", "domain_score", "path_score", "structure_score", "gate_penalty")), {k: F.col(k) for k in scoring.WEIGHTS})
    return ranking.overall(each.select("weight_id", "label", final.alias("final_score")), ("weight_id",))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sweep_equals_the_product(spark, monkeypatch):
    _, df = labelled(spark)
    grid = ranking.weight_grid(spark, 20)
    want = sorted(map(tuple, by_rows(df, grid).collect()))
    got = ranking.sweep(df.repartition(3), grid)
    assert "Join" not in plan_of(got) and sorted(map(tuple, got.collect())) == want and len(want) > 500
    monkeypatch.setattr(ranking, "SWEEP_BLOCK", 150)
    assert sorted(map(tuple, ranking.sweep(df, grid).collect())) == want


def test_sweep_of_many_vectors(spark):
    rows, df = labelled(spark, 60, 1)
    rng = np.random.default_rng(2)
    w = rng.dirichlet(np.ones(4), 10_000).round(3)
    weights = spark.createDataFrame([(int(k), *map(float, v)) for k, v in enumerate(w)], "weight_id long, domain double, path double, structure double, gate double")
    got = {r["weight_id"]: (r["n_good"], r["n_bad"], r["precision"], r["reject_rate"]) for r in ranking.sweep(df, weights).collect()}
    assert len(got) == 10_000
    some = weights.where("weight_id % 97 = 0")
    assert {r["weight_id"]: (r["n_good"], r["n_bad"], r["precision"], r["reject_rate"]) for r in by_rows(df, some).collect()} == {k: v for k, v in got.items() if k % 97 == 0}


def test_scores_at_the_edge_round_like_columns(spark):
    rows = [("f", "good", None, a, b, 0.5, g) for a, b, g in itertools.product([0.4999, 0.49994, 0.49995, 0.49996, 0.5], [0.5, 0.4998, 0.5001], [0.5, 0.4999])]
    df = spark.createDataFrame(rows, LABELLED)
    grid = ranking.weight_grid(spark)
    assert sorted(map(tuple, ranking.sweep(df, grid).collect())) == sorted(map(tuple, by_rows(df, grid).collect()))


@pytest.mark.parametrize("rows", [200, 3, 0])
def test_report_equals_both_queries(spark, rows):
    _, df = labelled(spark, rows)
    got = ranking.ranking_report(df).collect()
    funds = {r["fund_id"]: r for r in ranking.quality_per_fund(df).collect()}
    own = {r["fund_id"]: r for r in got if not r["pooled"]}
    assert own.keys() == funds.keys()
    for k, r in funds.items():
        assert {c: own[k][c] for c in r.asDict()} == r.asDict()
    (pooled,) = [r for r in got if r["pooled"]]
    (want,) = ranking.overall(df).collect()
    assert {c: pooled[c] for c in want.asDict()} == want.asDict()
    assert pooled["fund_id"] is None and (None in funds) == (rows > 0)


def test_report_scans_once(spark):
    df = labelled(spark, 50)[1]
    stored = shared.stored(df, "labelled")
    assert plan_of(ranking.ranking_report(stored)).count("Relation [") == 1


def test_sql_functions_equal_columns(spark):
    pages = [("https://www.a.example/research/x-team", "<article>a</article> read more subscribe to read", 1), ("http://b.a.example/", "", 2), (None, None, 3), ("nothing", "<TIME>2024-01-02</TIME> <a href='x.PDF'>", 4), ("https://c.example/about/insights?x=/login", 'type="email" newsletter-signup privacy policy', 5)]
    df = spark.createDataFrame(pages, "url string, html string, page_id int")
    sql.register(spark)
    got = spark.sql("SELECT page_id, s.* FROM (SELECT page_id, score_page(url, html, array(' A.example', 'c.example')) s FROM {df})", df=df)
    want = df.select("page_id", scoring.page_components(F.col("url"), F.col("html"), F.array(F.lit(" A.example"), F.lit("c.example"))).alias("s")).select("page_id", "s.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
    words = spark.sql("SELECT page_id, word, good FROM {df}, LATERAL path_words(url)", df=df).collect()
    assert sorted(map(tuple, words)) == [(1, "research", True), (1, "team", False), (5, "about", False), (5, "insights", True)]


RUNS = "source_id string, run date, total long, gated_ratio double, valid_ratio double, mismatch long"


def some_runs(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(None if s == 5 else f"s{s}", np.datetime64("2024-01-01") + day, int(rng.integers(0, 2) * rng.integers(0, 3)), 0.1 * (day % 3), 0.5, day % 2) for s in range(6) for day in range(30) if rng.random() < 0.6]
    return spark.createDataFrame([(s, d.astype(object), *rest) for s, d, *rest in rows], RUNS)


def state_of(df):
    return sorted(map(tuple, df.select("source_id", "run", "total", "zero_streak", "mismatch", "alerts").collect()), key=repr)


@pytest.mark.parametrize("cuts", [[31], [1, 2, 3, 8, 9, 31], [15, 31], [*range(1, 32, 4), 31]])
def test_folding_in_any_grouping_equals_the_batch(spark, cuts):
    runs = some_runs(spark, len(cuts))
    state = sources.run_state(spark, shared.scratch(spark, "state"), runs.schema)
    day = F.dayofmonth("run")
    before = 0
    for cut in cuts:
        found = sources.fold_run(runs.where((day >= before) & (day < cut)), state)
        before = cut
    assert state_of(found) == state_of(health.inspection_state(runs))
    assert state_of(sources.fold_run(runs, state)) == state_of(found)  # folded before


def test_summaries_merge_in_any_grouping(spark):
    runs = some_runs(spark, 9)
    parts = [health.streak_summary(runs.where((F.dayofmonth("run") >= a) & (F.dayofmonth("run") < b))) for a, b in ((0, 6), (6, 7), (7, 20), (20, 32))]
    left = health.merged(health.merged(health.merged(parts[0], parts[1]), parts[2]), parts[3])
    right = health.merged(parts[0], health.merged(parts[1], health.merged(parts[2], parts[3])))
    whole = health.streak_summary(runs)
    rows = lambda df: sorted(map(tuple, df.select(*whole.columns).collect()), key=repr)
    assert rows(left) == rows(right) == rows(whole)


def test_log_keeps_all_runs(spark):
    runs = some_runs(spark, 3).where("source_id is not null")
    log = shared.scratch(spark, "log")
    state = sources.run_state(spark, shared.scratch(spark, "state"), runs.schema)
    for part in (runs.where("run < '2024-01-10'"), runs.where("run >= '2024-01-10'")):
        sources.fold_run(part, state, log)
    assert spark.read.parquet(log).count() == runs.count()
