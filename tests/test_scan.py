"""Prefix aggregates against plain loops, over few and many blocks and groups."""

import pytest
from pyspark.sql import functions as F

from quillstream.operators import ranking, scan, views


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a" if k % 3 else None, (k * 37) % 101, k % 4, None if k % 5 == 0 else (k * 13) % 17) for k in range(150)]
    return data, spark.createDataFrame(data, "k string, day long, seq long, v long").repartition(3)


OPS = {"sum": (scan.SUM, lambda xs: sum(xs)), "max": (scan.MAX, max), "min": (scan.MIN, min), "last": (scan.LAST, lambda xs: xs[-1])}


@pytest.mark.parametrize("blocks, fan, exclusive, keyed", [(1, 2, False, False), (5, 1024, True, False), (23, 3, False, False), (23, 2, True, True), (7, 3, False, True)])
def test_scan_equals_loop(rows, blocks, fan, exclusive, keyed):
    data, df = rows
    keys = ["k"] if keyed else []
    aggregates = {n: (op, F.col("v")) for n, (op, _) in OPS.items()}
    got = scan.prefix_scan(df, [F.desc("day"), F.col("seq")], aggregates, keys, exclusive, blocks, fan).collect()
    want = {}
    for key in {r[0] for r in data} if keyed else {0}:
        own = sorted((r for r in data if not keyed or r[0] == key), key=lambda r: (-r[1], r[2]))
        seen = []
        for r in own:
            before = [x for x in seen if x is not None]
            seen.append(r[3])
            held = before if exclusive else [x for x in seen if x is not None]
            want[r] = tuple(f(held) if held else None for _, f in OPS.values())
    order = {(-r[1], r[2]) for r in data}
    assert len(order) == len({r[1:3] for r in data}) and len(got) == len(data)
    for r in got:
        assert tuple(r[n] for n in OPS) == want[r["k"], r["day"], r["seq"], r["v"]]


def test_numbers_of_nothing_and_of_one_row(spark):
    empty = spark.createDataFrame([], "x long")
    assert scan.numbered(empty, [F.col("x")]).count() == 0
    assert [tuple(r) for r in scan.numbered(empty.unionByName(spark.range(1).toDF("x")), [F.col("x")]).collect()] == [(0, 1)]


def windows(df):
    """(partition, order) of every window of the plan."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            found.append((node.partitionSpec().size(), node.orderSpec().size()))
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_plans_have_no_window_without_a_key(spark):
    articles = spark.createDataFrame([("x", None, 1, ["t"], "s", True)], "id string, date date, seq long, themes array<string>, source_id string, summarized boolean")
    experiments = spark.createDataFrame([(1, 0.5), (2, 0.7)], "seq long, yield double")
    for df in (views.timeline(articles), views.cluster_members(articles), views.theme_clusters(articles, F.current_date()), ranking.progress(experiments)):
        found = windows(df)
        assert found and all(keys > 0 for keys, _ in found)


def test_progress_by_many_blocks(spark):
    values = [0.1, 0.5, 0.5, 0.4, 0.9, None, 0.9, 1.0]
    rows = spark.createDataFrame(list(enumerate(values)), "seq long, yield double")
    best, want = None, []
    for v in values:
        want.append("IMPROVED" if best is None or (v is not None and v > best) else "SAME")
        best = max((x for x in (best, v) if x is not None), default=None)
    got = [r["status"] for r in ranking.progress(rows).orderBy("seq").collect()]
    assert got == want
