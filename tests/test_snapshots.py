"""Snapshots written and read back: all rows, filters, overwriting, lost writes."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillstream.sources import shared, snapshots

AT = datetime.datetime(2024, 3, 1, 12, 30, 15, 123456)
PAGES = [(f"https://h{k % 7}.example/p{k}?q=é", [200, 404, None][k % 3], AT if k % 4 else None, None if k % 3 == 2 or k == 4 else f"<p>page\r\n\r\n{k} 漢</p>") for k in range(60)] + [("https://h1.example/", 200, AT, ""), ("no url \"\n", 500, AT, None)]


@pytest.fixture(scope="module")
def stored(spark):
    folder = shared.scratch(spark, "snapshots")
    snapshots.write_pages(pages_of(spark, PAGES).repartition(3), folder, files=4)
    return folder


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "url string, status int, fetched_at timestamp, html string")


def rows_of(df):
    return sorted(((r["url"], r["status"], r["fetched_at"], r["html"]) for r in df.collect()), key=repr)


def test_pages_come_back_whole(spark, stored):
    got = snapshots.read_pages(spark, stored)
    assert rows_of(got) == sorted(PAGES, key=repr)
    assert {r["host"] for r in got.select("host").distinct().collect()} == {f"h{k}.example" for k in range(7)} | {""}


def test_filters_reach_the_source(spark, stored, capsys):
    some = snapshots.read_pages(spark, stored, host=["h3.example"], status=[200, 404]).where("length(html) > 3")
    assert rows_of(some) == sorted((p for p in PAGES if "//h3." in p[0] and p[1] in (200, 404) and len(p[3] or "") > 3), key=repr)
    some.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [EqualTo(host,h3.example), In(status, [200,404])]" in plan
    # What the source takes on is no filter of Spark's any more.
    filters = [line for line in plan.splitlines() if line.startswith("Condition")]
    assert filters and all("h3.example" not in line and "404" not in line for line in filters)


def test_one_table_filtered_in_two_ways(spark, stored):
    pages = snapshots.read_pages(spark, stored)
    both = pages.where("status = 404").select("url").union(pages.select("url"))
    assert both.count() == len(PAGES) + sum(p[1] == 404 for p in PAGES)
    of_host = snapshots.read_pages(spark, stored, host=["h0.example"])
    n = sum("//h0." in p[0] for p in PAGES)
    assert of_host.where("status = 200").select("url").union(of_host.select("url")).count() == n + sum("//h0." in p[0] and p[1] == 200 for p in PAGES)
    assert snapshots.read_pages(spark, stored, url=[]).count() == 0
    with pytest.raises(ValueError):
        snapshots.read_pages(spark, stored, html=["x"])


def test_filters_leave_files_and_records_out(stored):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    of = lambda **options: snapshots.PageSnapshots({"path": stored, **options}).reader(None)
    reader = of(host='["h0.example"]', status="[200, 500]")
    left = list(reader.pushFilters([EqualTo(("host",), "h0.example"), GreaterThan(("status",), 1), In(("status",), (200, 500)), EqualTo(("url",), "u")]))
    assert [type(f) for f in left] == [GreaterThan, EqualTo]
    parts = reader.partitions()
    assert 1 <= len(parts) < len(of().partitions())
    rows = [r for p in parts for batch in reader.read(p) for r in batch.to_pylist()]
    assert len(rows) == sum("//h0." in p[0] and p[1] == 200 for p in PAGES) and {r["host"] for r in rows} == {"h0.example"}


def test_files_are_read_in_parts(spark, stored, monkeypatch):
    monkeypatch.setattr(snapshots, "PART_BYTES", 500)
    reader = snapshots.PageSnapshots({"path": stored}).reader(None)
    parts = reader.partitions()
    assert len(parts) > 10
    assert sum(len(b) for p in parts for b in reader.read(p)) == len(PAGES)


def test_append_overwrite_and_nothing(spark):
    folder = shared.scratch(spark, "snapshots")
    first, second, third = PAGES[:5], PAGES[5:9], PAGES[9:11]
    snapshots.write_pages(pages_of(spark, []), folder)
    assert snapshots.read_pages(spark, folder).count() == 0
    for rows, mode, want in ((first, "append", first), (second, "append", first + second), (third, "overwrite", third)):
        snapshots.write_pages(pages_of(spark, rows), folder, mode)
        assert rows_of(snapshots.read_pages(spark, folder)) == sorted(want, key=repr)
    assert snapshots.read_pages(spark, shared.scratch(spark, "none")).count() == 0


def test_a_failed_job_leaves_nothing_to_read(spark):
    folder = shared.scratch(spark, "snapshots")
    snapshots.write_pages(pages_of(spark, PAGES[:3]), folder)
    bad = pages_of(spark, PAGES).withColumn("html", F.when(F.col("url").contains("p50"), F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        snapshots.write_pages(bad, folder)
    assert rows_of(snapshots.read_pages(spark, folder)) == sorted(PAGES[:3], key=repr)
