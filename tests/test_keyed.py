"""Stored keyed tables: versions, conflicts, growth, filters, and ingest against them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream import streaming
from quillstream.sources import keyed, shared
from quillstream.sources.keyed import Conflict, KeyedTable, Manifest


def table(spark, name="keyed", **kind):
    return KeyedTable(spark, shared.scratch(spark, name), "id long, value string", **kind)


def rows_of(spark, ids, value="a"):
    return spark.createDataFrame([(i, value) for i in ids], "id long, value string")


def held(df):
    return sorted((r["id"], r["value"]) for r in df.collect())


def test_upsert_rewrites_touched_buckets_alone(spark):
    t = table(spark, bucket_rows=10)
    first = t.append(lambda _: rows_of(spark, range(100)))
    assert first.buckets == 16 and first.rows == 100
    before = t.read()
    second = t.upsert(rows_of(spark, [3, 3, 200], "b"))
    touched = second.touched_since(first)
    assert 1 <= len(touched) <= 2
    assert all(second.writes[b] == first.writes[b] for b in first.writes.keys() - touched)
    assert held(t.read()) == sorted([(i, "a") for i in range(100) if i != 3] + [(3, "b"), (3, "b"), (200, "b")])
    assert held(before) == [(i, "a") for i in range(100)]  # a reader keeps its version
    assert held(t.read(version=1)) == held(before)
    assert second.rows == 102


def test_crash_before_the_commit_leaves_the_old_version(spark, monkeypatch):
    t = table(spark)
    t.append(lambda _: rows_of(spark, range(10)))

    def dies(_):
        raise OSError("lost")

    monkeypatch.setattr(t, "commit", dies)
    with pytest.raises(OSError):
        t.upsert(rows_of(spark, range(5), "b"))
    monkeypatch.undo()
    assert t.versions() == [1] and held(t.read()) == [(i, "a") for i in range(10)]
    assert len(t.vacuum()) == 1  # what the lost writer left
    assert held(t.read()) == [(i, "a") for i in range(10)]


def test_one_of_two_commits_of_a_version_wins(spark):
    t = table(spark)
    t.commit(Manifest(1, 1))
    with pytest.raises(Conflict):
        t.commit(Manifest(1, 2))
    assert t.manifest().buckets == 1 and t.versions() == [1]


def racing(t, other, monkeypatch):
    """t, where `other` runs between t's work and its first commit; gives the number of t's writes."""
    commit, write, writes = t.commit, t.write, []

    def late(manifest):
        monkeypatch.setattr(t, "commit", commit)
        other()
        commit(manifest)

    monkeypatch.setattr(t, "commit", late)
    monkeypatch.setattr(t, "write", lambda *a: writes.append(1) or write(*a))
    return writes


def test_writers_of_one_bucket_race(spark, monkeypatch):
    t = table(spark)
    t.append(lambda _: rows_of(spark, range(4)))
    other = KeyedTable(spark, t.root, t.schema)
    writes = racing(t, lambda: other.upsert(rows_of(spark, [1], "other")), monkeypatch)
    t.upsert(rows_of(spark, [2], "own"))
    assert len(writes) == 2  # done again on the new version
    assert held(t.read()) == [(0, "a"), (1, "other"), (2, "own"), (3, "a")]
    assert t.versions() == [1, 2, 3] and t.manifest().rows == 4


def test_writers_of_different_buckets_race(spark, monkeypatch):
    t = table(spark, bucket_rows=10)
    first = t.append(lambda _: rows_of(spark, range(100)))
    place = {r["id"]: r["b"] for r in spark.range(100).select("id", t.bucket_of(first.buckets).alias("b")).collect()}
    mine, theirs = 0, next(i for i in range(100) if place[i] != place[0])
    other = KeyedTable(spark, t.root, t.schema, bucket_rows=10)
    writes = racing(t, lambda: other.remove(rows_of(spark, [theirs])), monkeypatch)
    t.upsert(rows_of(spark, [mine], "own"))
    assert len(writes) == 1  # its files stand
    assert held(t.read()) == [(0, "own")] + [(i, "a") for i in range(1, 100) if i != theirs]
    assert t.manifest().rows == 99


def test_writers_in_threads(spark):
    from concurrent.futures import ThreadPoolExecutor

    t = table(spark)
    t.append(lambda _: rows_of(spark, range(8)))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: KeyedTable(spark, t.root, t.schema).upsert(rows_of(spark, [i], f"w{i}")), range(4)))
    assert held(t.read()) == [(i, f"w{i}") for i in range(4)] + [(i, "a") for i in range(4, 8)]
    assert t.versions() == [1, 2, 3, 4, 5]


def test_patch_sets_what_is_not_null(spark):
    t = KeyedTable(spark, shared.scratch(spark, "patched"), "id long, value string, n long", bucket_rows=5)
    t.append(lambda _: spark.createDataFrame([(i, "a", i) for i in range(20)], t.schema))
    t.patch(spark.createDataFrame([(1, "b", None), (2, None, 9), (99, "c", 1)], t.schema))
    got = {r["id"]: (r["value"], r["n"]) for r in t.read().collect()}
    assert got == {i: ("a", i) for i in range(20)} | {1: ("b", 1), 2: ("a", 9)}


def test_growth_and_parts(spark):
    t = table(spark, bucket_rows=8, parts=3, sketches=True)
    for k in range(12):
        t.append(lambda _, k=k: rows_of(spark, range(10 * k, 10 * k + 10)))
    now = t.manifest()
    assert now.rows == 120 and 120 / now.buckets <= 8 and max(map(len, now.writes.values())) <= 3
    assert held(t.read()) == [(i, "a") for i in range(120)]
    assert sorted(r[0] for r in t.stored_keys(rows_of(spark, [5, 119, 120, 500])).collect()) == [5, 119]
    assert len(t.vacuum(1)) > 0 and t.versions() == [now.version]
    assert held(t.read()) == [(i, "a") for i in range(120)]
    assert sorted(r[0] for r in t.stored_keys(rows_of(spark, [7, 1000])).collect()) == [7]


def test_empty_writes_and_strange_names(spark):
    t = KeyedTable(spark, shared.scratch(spark, "odd"), "`the key` string, bucket_ long", "the key", sketches=True)
    assert t.read().count() == 0
    t.append(lambda _: spark.createDataFrame([], t.schema))
    t.upsert(spark.createDataFrame([("x", 1), (None, 2)], t.schema))
    t.upsert(spark.createDataFrame([("x", 3)], t.schema))
    assert sorted(map(str, ((r[0], r[1]) for r in t.read().collect()))) == ["('x', 3)", "(None, 2)"]


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(0)
    own, others = rng.integers(-(2**63), 2**63, (2, 20_000))
    bits = keyed.bloom_filter(own)
    assert keyed.may_hold(bits, own).all()
    assert keyed.may_hold(bits, others).mean() < 0.002
    assert not keyed.may_hold(keyed.bloom_filter(own[:0]), others).any()


def files_read(df):
    return set(df.inputFiles())


def test_new_ids_read_no_stored_ids(spark):
    """What a batch reads of the store does not grow with the store: filters of its buckets, and parts they do not rule out."""
    read = []
    for size in (2_000, 20_000):
        t = table(spark, bucket_rows=500, sketches=True)
        now = t.append(lambda _, size=size: spark.range(size).select("id", F.lit("a").alias("value")))
        batch = shared.stored(rows_of(spark, [10**9 + 1, 10**9 + 2, 7]), "batch")
        maybe = t.may_hold(batch, now)
        parts = {(r["bucket"], r["write"]) for r in maybe.collect() if r["id"] != 7}
        assert not parts
        plan = t.stored_keys(batch, now)
        data = [f for f in files_read(plan) if "/data/" in f]
        assert len(data) == 1 and sorted(r[0] for r in plan.collect()) == [7]
        read.append(len([f for f in files_read(maybe) if "/sketch/" in f]))
        assert now.buckets >= size / 500
    assert max(read) <= 3


def test_overlapping_runs_add_each_id_once(spark):
    arrived, state = shared.scratch(spark, "arrived"), shared.scratch(spark, "state")
    t = table(spark, bucket_rows=50, sketches=True)
    for ids in (range(0, 120), range(60, 200), range(0, 200)):
        rows_of(spark, [*ids, *ids]).write.mode("append").parquet(arrived)
        streaming.ingest_keyed_stream(spark.readStream.schema(t.schema).parquet(arrived), t, state).awaitTermination()
    assert held(t.read()) == [(i, "a") for i in range(200)]
    assert t.manifest().commits == {"ingest": 2}


def test_a_batch_run_again_adds_nothing(spark):
    t = table(spark)
    for _ in range(2):
        t.append(lambda _: rows_of(spark, range(3)), commit=("s", 4))
    t.append(lambda _: rows_of(spark, range(3)), commit=("s", 3))
    assert t.manifest().rows == 3 and t.versions() == [1]


def test_scratch_is_deleted(spark):
    """What appends and batches write on the way is gone when they have committed."""
    import os
    from urllib.parse import urlparse

    def folders():
        return {n for n in os.listdir(urlparse(shared.shared_folder(spark)).path) if not n.startswith(("keyed", "arrived", "state"))}

    t = table(spark, sketches=True)
    arrived, state = shared.scratch(spark, "arrived"), shared.scratch(spark, "state")
    before = folders()
    rows_of(spark, range(9)).write.parquet(arrived)
    streaming.ingest_keyed_stream(spark.readStream.schema(t.schema).parquet(arrived), t, state).awaitTermination()
    t.upsert(rows_of(spark, [1], "b"))
    assert folders() == before and t.read().count() == 9
    with shared.scratch_scope(spark):
        kept = shared.stored(rows_of(spark, [1]), "one")
        with shared.scratch_scope(spark):
            shared.stored(kept, "two")
        assert kept.count() == 1 and len(folders() - before) == 1
    assert folders() == before


def test_commits_on_other_file_systems(spark, tmp_path):
    """Where a link is not to be had, a version is published by a rename that fails if it is there already."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.keyed.link./in", f"file://{tmp_path}")
    t = KeyedTable(spark, "viewfs://keyed/in/t", "id long, value string")
    t.append(lambda _: rows_of(spark, range(4)))
    t.upsert(rows_of(spark, [1], "b"))
    with pytest.raises(Conflict):
        t.commit(Manifest(1, 1))
    assert t.versions() == [1, 2] and held(t.read()) == [(0, "a"), (1, "b"), (2, "a"), (3, "a")]
    assert not list((tmp_path / "t/manifest").glob(".draft-*"))
