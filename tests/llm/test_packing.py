import functools
import itertools

import numpy as np
import pytest

from quillstream.llm import packing


def test_large_ids_beside_nulls(spark):
    """doc_ids above 2**53 stay whole where other rows of their batch have none."""
    ids = [2**53 + 1, None, 2**63 - 1, -(2**60) - 1, None]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").coalesce(1)
    got = [r["doc_id"] for r in packing.pack_documents(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, ids))


@functools.lru_cache(None)
def fewest_bins(lengths, capacity):
    """By trying every set of pieces that can share the longest one's bin."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for k in range(len(rest) + 1):
        for own in itertools.combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in own) <= capacity:
                best = min(best, 1 + fewest_bins(tuple(x for i, x in enumerate(rest) if i not in own), capacity))
    return best


def test_fullest_against_every_combination():
    rng = np.random.default_rng(1)
    for _ in range(300):
        room = int(rng.integers(0, 30))
        lengths = rng.integers(1, 20, rng.integers(0, 9)).tolist()
        counts = np.bincount(lengths, minlength=31)
        most = max(s for k in range(len(lengths) + 1) for own in itertools.combinations(lengths, k) if (s := sum(own)) <= room)
        taken = packing.fullest(counts, room)
        assert sum(taken) == most and (np.bincount(taken, minlength=31) <= counts).all()


def test_bins_against_exhaustive_packing():
    rng = np.random.default_rng(2)
    more = []
    for _ in range(150):
        lengths = tuple(sorted(rng.integers(1, 17, rng.integers(1, 10)).tolist(), reverse=True))
        plan = packing.slack_plan(dict(zip(*np.unique(lengths, return_counts=True), strict=True)), 16)
        used = {}
        for length, first, end, sequence, copies, offset in plan:
            for nth in range(end - first):
                used.setdefault(sequence + nth // copies, []).append((offset + nth % copies * length, length))
        for own in used.values():
            assert [o for o, _ in sorted(own)] == list(itertools.accumulate((n for _, n in sorted(own)[:-1]), initial=0)) and sum(n for _, n in own) <= 16
        assert sorted((n for own in used.values() for _, n in own), reverse=True) == list(lengths)
        more.append(len(used) - fewest_bins(lengths, 16))
    assert max(more) <= 1 and sum(more) <= 5


@pytest.mark.parametrize("texts", [["a"] * 40, [None, "", "word " * 3000, "x"]])
def test_sequences_hold_all_tokens(spark, texts):
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, sequence_id string, length int")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(texts)))
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) == -(-total // 1024)
