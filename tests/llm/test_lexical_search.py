import math
import re
from collections import Counter

import numpy as np
import pytest

from quillstream.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    tfs = [Counter(terms_of(t)) for _, t in docs]
    n, total = sum(bool(c) for c in tfs), sum(c.total() for c in tfs)
    df = Counter(t for c in tfs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, own in asked.items():
        scored = []
        for (doc_id, _), c in zip(docs, tfs, strict=True):
            m = 10 + 90 * c.total() * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, k, None if none else doc, -score) for k, (score, none, doc) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=repr)


def random_docs(seed, n):
    rng = np.random.default_rng(seed)
    words = ["The", "the", "straße", "Ärger", "x1", "漢字", "a", "b", "c-d", "zeta", "eta", "theta"] + [f"w{k}" for k in range(30)]
    docs = [(int(k), " ".join(rng.choice(words, rng.integers(0, 40)))) for k in rng.permutation(n)]
    return docs + [(None, "the x1 b"), (3, None), (4, ""), (5, " .,- "), (2**53 + 1, "the zeta b"), (7, docs[0][1]), (7, docs[0][1]), (9, "eta " * 20000)] + [(1000 + k, "equal eta theta") for k in range(25)]


ITEMS = [(1, "the straße eta"), (2, "THETA, theta & w3 w4 w5"), (3, None), (4, ""), (5, "nothing of it"), (None, "x1"), (6, "a"), (6, "b"), (7, " ".join(f"w{k}" for k in range(30)))]


def test_search_equals_brute_force(spark):
    docs = random_docs(1, 300)
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank int, item_id string").repartition(5)
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    got = lexical_search.ranked_search(rows, items).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, ITEMS)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 6)
    docs = random_docs(2, 60)
    got = lexical_search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, ITEMS)


@pytest.mark.parametrize("docs, items", [([], ITEMS), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_search_of_nothing(spark, docs, items):
    found = lexical_search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


@pytest.mark.parametrize("leaf", [0, 5, 1024])
def test_intervals_give_the_best_documents(monkeypatch, leaf):
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    for _ in range(40):
        n_docs, n_terms = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        held = rng.random((n_terms, n_docs)) < rng.random()
        held[:, 0] |= ~held.any(1)
        impact = rng.integers(0, 4, (n_terms, n_docs)) * held
        term, doc = np.nonzero(held)
        lists = lexical_search.Postings(np.arange(n_terms), held.sum(1), doc, impact[term, doc], n_docs)
        own = np.flatnonzero(rng.random(n_terms) < 0.7).tolist()
        scores = impact[own].sum(0)
        want = sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:5]
        assert lists.top([*own, 99], 5) == [(-s, d) for s, d in want]


def test_bounds_save_work(monkeypatch):
    """Where few documents hold all terms, few intervals are split and few postings read."""
    rng = np.random.default_rng(3)
    n_docs, read = 20_000, []
    held = rng.random((20, n_docs)) < 0.1
    impact = np.where(held, rng.integers(1, 50, held.shape), 0)
    best = rng.choice(n_docs, 12, replace=False)
    held[:, best], impact[:, best] = True, 100
    term, doc = np.nonzero(held)
    lists = lexical_search.Postings(np.arange(20), held.sum(1), doc, impact[term, doc], n_docs)
    monkeypatch.setattr(lexical_search, "ragged", lambda left, size, of=lexical_search.ragged: read.append(int(size.sum())) or of(left, size))
    assert [d for _, d in lists.top(list(range(20)), 10)] == sorted(best.tolist())[:10]
    assert sum(read) < len(doc) / 4


def test_terms_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(lexical_search, "spans_hash", lambda values, starts, ends: np.ones(len(starts), np.uint64))
    held = lexical_search.Vocabulary(["one", "two", "six", "three"])
    data = np.frombuffer(b"two ten three one", np.uint8)
    words = lexical_search.Words(data, np.array([0, len(data)]))
    monkeypatch.setattr(words, "hashes", lambda: np.ones(4, np.uint64), raising=False)
    assert held.numbers(words).tolist() == [1, -1, 3, 0]
