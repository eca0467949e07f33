import random
import re

import pytest

from quillstream.llm import jaccard_join
from quillstream.llm.jaccard_join import jaccard_components


def brute(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    line, rows = words(12), []
    for _ in range(12):
        base = words(rng.choice([6, 9, 20, 40, 84, 110, 170, 330]))
        for _ in range(rng.randrange(1, 7)):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 18) + 1)):
                own[rng.randrange(len(own))] = rng.choice(words(1))
            rows.append(own[: len(own) - rng.randrange(0, len(own) // 6 + 1)])
    for k in range(40):  # boilerplate, alone and with a few words of their own
        rows.append(line + words(k % 9))
    for n in range(1, 60):
        rows.append(words(n))
    base = words(150)
    for k in range(50):  # a chain: each is near the next, few near the first
        rows.append(base[3 * k :] + words(3 * k))
    out = [(1000 - i, " ".join(r)) for i, r in enumerate(rows)]
    return out + [(1, None), (2, ""), (3, " \n"), (4, out[0][1].upper()), (5, out[0][1] + "\t"), (6, "é"), (7, "É"), (8, "a b c d"), (9, "A B C D"), (10, "a b c d e")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id long, set_id int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) < len(rows) - 20


def test_late_rounds_take_the_sets_of_their_pairs_only(spark, monkeypatch):
    rows, calls = corpus(1), []

    def linked(pairs, sets, percent, size, plain=jaccard_join.linked):
        calls.append((pairs.count(), sets.count()))
        return plain(pairs, sets, percent, size)

    monkeypatch.setattr(jaccard_join, "linked", linked)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()} == brute(rows)
    late = [(pairs, sets) for pairs, sets in calls if 4 * pairs < calls[0][1]]
    assert late and all(sets <= 2 * pairs for pairs, sets in late)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_and_null_ids_with_near_copies(spark):
    rng = random.Random(3)
    words = lambda: [f"w{rng.randrange(400)}" for _ in range(120)]
    a, b, c = words(), words(), words()
    near = lambda w: " ".join(w[:-2])
    rows = [(1, " ".join(a)), (1, " ".join(a)), (2, near(a)), (3, " ".join(a)), (None, " ".join(b)), (None, " ".join(b)), (7, near(b)), (None, " ".join(c)), (None, near(c)), (2**60 + 1, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id or -1), r.component_id or -1) for r in jaccard_components(docs).collect())
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (-1, 7), (-1, 7), (7, 7), (-1, -1), (-1, -1), (2**60 + 1, 2**60 + 1)])
