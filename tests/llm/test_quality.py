import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quillstream.llm import quality
from quillstream.llm.textcore import column_bytes

GOOD = ["the", "study", "of", "rivers", "shows", "that", "water", "finds", "its", "way", "and", "shapes", "land"]


def texts(n, seed=1):
    """Prose, and as long lines of the same letters and marks in words of another kind."""
    rng = random.Random(seed)
    for i in range(n):
        words = rng.choices(GOOD if i % 2 else [w[::-1] for w in GOOD], k=rng.randrange(60, 300))
        yield i, " ".join(words), i % 2


def bags_of(rows):
    return quality.passages(*column_bytes(pa.array(rows)))


def model(seed=3):
    rng = np.random.default_rng(seed)
    shapes = {"E": (quality.N_FEATURES, quality.HIDDEN), "V": (quality.HIDDEN, quality.GATE), "U": (quality.HIDDEN, quality.GATE), "a": quality.GATE, "c": quality.HIDDEN, "T": (quality.WORDS, quality.HIDDEN), "e": quality.HIDDEN}
    w = {k: rng.normal(0, 0.4, s) for k, s in shapes.items()}
    return quality.Model(w | {"mean": np.zeros(quality.N_FEATURES), "scale": np.ones(quality.N_FEATURES), "b": np.array(0.1)})


def plain(m, bags):
    """Scores, a document and a passage at a time."""
    out, w = [], m.w
    for d in range(len(bags.first) - 1):
        h, s = [], []
        for p in range(bags.first[d], bags.first[d + 1]):
            words = bags.words[bags.word_at[p] : bags.word_at[p + 1]]
            lexical = sum((w["T"][i] for i in words), np.zeros(quality.HIDDEN)) / max(1, len(words))
            h.append(np.tanh(bags.x[p] @ w["E"] + lexical + w["e"]))
            s.append(float((np.tanh(h[-1] @ w["V"]) / (1 + np.exp(-(h[-1] @ w["U"])))) @ w["a"]))
        a = np.exp(np.array(s) - max(s))
        out.append(1 / (1 + math.exp(-float((a / a.sum()) @ np.array(h) @ w["c"] + w["b"]))))
    return np.array(out)


ROWS = ["one two three " * 40, "", None, "x", "A B c d " * 100, " \n\t"]


def test_forward_against_plain():
    bags, m = bags_of(ROWS), model()
    assert np.allclose(m.forward(bags)[0], plain(m, bags), atol=1e-12)
    assert len(bags.words) == 120 + 1 + 400 and np.diff(bags.first).tolist() == [3, 1, 1, 1, 9, 1]


@pytest.mark.parametrize("name", ["T", "E", "e", "V", "U", "a", "c", "b"])
def test_gradients_against_differences(name):
    bags, m, y = bags_of(ROWS), model(), np.array([1.0, 0, 1, 0, 0, 1])
    weight = np.array([1.0, 2, 1, 0.5, 1, 1])
    p, kept = m.forward(bags)
    grads = m.gradients(y, p, kept, weight)
    loss = lambda: float((-weight * (y * np.log(plain(m, bags)) + (1 - y) * np.log(1 - plain(m, bags)))).mean())
    flat, own = m.w[name].reshape(-1), np.asarray(grads[name]).reshape(-1)
    places = np.unique(np.r_[np.argsort(-np.abs(own))[:3], 0])
    for i in places:
        kept_value = flat[i]
        flat[i] = kept_value + 1e-5
        up = loss()
        flat[i] = kept_value - 1e-5
        down = loss()
        flat[i] = kept_value
        assert math.isclose((up - down) / 2e-5, own[i], rel_tol=1e-4, abs_tol=1e-7)


def test_tells_words_apart_on_held_out_rows(spark):
    """Both classes have the same letters and lengths: only the words tell. Rows beside the two columns are not read."""
    rows = list(texts(300))
    docs = spark.createDataFrame([(t, i, "x", 0.5) for i, t, _ in rows], "text string, doc_id long, quality string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 200] + [(5, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert all(got[i].predicted == y for i, _, y in rows if i >= 200)
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).count() == 0


def test_without_labels_and_on_odd_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "w " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and {r.n_passages for r in got} == {1, 4167}
    assert quality.keep_good(docs, quality.fit(docs, labels)).columns == docs.columns


def test_repeated_rows_are_learned_once(spark):
    rows = list(texts(60))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    again = once.unionByName(once.where("doc_id % 3 = 0")).unionByName(once.where("doc_id = 7")).repartition(3)
    scores = lambda model: sorted((r.doc_id, r.score) for r in quality.score(once, model).collect())
    assert scores(quality.fit(once, labels)) == scores(quality.fit(again, labels))
