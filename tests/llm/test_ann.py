import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.llm import ann


def table(spark, x, ids=None):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids if ids is not None else range(len(x)), x, strict=True)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("lengths", [(4, 3), (4, 2, 6), (4, 0)])
def test_vectors_of_several_lengths_are_an_error(spark, lengths):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=lengths[k % len(lengths)]).tolist()) for k in range(24)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    if 0 in lengths:  # a vector without components is all zero: it takes no part
        assert vectors.count() == 12 and ann.nearest(vectors, vectors, 2).count() == 24
        return
    with pytest.raises(ValueError, match="one length"):
        ann.nearest(vectors, vectors, 2)


def test_recall_beside_what_is_read(spark):
    """40,000 vectors around 300 places: nine of ten neighbours are found in less than a tenth of the vectors."""
    rng = np.random.default_rng(4)
    places = rng.normal(size=(300, 24)) * 2
    x = places[rng.integers(0, 300, 40_000)] + rng.normal(size=(40_000, 24)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = ann.usable(table(spark, x)).repartition(8)
    asked = vectors.where("vec_id % 400 = 0")
    rows, counts, bound = ann.banded(vectors)
    index = ann.build(rows, counts, bound)
    sizes = ann.posting_lists(rows, index).groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    read = ann.probed_lists(asked, index, ann.PROBES, ann.PRUNE).join(sizes, "list").agg(F.sum("n")).first()[0]
    assert read / (asked.count() * len(x)) < 0.1
    found = {(r["query_id"], r["vec_id"]) for r in ann.nearest(vectors, asked).collect()}
    want = set()
    for q in range(0, 40_000, 400):
        s = x @ x[q]
        s[q] = -np.inf
        want |= {(q, int(i)) for i in np.argsort(-s)[:20]}
    assert len(found) == len(want) and len(found & want) / len(want) >= 0.9


def test_centroids_reach_their_bound():
    """The sample is large enough for all centroids that the bound allows."""
    assert ann.SAMPLE >= ann.FIT * ann.CENTROIDS
