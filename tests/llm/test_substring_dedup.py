import hashlib
import random
import re
from collections import Counter

from quillstream.llm.substring_dedup import substring_dedup


def brute(rows, window):
    words = {i: re.findall("[^\x20\x09-\x0d]+", t or "") for i, t in rows}
    seen = Counter(tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: [rng.choice("ab cd é fg hi jk".split()) + str(rng.randrange(40)) for _ in range(n)]
    passage, license_line = word(60), word(36)
    rows = [(i, " ".join(word(rng.randrange(0, 90)) + (passage[: rng.randrange(30, 60)] if i % 3 == 0 else []) + (license_line if i % 2 else []) + word(rng.randrange(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "x " * 200), (104, "one"), (105, "a b " * 40), (106, rows[7][1]), (107, rows[7][1].replace(" ", "\n"))]
    rows += [(108, " ".join(word(3000) + passage)), (109, " ".join(word(34))), (-5, " ".join(word(35)))]
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, places string").repartition(5)
    for window, seed in ((35, 12), (8, 3)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring_dedup(docs, window, seed).collect()}
        assert got == brute(rows, window)
    assert sum(v[1] for v in brute(rows, 35).values()) > 500


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "w " * 50), (1, "w " * 50)], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(docs).collect()] == [50, 50]
    assert substring_dedup(docs.limit(0)).count() == 0


def test_shared_and_null_doc_ids(spark):
    """Rows with one doc_id, or none, are judged each by its own text."""
    rng = random.Random(9)
    word = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = word(40)
    texts = [f"{word(30)} {passage}", word(50), f"{passage} {word(5)}", word(36), "short one", f"{word(3)} {passage} {word(3)}"]
    ids = [1, 1, None, None, 1, 2**60 + 1]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    want = [(i, *brute(list(enumerate(texts)), 35)[n][:3]) for n, i in enumerate(ids)]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs).collect()]
    key = lambda r: (r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert [r[2] for r in want] == [40, 0, 40, 0, 0, 40]


def test_repeated_rows_cost_in_proportion(spark):
    """What is sent for a row that occurs n times does not depend on n, and each copy gets it once."""
    from pyspark.sql import functions as F

    from quillstream.llm.substring_dedup import distinct_rows, repeated_spans

    text, sizes = " ".join(f"w{k}" for k in range(60)), []
    for n in (8, 16, 32):
        rows = spark.range(n).select(F.lit(5).cast("long").alias("row"), F.lit(text).alias("text")).repartition(4)
        sizes.append(repeated_spans(distinct_rows(rows)).agg(F.sum(F.octet_length("places"))).first()[0])
    assert sizes[0] == sizes[1] == sizes[2] == 4 * 26
