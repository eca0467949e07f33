import corpus_pipeline
from quillstream.llm import quality


def test_stages_keep_what_they_should(spark, tmp_path):
    """Each stage against a plain version of itself on a small fixture."""
    import random

    from tests.llm.test_jaccard_join import brute as near
    from tests.llm.test_substring_dedup import brute as repeats

    rng = random.Random(4)
    words = lambda n: [rng.choice("the of and to in is on that with era tion".split()) + str(rng.randrange(30)) for _ in range(n)]
    good = [" ".join(words(rng.randrange(40, 200))) for _ in range(60)]
    good += [good[0], good[1].upper().replace("\n", " "), good[2] + " extra", good[3] + " more words"]
    passage = " ".join(words(60))
    good += [" ".join(words(80)) + " " + passage, passage + " " + " ".join(words(90))]
    bad = [" ".join(w + "&&&" for w in words(rng.randrange(40, 120))) for _ in range(30)]
    rows = [(i, t, "en", "s", len(t), "x") for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string")
    labels = spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(rows))], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")
        seen.append(now.collect())
        if k < 4:
            assert now.columns == docs.columns
    texts = [{r.doc_id: r.text for r in s} for s in seen[:4]]
    assert set(texts[0]) == set(range(len(good)))
    lower = {}
    for i, t in texts[0].items():
        lower[t.lower()] = max(i, lower.get(t.lower(), -1))
    assert set(texts[1]) == set(lower.values()) and len(texts[1]) == len(texts[0]) - 2
    links = near(list(texts[1].items()))
    assert set(texts[2]) == {c for _, c in links.values()} and len(texts[2]) == len(texts[1]) - 2
    want = repeats(list(texts[2].items()), 35)
    assert texts[3] == {i: want[i][3] if want[i][1] else t for i, t in texts[2].items()}
    assert sum(want[i][1] > 0 for i in want) == 2
    assert all(r.n_chars == len(r.text) for r in seen[3])
    assert {r.doc_id for r in seen[4]} == set(texts[3])
    assert {(r.doc_id, r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {(r.doc_id, r.sequence_id, r.offset) for r in seen[4]}


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "fine words here"), (3, "fine words here")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs.limit(0), model).count() == 0


def test_repeated_rows_and_null_ids_keep_one_copy(spark, tmp_path):
    import random

    rng = random.Random(6)
    words = lambda n=90: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    a, b, c, d, e = (words() for _ in range(5))
    rows = [(1, a), (1, a), (2, b), (5, b), (5, c), (None, d), (None, e), (None, e), (8, a + " more"), (None, d + " more"), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long").repartition(3)
    corpus_pipeline.drop_copies(spark, docs, "").write.parquet(f"{tmp_path}/once")
    once = spark.read.parquet(f"{tmp_path}/once")
    key = lambda rows: sorted((r.doc_id or -1, r.text or "") for r in rows)
    want = [(1, a), (5, b), (5, c), (None, d), (None, e), (8, a + " more"), (None, d + " more"), (9, "")]
    assert once.columns == docs.columns and key(once.collect()) == sorted((i or -1, t) for i, t in want)
    one = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    got = key(one)
    assert [g for g in got if g[0] != -1] == sorted([(1, a), (5, c), (9, ""), (2, b)])
    assert len(got) == 6 and (-1, e) in got and sum(t in (d, d + " more") for _, t in got) == 1
    corpus_pipeline.drop_near_copies(spark, once, "").write.parquet(f"{tmp_path}/one")
    out = corpus_pipeline.cut_repeats(spark, spark.read.parquet(f"{tmp_path}/one"), "").collect()
    assert {(r.doc_id or -1, r.text or "") for r in out} >= {(1, a), (5, b), (5, c), (-1, e), (9, "")} and len(out) == 6


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, and columns named as the stages' own, with null and very long texts: nothing is lost or renamed."""
    import random

    rng = random.Random(7)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    names = ["_key", "_row", "_run", "set_id", "component", "row", "places", "bucket", "spans", "label", "x.y"]
    rows = [(i, t, len(t or ""), *(f"{n}{i}" for n in names)) for i, t in enumerate([None, "", long, "one two three four five six", "ONE two three four five six"])]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(2)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {1: {"", long, "ONE two three four five six"}, 2: {None, "", long, "one two three four five six"}, 3: {None, "", long, "one two three four five six", "ONE two three four five six"}}
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        assert function(spark, docs.limit(0), str(tmp_path)).count() == 0
        out = function(spark, docs, str(tmp_path))
        if 0 < k < 4:
            got = out.collect()
            assert out.columns == docs.columns and {r.text for r in got} - {None} == want[k] - {None}
            assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)
    assert {r.doc_id for r in out.collect()} == {0, 1, 2, 3, 4}
