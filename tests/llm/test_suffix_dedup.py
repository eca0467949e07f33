import hashlib

import numpy as np
import pytest

from quillstream.llm import suffix_dedup


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    count = {}
    for d in data:
        for i in range(len(d) - length + 1):
            count[d[i : i + length]] = count.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(np.r_[False, gone].astype(int)) > 0).sum()), kept))
    return out


def hard_texts(seed, n=60, words=300):
    rng = np.random.default_rng(seed)
    letters = list("ab éß漢\x00\n")
    word = lambda: "".join(rng.choice(letters, rng.integers(1, 9)))
    passage = [" ".join(word() for _ in range(40)) for _ in range(4)]
    texts = []
    for _ in range(n):
        own = [word() for _ in range(rng.integers(0, words))]
        for p in rng.choice(passage, rng.integers(0, 3)):
            a, b = sorted(rng.integers(0, len(p), 2))
            own.insert(rng.integers(0, len(own) + 1), p if rng.random() < 0.5 else p[a:b])
        texts.append(" ".join(own))
    near = texts[0] or "x" * 99
    texts += [near[:k] + "#" + near[k + 1 :] for k in range(0, len(near), 37)]
    return [*texts, None, "", "", "aaaa" * 50, "a" * 37, "ab" * 100, texts[1], texts[1], "漢" * 60]


@pytest.mark.parametrize("length, gram, group", [(20, 5, 2048), (33, 8, 2048), (20, 5, 3), (40, 12, 1), (7, 7, 2)])
def test_dedup_equals_brute_force(spark, length, gram, group):
    texts = hard_texts(length, 30 if group < 9 else 60, 100 if group < 9 else 300)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, row string, key int").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.suffix_dedup(docs, length, gram, group=group).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, length)


def test_repeated_rows_and_null_ids(spark):
    own = "the quick brown fox jumps over the lazy dog and runs"
    rows = [(1, own)] * 3 + [(2, own + " away"), (None, own[:30]), (2**53 + 1, "another text that nobody else has at all"), (None, own[:30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"], bytes(r["kept"]).decode(), r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(docs, 20, 6).collect()), key=str)
    want = [(d, n, bytes(k).decode(), hashlib.sha256(k).hexdigest()) for (d, _), (_, n, _, k) in zip(rows, brute([t for _, t in rows], 20), strict=True)]
    assert got == sorted(want, key=str)


def test_dedup_of_nothing(spark):
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_are_sorted(seed):
    rng = np.random.default_rng(seed)
    length = int(rng.integers(1, 12))
    texts = [bytes(rng.choice([0, 97, 98, 255][: rng.integers(1, 5)], rng.integers(length, 80)).astype(np.uint8)) for _ in range(20)]
    size = np.array([len(t) for t in texts])
    starts = np.cumsum(np.r_[0, size[:-1] + 16])
    data = np.frombuffer(b"".join(t + bytes(16) for t in texts), np.uint8)
    order = suffix_dedup.suffix_order(data, starts, starts + size, length).tolist()
    of = {int(a) + i: t[i:] for a, t in zip(starts, texts, strict=True) for i in range(len(t))}
    assert len(set(order)) == len(order) and {p for p, s in of.items() if len(s) >= length} <= set(order)
    firsts = [of[p][:length] for p in order]
    assert firsts == sorted(firsts)


def test_windows_across_slices(monkeypatch):
    text = np.random.default_rng(0).integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 1700, 1710, 5000])
    whole = suffix_dedup.winnowed(text, offsets, 50, 9)
    monkeypatch.setattr(suffix_dedup, "_PLACE_BITS", 8)
    place, _, first, n = suffix_dedup.winnowed(text, offsets, 50, 9)
    for x in (whole[0], place):
        assert len(x) > 100
    windows = np.concatenate([np.arange(f, f + m) for f, m in zip(first, n, strict=True)])
    assert windows.tolist() == [*range(0, 1651), *range(1710, 4951)]
    assert ((np.repeat(place, n) - windows >= 0) & (np.repeat(place, n) - windows <= 41)).all()
