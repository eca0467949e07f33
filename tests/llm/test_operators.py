"""Small checks of the other operators: libraries, brute force, round trips and the edge cases each docstring states."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillstream.llm import ann, exact_dedup, html_text, lm_scoring, packing, sentencepiece_codec, textcore, warc

TEXTS = ["  a  b\nc  ", "", None, "don't it's 'twas x's 12ab3   z y \t\n q", "日本語 テキスト 🙂a", "...'s x", "the the THE", "x" * 5000, "word " * 3000, "é x  y", "<|endoftext|> hi"]


def table(spark, texts=TEXTS, first=0):
    rows = [(t, i + first, "ids", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "text string, doc_id long, source string, piece int").repartition(3)


def encoded(function):
    data, offsets = textcore.column_bytes(pa.array(TEXTS))
    ids, at = function(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_word_and_window_hashes():
    data, offsets = textcore.column_bytes(pa.array(TEXTS))
    words = textcore.Words(data, offsets, lower=True)
    want = [w for t in TEXTS for w in re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    assert [words.text(i) for i in range(len(words.starts))] == want
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(want))
    at, three = words.windows(hashes, 3)
    grams = [tuple(want[i : i + 3]) for i in at.tolist()]
    assert len(set(three.tolist())) == len(set(grams))


def test_byte_bpe_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    cache = packing.bpe_cache("byte_bpe_50k.tiktoken")
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoded(lambda d, o: packing.token_ids(d, o, cache)) == [model.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_sentencepiece_merges_equal_the_library_and_both_decode():
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
    assert encoded(lambda d, o: sentencepiece_codec.encode_block(d, o, algorithm="merges")) == [sp.encode(t or "") for t in TEXTS]
    data, offsets = textcore.column_bytes(pa.array(TEXTS))
    for algorithm in sentencepiece_codec.ALGORITHMS:
        back, at = sentencepiece_codec.decode_block(*sentencepiece_codec.encode_block(data, offsets, algorithm=algorithm))
        assert np.array_equal(back, data) and np.array_equal(at, offsets)


def test_sentencepiece_long_words():
    """One word of many characters: the same ids as words together, as the library's merges, and in little time."""
    import time

    import public_tokenizers
    import sentencepiece

    rng = random.Random(2)
    words = ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet, n in (("abcdefgh0123", 90), ("日本語テキスト漢字", 120), ("aé🙂 ", 70), ("ab", 200))]
    words = [" " + w.replace(" ", "") for w in words]
    model = sentencepiece_codec.Pieces(sentencepiece_codec.MODEL)
    for algorithm, function in sentencepiece_codec.ALGORITHMS.items():
        long = function(model, words)
        sentencepiece_codec.LONG, kept = 10**6, sentencepiece_codec.LONG
        try:
            together = function(model, words)
        finally:
            sentencepiece_codec.LONG = kept
        assert all(np.array_equal(a, b) for a, b in zip(long, together)), algorithm
    whole = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(100_000))
    data, offsets = textcore.column_bytes(pa.array([whole]))
    began = time.time()
    ids = {a: sentencepiece_codec.encode_block(data, offsets, algorithm=a)[0] for a in sentencepiece_codec.ALGORITHMS}
    assert time.time() - began < 60
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
    assert ids["merges"].tolist() == sp.encode(whole)


def test_viterbi_is_the_best_of_all_segmentations():
    model = sentencepiece_codec.Pieces(sentencepiece_codec.MODEL)
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
    score = {sp.id_to_piece(i).replace("▁", " "): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}

    def best(word):
        total = [0.0] + [-math.inf] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(j):
                s = score.get(word[i:j], min(score.values()) - sentencepiece_codec.UNKNOWN_PENALTY if j - i == 1 else -math.inf)
                total[j] = max(total[j], total[i] + s)
        return total[-1]

    words = [" hello", " tokenisation", " anendar", "日本", " q\n", "aaaaaaa"]
    n, ids = sentencepiece_codec.viterbi(model, words)
    at = 0
    for word, k in zip(words, n.tolist()):
        pieces = [sp.id_to_piece(i) for i in ids[at : at + k].tolist()]
        at += k
        if not any(p.startswith("<0x") for p in pieces):
            assert "".join(pieces).replace("▁", " ") == word
            assert math.isclose(sum(score[p.replace("▁", " ")] for p in pieces), best(word))


def test_encode_and_decode_frames(spark):
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark)))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert all(r.round_trip for r in sentencepiece_codec.encode_report(table(spark)).collect())
    assert sentencepiece_codec.encode(table(spark).limit(0)).count() == 0


def test_packing(spark):
    rows = packing.pack_documents(table(spark), with_ids=True).collect()
    docs = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        own = docs.setdefault(r.doc_id, [])
        assert r.start == len(own) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.piece == 0 or r.length == 1024
        own += r.ids
    cache = packing.bpe_cache("byte_bpe_50k.tiktoken")
    assert [docs[i][:-1] for i in range(len(TEXTS))] == encoded(lambda d, o: packing.token_ids(d, o, cache)) and all(d[-1] == 2 for d in docs.values())
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(table(spark).limit(0)).count() == 0


def test_slack_plan_finds_full_bins():
    rng = random.Random(2)
    for _ in range(20):
        histogram = Counter(rng.randrange(1, 65) for _ in range(rng.randrange(1, 400)))
        plan = packing.slack_plan(histogram, 64)
        place, used = {}, {}
        for length, a, b, sequence, copies, offset in plan:
            for rank in range(a, b):
                key = sequence + (rank - a) // copies
                place[length, rank] = key
                used[key] = used.get(key, 0) + length
        assert Counter(k[0] for k in place) == histogram and max(used.values()) <= 64
        assert len(used) <= -(-sum(k * v for k, v in histogram.items()) // 64) + 2 + sum(v for k, v in histogram.items() if k > 32) // 2
    assert packing.fullest(np.array([0, 0, 0, 2, 0, 1, 0, 1]), 11) == [3, 3, 5] or sum(packing.fullest(np.array([0, 0, 0, 2, 0, 1, 0, 1]), 11)) == 11


def test_exact_dedup(spark):
    texts = ["Same", "SAME", "same", None, "", "É", "é", "other"] + ["hot"] * 40
    rows = exact_dedup.exact_dedup(table(spark, texts)).collect()
    got = {r.doc_id: (r.keep_id, r.smallest_id, r.group_size, r.kept, r.text_sha256) for r in rows}
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    for i, t in enumerate(low):
        group = [j for j, u in enumerate(low) if u == t]
        assert got[i] == (max(group), min(group), len(group), i == max(group), hashlib.sha256(t.encode()).hexdigest())
    assert len(rows) == len(texts) and exact_dedup.exact_dedup(table(spark).limit(0)).count() == 0
    twice = exact_dedup.exact_dedup(spark.createDataFrame([(1, "a"), (1, "a"), (None, "n")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.group_size, r.kept) for r in twice) == [(-1, 1, True), (1, 2, True), (1, 2, True)]


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class="ad">Buy this thing now please</div>
<article><h1>Title &amp; more</h1><p>First <b>para</b>&nbsp;has\n words.<p>Second &lt;one&gt; is here.<script>var a = "</p>";</script></p><ul><li>A point of the list</li></ul></article><footer>&copy; us and them</footer></body></html>"""


def test_html_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<p>only words, no markup of note</p>", 1), (4, "u", "<p>only words, no markup of note</p>", 1), (5, "u", "<p>cut <b", 1)], "page_id long, url string, html string, text int")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(pages, html_text.fit(pages)).collect()]
    want = "Title & more\n\nFirst para has words.\n\nSecond <one> is here.\n\nA point of the list"
    assert dict((a, b) for a, b, _ in got) == {1: want, 2: "", 3: "", 4: "only words, no markup of note", 5: "cut"} and len(got) == 6
    assert all(n == len(t) for _, t, n in got)
    assert html_text.extract(pages.limit(0), html_text.log_odds({})).count() == 0


def test_html_text_keeps_an_articles_own_sections(spark):
    page = """<body><article><h1 id="search-methods">Search methods of note</h1><section id="related-work"><p>Earlier work on this.</p></section>
<div class="share-bar">Tell your friends</div><p class="intro">Closing words of the piece.</p></article></body>"""
    text = html_text.main_text(page, html_text.log_odds({}))
    assert "Search methods of note" in text and "Earlier work on this." in text and "Closing words" in text and "friends" not in text


def test_html_text_best_run_is_the_maximum_sum():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-3.5, -1.0, -0.25, 0.0, 0.5, 2.0, 4.25]) for _ in range(rng.randrange(0, 12))]
        runs = [(sum(scores[a:b]), -a, -b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        best = max(runs, default=(0.0, 0, 0))
        a, b = html_text.best_run(scores)
        assert sum(scores[a:b]) == max(best[0], 0.0)
        if best[0] > 0:
            assert (-a, -b) in [r[1:] for r in runs if r[0] == best[0]]


def test_html_text_learned_weights_decide(spark):
    """Boxes whose class says nothing are left out where labelled pages have them outside their content; also on pages
    without an article element, and on a very long one."""
    page = lambda tag, n: f"<body><div class='zq7'>{'box words ' * 15}</div><{tag}><h1>Head line</h1>{'<p>Some words of the piece.</p>' * n}</{tag}><div class='zq7'>{'box words ' * 15}</div></body>"
    pages = spark.createDataFrame([(i, "u", page("article", 4)) for i in range(20)] + [(90, "u", page("section", 4)), (91, "u", page("article", 20_000))], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, html_text.fit(pages)).collect()}
    want = lambda n: "\n\n".join(["Head line", *["Some words of the piece."] * n])
    assert got[0] == got[90] == want(4) and got[91] == want(20_000)
    assert "box words" in html_text.main_text(page("section", 4), html_text.log_odds({}))


def test_lm_scores_base_and_model(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "of", "And", "tion", "qué", "zu"]) for _ in range(rng.randrange(0, 60))) for _ in range(60)] + [None, "", "neverseen words", "x " * 3000]
    docs = table(spark, texts)
    learn = [i for i in range(len(texts)) if i % 4]
    rows = {r.doc_id: r for r in lm_scoring.lm_scores(docs, docs.doc_id % 4 != 0, steps=200).collect()}
    tokens = [[*re.findall("[^\x20\x09-\x0d]+", (t or "").lower()), None] for t in texts]
    count = Counter(w for i in learn for w in tokens[i])
    total, kinds = sum(count.values()), len(count)
    for i, own in enumerate(tokens):
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert math.isclose(rows[i].base_score, base, rel_tol=1e-9)
        assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (len(own), sum(count[w] > 0 for w in own), total)
        assert rows[i].score < 0
    seen = [i for i in range(60) if len(tokens[i]) > 20]
    assert sum(rows[i].score for i in seen) / sum(len(tokens[i]) for i in seen) > -1.3


def test_lm_spellings_use_every_triple(spark):
    """Each word's spelling against plain counts of all triples, those met once included; rows that repeat are scored alike."""
    texts = ["alpha betatron gammaray"] * 3 + ["zyxwvut quetzalcoatl", "alphabet unseenword alpha", "quetzal zyxw"]
    docs = spark.createDataFrame([(i, t, i < 5) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    words = lm_scoring.spellings(docs).collect()
    ids = {r.word: np.frombuffer(r.ids, "<u2").tolist() for r in words}
    end, count = lm_scoring.END, Counter()
    triples = lambda w: list(zip([end, *w[:-1]], w, [*w[1:], end]))
    for r in words:
        for t in triples(ids[r.word]):
            count[t] += r.n
    count = {t: n for t, n in count.items() if n}
    back = Counter(t[2] for t in count)
    pair = Counter()
    for t, n in count.items():
        pair[t[1:]] += min(n, 3)

    def p(a, b, c):
        q = (back[c] + 0.02) / (len(count) + 0.02 * lm_scoring.N_IDS)
        own = {k: n for k, n in pair.items() if k[0] == b}
        q = (max(pair[b, c] - 0.75, 0) + (0.75 * len(own) + 0.5) * q) / (sum(own.values()) + 0.5)
        own = {k: n for k, n in count.items() if k[:2] == (a, b)}
        return (max(count.get((a, b, c), 0) - 0.75, 0) + (0.75 * len(own) + 0.5) * q) / (sum(own.values()) + 0.5)

    assert min(count.values()) == 1
    got = {r.word: r.spelling for r in lm_scoring.spelled(lm_scoring.spellings(docs)).collect()}
    assert got.keys() == ids.keys()
    assert all(math.isclose(got[w], sum(math.log10(p(*t)) for t in triples(ids[w])), rel_tol=1e-9) for w in ids)


def test_lm_layer_learns_from_whole_texts_and_all_of_them(spark):
    texts = ["the of " * 3000 + "zebra the"] + ["the of"] * 2000 + ["xylophone the"]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, train boolean").repartition(4)
    words = lm_scoring.spellings(docs)
    speller = lm_scoring.Speller(lm_scoring.first_counts(words, len(texts)))
    met = sorted({i for r in words.collect() for i in np.frombuffer(r.ids, "<u2").tolist()})
    model = lm_scoring.train(docs, speller.klass, 2200, steps=10, rounds=2)
    fresh, now = lm_scoring.Attention.fresh().w["emb"], model.w["emb"]
    assert len(met) > 3 and all((fresh[i] != now[i]).any() for i in met)


def test_lm_repeated_rows_are_scored_alike(spark):
    rows = [(1, "some words here"), (1, "some words here"), (1, "other text"), (None, "some words here"), (2, "some words here")]
    got = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), steps=5).collect()
    same = [r for r in got if r.n_tokens == 4]
    assert len(got) == 5 and len(same) == 4
    assert max(r.score for r in same) - min(r.score for r in same) < 1e-4 and max(r.base_score for r in same) - min(r.base_score for r in same) < 1e-9
    assert {r.n_known for r in same} == {4}


def test_lm_rare_words_are_dealt_and_hot_ones_looked_up_alike(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "of", *(f"w{rng.randrange(90)}" for _ in range(3))]) for _ in range(rng.randrange(0, 80))) for _ in range(50)]
    docs = table(spark, [*texts, texts[3], None, "only unseen words"]).coalesce(1)
    own = lambda hot: {r.doc_id: r for r in lm_scoring.lm_scores(docs, docs.doc_id < 45, steps=5, hot=hot).collect()}
    few, all_hot = own(4), own(10**6)
    assert few.keys() == all_hot.keys() == set(range(53))
    for i, r in few.items():
        assert r.n_known == all_hot[i].n_known and math.isclose(r.base_score, all_hot[i].base_score, rel_tol=1e-9) and math.isclose(r.score, all_hot[i].score, rel_tol=1e-6)


def test_lm_model_scores_against_window_by_window():
    rng = random.Random(4)
    texts = ["", "one", " ".join(rng.choice(["the", "of", "xylo", "Tion"]) for _ in range(31)), " ".join(rng.choice(["the", "of", "xylo"]) for _ in range(150))]
    data, offsets = textcore.column_bytes(pa.array(texts))
    s = lm_scoring.Spelled(data, offsets)
    model, speller = lm_scoring.Attention.fresh(), lm_scoring.Speller(np.bincount(s.first_id, minlength=lm_scoring.N_IDS).astype(float))
    context, overlap = lm_scoring.CONTEXT, lm_scoring.OVERLAP
    cache = packing.bpe_cache(lm_scoring.VOCABULARY)
    for text, got in zip(texts, lm_scoring.model_scores(s, model, speller)):
        spelled = [cache.encode([" " + w])[1].tolist() for w in text.lower().split()]
        inputs = [model.w["emb"][[lm_scoring.END]].mean(0), *(model.w["emb"][ids].mean(0) for ids in spelled)]
        targets, total = [*(ids[0] for ids in spelled), lm_scoring.END], 0.0
        for place, target in enumerate(targets):
            # The first window in which the place has OVERLAP places before it, or the text's first one.
            begin = 0 if place < context else ((place - overlap) // (context - overlap)) * (context - overlap)
            x = np.zeros((1, context, lm_scoring.WIDTH), np.float32)
            seen = inputs[begin : begin + context]
            x[0, : len(seen)] = seen
            total += model.forward(x)[0][0, place - begin, speller.klass[target]] / math.log(10) + speller.within[target]
        assert math.isclose(got, total, rel_tol=1e-4), text[:20]


def test_lm_probabilities_sum_to_one_over_classes():
    model = lm_scoring.Attention.fresh()
    x = np.random.default_rng(1).normal(size=(3, lm_scoring.CONTEXT, lm_scoring.WIDTH)).astype(np.float32)
    o, _ = model.forward(x)
    assert np.allclose(np.exp(o).sum(-1), 1, atol=1e-4)
    w, p = np.nonzero(np.ones((3, lm_scoring.CONTEXT), bool))
    target = np.random.default_rng(2).integers(0, lm_scoring.CLASSES, len(w))
    assert np.allclose(model.scored(x, w, p, target), o[w, p, target] / math.log(10), atol=1e-4)
    later = x.copy()
    later[:, 20:] += 1
    assert np.allclose(model.forward(later)[0][:, :20], o[:, :20], atol=1e-5)  # causal
    for length in range(1, 200):
        step = lm_scoring.CONTEXT - lm_scoring.OVERLAP
        scored = [s + p for k, s in enumerate(lm_scoring.windows(length)) for p in range(lm_scoring.OVERLAP if k else 0, lm_scoring.CONTEXT) if s + p < length]
        assert scored == list(range(length)) and len(lm_scoring.windows(length)) == max(1, -(-(length - lm_scoring.OVERLAP) // step))


def test_lm_layer_gradients_against_differences():
    rng = np.random.default_rng(3)
    model = lm_scoring.Attention({k: v * np.float32(0.5) for k, v in lm_scoring.Attention.fresh().w.items()})
    x = rng.normal(size=(2, lm_scoring.CONTEXT, lm_scoring.WIDTH)).astype(np.float32)
    target = rng.integers(0, lm_scoring.CLASSES, x.shape[:2])
    valid = np.arange(lm_scoring.CONTEXT) < np.array([[32], [9]])
    loss = lambda x: -np.take_along_axis(model.forward(x)[0].astype(float), target[:, :, None], 2)[:, :, 0][valid].mean()
    grads, dx = model.gradients(*model.places(x), target, valid)
    assert set(grads) == set(model.w) - {"emb"}
    for name, own, g in [*((k, model.w[k], g) for k, g in grads.items()), ("x", x, dx.reshape(x.shape))]:
        # Along the gradient and half as far along a random way: float32 losses tell too little along a random one alone.
        random_way = rng.normal(size=own.shape)
        way = (g / np.linalg.norm(g) + 0.5 * random_way / np.linalg.norm(random_way)).astype(np.float32)
        held, losses = own.copy(), []
        for step in (0.05, -0.05):
            own[...] = held + np.float32(step) * way
            losses.append(loss(x))
        own[...] = held
        assert math.isclose((losses[0] - losses[1]) / 0.1, float((g * way).sum()), rel_tol=0.01), name


def test_lm_words_are_encoded_together_as_each_alone(monkeypatch):
    """New words of a block go to the encoder as one text; white space inside words, marks and long words change nothing."""
    rng = random.Random(9)
    letters = ["a", "B", "7", "'", "'s", "é", "漢", "\u3000", "\xa0", "\x85", "\u2028", "\x1c", "\x00", "-", "…", "😀", "<|endoftext|>"]
    words = list(dict.fromkeys("".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(3000))) + ["q" * 3000, "ab1" * 700]
    plain = [f"word{i}" for i in range(500)]
    cache = packing.bpe_cache(lm_scoring.VOCABULARY, lm_scoring.WORDS_HELD)
    for own in (words, plain):
        calls = []
        cache._clear()
        with monkeypatch.context() as patch:
            patch.setattr(type(cache.model), "encode_ordinary", lambda self, t, plain=type(cache.model).encode_ordinary: calls.append(t) or plain(self, t))
            s = lm_scoring.Spelled(*textcore.column_bytes(pa.array([" ".join(own), "\t".join(own[::-1])])))
        assert len(calls) == 1 or own is words
        at = s.which[: len(own)]
        for i, w in zip(at.tolist(), own, strict=True):
            assert s.flat[s.begin[i] : s.begin[i] + s.n[i]].tolist() == cache.model.encode_ordinary(" " + w.lower() if w.isascii() else " " + "".join(c.lower() if c.isascii() else c for c in w)), repr(w)
    emb = lm_scoring.Attention.fresh()
    at, n = s.begin[s.which], s.n[s.which]
    assert np.allclose(emb.embedded(at, n, s.flat), [emb.w["emb"][s.flat[a : a + k]].mean(0) for a, k in zip(at, n, strict=True)], atol=1e-6)
    long = lm_scoring.Spelled(*textcore.column_bytes(pa.array([" ".join(words)])))
    at, n = long.begin[long.which], long.n[long.which]
    assert n.max() > 100 and np.allclose(emb.embedded(at, n, long.flat), [emb.w["emb"][long.flat[a : a + k]].astype(float).mean(0) for a, k in zip(at, n, strict=True)], atol=1e-4)


@pytest.mark.parametrize("n", [15, 1500])
def test_ann_recall(spark, n):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(n, 8)) + rng.integers(0, 3, (n, 1)) * 2).round(3)
    x[3] = x[4]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(9001, None), (9002, [0.0] * 8), (9003, [float("nan")] + [1.0] * 7), (9004, [None] + [1.0] * 7)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    assert vectors.count() == n
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 5 = 0"), k=10).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    found = total = 0
    for q in range(0, n, 5):
        s = x @ x[q]
        order = [int(i) for i in np.lexsort((np.arange(n), -s)) if i != q][:10]
        ranked = [got[q][k] for k in sorted(got[q])]
        assert sorted(got[q]) == list(range(1, len(ranked) + 1)) and all(math.isclose(s[i], v) for i, v in ranked)
        assert [v for _, v in ranked] == sorted((v for _, v in ranked), reverse=True)
        found += len({i for i, _ in ranked} & set(order))
        total += len(order)
    assert found >= 0.9 * total and (n > 100 or found == total)
    assert ann.nearest(vectors.limit(0), vectors, k=3).count() == 0


def test_ann_recall_on_skewed_norms(spark, monkeypatch):
    """Some vectors of large norm, which hide all others in one lifted space; few of many lists are read."""
    monkeypatch.setattr(ann.build, "__defaults__", (ann.SAMPLE, 40))
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[rng.random(3000) < 0.06] *= 8
    vectors = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, vector array<double>").repartition(4)
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 30 = 0"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    found = 0
    for q in range(0, 3000, 30):
        s = x @ x[q]
        s[q] = -np.inf
        found += len(set(np.argsort(-s)[:20].tolist()) & got[q])
        assert len(got[q]) == 20
    assert found >= 0.9 * 2000


def test_ann_gives_k_hits_to_outliers_and_duplicates(spark, monkeypatch):
    """Lists that hold fewer than k vectors: those near a query are not all that it gets."""
    monkeypatch.setattr(ann, "LIST", 20)
    monkeypatch.setattr(ann.build, "__defaults__", (ann.SAMPLE, 20))
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(size=(400, 6)) + 5, np.tile([[-90.0, 0, 0, 0, 0, 0]], (3, 1)), [[0, 0, -70.0, 0, 0, 0]]].round(3)
    vectors = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, vector array<double>").repartition(4)
    got = ann.nearest(vectors, vectors.where("vec_id >= 395"), k=10, probes=1, prune=1.0).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {i: 10 for i in range(395, len(x))}


def test_warc_round_trip(spark, tmp_path):
    long = "<p>" + "payload é " * 30
    pages = spark.createDataFrame([(5, "http://x/ a", long, 1), (2, "u", long, 1), (9, None, long, 1), (7, "u", "short", 1), (8, "u", "short", 1), (3, "u", None, 1), (4, "u", "x" * 300000, 1), (4, "u", "x" * 300000, 1)], "page_id long, url string, html string, records int")
    rows = warc.archived(pages, f"file://{tmp_path}/w").collect()
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    assert got == sorted([(2, "response", None, len(long.encode())), (5, "revisit", 2, len(long.encode())), (9, "revisit", 2, len(long.encode())), (7, "response", None, 5), (8, "response", None, 5), (3, "response", None, 0)] + [(4, "response", None, 300000)] * 2, key=lambda t: t)
    assert {r.page_id: r.html for r in rows if r.record_type == "response"}[2] == long
    assert all(r.payload_digest == hashlib.sha256(long.encode()).hexdigest() for r in rows if r.page_id in (2, 5, 9))
    files = list(tmp_path.glob("w/members-*.gz"))
    assert files and not list(tmp_path.glob("w/archive-*"))
    import gzip

    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC/1.1\r\n") == 8
    assert warc.archived(pages.limit(0), f"file://{tmp_path}/v").count() == 0


def test_warc_sources_outlive_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}") for i in range(6)], "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(warc.records_of(pages), folder, 1)
    sources, seen = len(list(tmp_path.glob("w/archive-*"))), []
    store = warc.written
    monkeypatch.setattr(warc, "written", lambda df, name: (store(df, name), seen.append(len(list(tmp_path.glob("w/archive-*")))))[0])
    members = warc.normalise(manifest, folder)
    assert sources == 6 and seen == [6]  # all there when the manifest of members is written
    assert not list(tmp_path.glob("w/archive-*")) and members.count() == 6


def test_warc_broken_stream():
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"])))


@pytest.mark.parametrize("name, kept", [("share-price", True), ("related-work", True), ("search-results", True), ("notice-period", True), ("widget-design", True), ("related-posts", False), ("share-buttons", False), ("comments", False), ("ad-slot", False), ("newsletter-signup", False), ("cookie_notice", False)])
def test_html_text_keeps_topics_named_by_classes(name, kept):
    page = f"<body><nav>menu</nav><article><h1>Title</h1><p>first words of it</p><div class='big {name}'><p>words in the part</p></div><p>last words of it</p></article></body>"
    text = html_text.main_text(page, html_text.log_odds({}))
    assert text == "\n\n".join(["Title", "first words of it", *(["words in the part"] if kept else []), "last words of it"])
