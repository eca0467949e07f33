"""Scoring texts with a causal self-attention model over subword ids, and with a word-count base.

The model. A text is its lower-cased words and an end token. Every word is spelled in subword ids of a public
byte-level BPE; a position's input is the mean of its word's subword embeddings. One causal self-attention layer over
a window of positions predicts the next word: a softmax over classes of first subwords, the first subword within its
class, then each further subword (or the word's end) given the two before it. All parameters and all counts are learned
from every training text; the rest is smoothed, so no text has probability 0.
Windows overlap by OVERLAP places; each position is scored once, in the first window that it has that much context in.

The layer is trained in rounds: every training text is read whole in one of them, tasks start from the same weights, and
what they changed is averaged in the cluster, so that only arrays of the model's size reach the driver.

The counts of whole words and of subword triples grow with the corpus: they are tables dealt by hash, none left out, and
never gathered in one place. Each distinct word's spelling is scored by joins with the triples. Words that make up more
than one in HOT of all words are looked up in a broadcast table of at most HOT rows; the others, which no key can be hot
among, are dealt by word, looked up in buckets, and dealt back by document: one entry for each document and such word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.packing import bpe_cache
from quillstream.llm.stage import fold, to_buckets, written
from quillstream.llm.textcore import Words, blocks, ragged

VOCABULARY, N_IDS = "byte_bpe_50k.tiktoken", 50257
END = 50256  # free in this vocabulary: the end token, and the end of a word
CLASSES, WIDTH, CONTEXT, OVERLAP = 96, 16, 32, 16
BATCH, STEPS, ROUNDS = 128, 1_250, 4  # windows of a step; steps that small corpora are passed over for; rounds of large ones
BLOCK, FLUSH = 1 << 19, 1 << 19  # bytes of text, and rare words, that a task holds at a time
SCORED_AT_ONCE = 512  # windows
ONES = np.ones(max(CLASSES, CONTEXT), np.float32)
MOST = 60.0  # logits are held within this, either way, so that no exponential overflows
WORDS_HELD = 3_000_000  # spelled words that a worker keeps from one task to the next, of some 50 bytes each
CHUNK = 1_024  # embeddings that are averaged together
HOT = 250_000  # most words in the broadcast table: those with one in HOT of all occurrences, or more


class Spelled:
    """Lower-cased words of some rows: `words` and their `hashes`; for each distinct word (`which` tells a word's) its
    subwords (flat, with n of each) and how often it occurs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(data, offsets, lower=True)
        self.hashes = words.hashes()
        cache = bpe_cache(VOCABULARY, WORDS_HELD)
        together = lambda new: cache.encode_words(words.data, words.starts[new], words.ends[new])
        _, one, at, self.n, self.which = cache.distinct(self.hashes ^ np.uint64(0x5851F42D4C957F2D), encode=together)
        self.times = np.bincount(self.which, minlength=len(one))
        self.kind_hashes = self.hashes[one]
        self.flat = cache.ids[ragged(at, self.n)].astype(np.int64)
        self.begin = np.cumsum(self.n) - self.n
        self.first_id = self.flat[self.begin][self.which] if len(one) else np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for a, b, data, offsets in blocks(batch, "text", most=BLOCK):
            yield batch, a, b, Spelled(data, offsets)


def _triples(begin: np.ndarray, n: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """(id before or END, id, next id or END) as one number, for every subword of words."""
    if not len(flat):
        return np.zeros(0, np.int64)
    before, after = np.r_[END, flat[:-1]], np.append(flat[1:], END)
    before[begin] = END
    after[begin + n - 1] = END
    return (before * N_IDS + flat) * N_IDS + after


def spellings(docs: DataFrame) -> DataFrame:
    """(word, ids, n, n_all): the hash of every distinct word of docs(doc_id, text, train, ..), its subwords, and how often
    it occurs in training texts and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def merged() -> tuple:
            key, n, n_all, size, flat = (np.concatenate(x) for x in zip(*held, strict=True))
            own, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            total, total_all = (np.bincount(inverse, x, len(own)).astype(np.int64) for x in (n, n_all))
            return own, total, total_all, size[first], flat[ragged((np.cumsum(size) - size)[first], size[first])]

        def rows() -> Iterator[pa.RecordBatch]:
            key, n, n_all, size, flat = merged()
            ends = np.r_[0, np.cumsum(size)]
            for a in range(0, len(key), 100_000):
                b = min(a + 100_000, len(key))
                raw = flat[ends[a] : ends[b]].astype("<u2").tobytes()
                ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((2 * (ends[a : b + 1] - ends[a])).astype(np.int32).tobytes()), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([pa.array(key[a:b].view(np.int64)), ids, pa.array(n[a:b]), pa.array(n_all[a:b])], names=["word", "ids", "n", "n_all"])

        for batch, a, b, s in _blocks(batches):
            learn = batch.column(2)[a:b].to_numpy(zero_copy_only=False).astype(float)
            held.append((s.kind_hashes, np.bincount(s.which, learn[s.words.row], len(s.n)).astype(np.int64), s.times, s.n, s.flat.astype(np.uint16)))
            if sum(len(h[0]) for h in held) > 1_000_000:
                held[:] = [merged()]
                if len(held[0][0]) > 500_000:
                    yield from rows()
                    held.clear()
        if held:
            yield from rows()

    found = docs.mapInArrow(run, "word long, ids binary, n long, n_all long")
    return found.groupBy("word", "ids").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def _flat_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, n, flat) of the column ids."""
    lists = [np.frombuffer(x, "<u2") for x in batch.column("ids").to_pylist()]
    n = np.array([len(x) for x in lists], np.int64)
    return np.cumsum(n) - n, n, np.concatenate([*lists, np.zeros(0, "<u2")]).astype(np.int64)


def first_counts(words: DataFrame, texts: int) -> np.ndarray:
    """How often each id begins a training word (END: a text's end), of words as from spellings()."""
    first = F.conv(F.hex(F.concat(F.substring("ids", 2, 1), F.substring("ids", 1, 1))), 16, 10).cast("long")
    # At most N_IDS rows.
    table = words.where("n > 0").groupBy(first.alias("id")).agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(N_IDS)
    out[table["id"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    out[END] += texts
    return out


def triple_scores(words: DataFrame) -> DataFrame:
    """(triple, score): log10 P(third | first two) of every triple of words, from how often training texts have each:
    absolute discounting, interpolated with the probability given the second one alone, and that with how many
    triples end in the third. Triples without training text have what the shorter contexts give."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, n, flat = _flat_ids(batch)
            own, inverse = np.unique(_triples(begin, n, flat), return_inverse=True)
            weight = np.repeat(batch.column("n").to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(inverse, weight, len(own)).astype(np.int64))], names=["triple", "n"])

    table = words.mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    context, pair = F.expr(f"triple div {N_IDS}").alias("context"), (F.col("triple") % (N_IDS * N_IDS)).alias("pair")
    table = written(table.select("triple", context, pair, "n"), "triples")
    seen = table.where("n > 0")
    three = seen.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    pairs = written(seen.groupBy("pair").agg(F.sum(F.least("n", F.lit(3))).alias("n_pair")), "pairs")
    # At most N_IDS rows each.
    middle = pairs.groupBy(F.expr(f"pair div {N_IDS}").alias("id")).agg(F.sum("n_pair").alias("n"), F.count(F.lit(1)).alias("kinds")).toPandas()
    last = seen.groupBy((F.col("pair") % N_IDS).alias("id")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    total_two, kinds_two, back = np.zeros(N_IDS), np.zeros(N_IDS), np.full(N_IDS, 0.02)
    total_two[middle["id"].to_numpy(np.int64)] = middle["n"].to_numpy(np.int64)
    kinds_two[middle["id"].to_numpy(np.int64)] = middle["kinds"].to_numpy(np.int64)
    back[last["id"].to_numpy(np.int64)] += last["n"].to_numpy(np.int64)
    back /= back.sum()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            triple, n, total, kinds, n_pair = (c.to_numpy() for c in batch.columns)
            i, after = triple // N_IDS % N_IDS, triple % N_IDS
            # Half a count more for what the table has not seen.
            p = (np.maximum(n_pair - 0.75, 0) + (0.75 * kinds_two[i] + 0.5) * back[after]) / (total_two[i] + 0.5)
            p = (np.maximum(n - 0.75, 0) + (0.75 * kinds + 0.5) * p) / (total + 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.log10(p))], names=["triple", "score"])

    joined = table.join(three.hint("merge"), "context", "left").join(pairs.hint("merge"), "pair", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select("triple", "n", zero("total"), zero("kinds"), zero("n_pair")).mapInArrow(score, "triple long, score double")


def spelled(words: DataFrame) -> DataFrame:
    """(word, n, n_all, spelling): log10 P(subwords after the first, and the word's end) of every word of spellings()."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, n, flat = _flat_ids(batch)
            word, times, times_all = (np.repeat(batch.column(c).to_numpy(), n) for c in ("word", "n", "n_all"))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(times), pa.array(times_all), pa.array(_triples(begin, n, flat))], names=["word", "n", "n_all", "triple"])

    each = written(words.mapInArrow(explode, "word long, n long, n_all long, triple long"), "word-triples")
    scores = written(triple_scores(words), "triple-scores")
    return each.join(scores.hint("merge"), "triple").groupBy("word", "n", "n_all").agg(F.sum("score").alias("spelling"))


class Speller:
    """Classes of first subwords, and log10 P(first subword | class)."""

    def __init__(self, first: np.ndarray):
        order = np.argsort(-first, kind="stable")
        # The most frequent first subwords have a class of their own; the rest share classes of about equal mass.
        alone = CLASSES // 2
        self.klass = np.zeros(N_IDS, np.int64)
        self.klass[order[:alone]] = np.arange(alone)
        mass = np.cumsum(first[order[alone:]] + 0.1)
        self.klass[order[alone:]] = alone + np.minimum(CLASSES - alone - 1, (mass / mass[-1] * (CLASSES - alone)).astype(int))
        smooth = first + 0.1
        self.within = np.log10(smooth / np.bincount(self.klass, smooth, CLASSES)[self.klass])


class Attention:
    """One layer of causal self-attention in numpy; parameters as a dict of arrays."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w
        self.mask = np.tri(CONTEXT, dtype=np.float32)

    @classmethod
    def fresh(cls, seed: int = 11) -> Attention:
        rng = np.random.default_rng(seed)
        shapes = {"emb": (N_IDS, WIDTH), "pos": (CONTEXT, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH), "V": (WIDTH, WIDTH), "A": (WIDTH, 2 * WIDTH), "B": (2 * WIDTH, WIDTH), "out": (WIDTH, CLASSES)}
        return cls({k: rng.normal(0, 0.3 if k in ("emb",) else 0.25, s).astype(np.float32) for k, s in shapes.items()} | {"bias": np.zeros(CLASSES, np.float32)})

    def _joined(self) -> np.ndarray:
        """Q (divided by the root of its width), K and V beside each other."""
        return np.concatenate([self.w["Q"] * np.float32(WIDTH**-0.5), self.w["K"], self.w["V"]], 1)

    def _weights(self, q: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weights, one over each place's sum of them) of the last places as queries, as many as q has."""
        s = q @ k.transpose(0, 2, 1)
        np.exp(np.clip(s, -MOST, MOST, out=s), out=s)
        s *= self.mask[CONTEXT - q.shape[1] :]
        return s, 1 / (s.reshape(-1, CONTEXT) @ ONES[:CONTEXT])[:, None]

    def _classes(self, z: np.ndarray) -> np.ndarray:
        """Logits of the classes; z has a column of ones at its end."""
        o = z @ np.concatenate([self.w["out"], self.w["bias"][None]])
        return np.clip(o, -MOST, MOST, out=o)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(exponentials of the classes' logits, their sums, what gradients needs) at every place, in rows, of inputs
        (windows, CONTEXT, WIDTH)."""
        w = self.w
        x = (x + w["pos"]).reshape(-1, WIDTH)
        joined = (x @ self._joined()).reshape(-1, CONTEXT, 3 * WIDTH)
        q, k, v = joined[:, :, :WIDTH], joined[:, :, WIDTH : 2 * WIDTH], joined[:, :, 2 * WIDTH :]
        s, inverse = self._weights(q, k)
        given = (s @ v).reshape(-1, WIDTH)
        given *= inverse
        h = x + given
        r = np.clip(h @ w["A"], 0, np.inf)
        z = np.ones((len(h), WIDTH + 1), np.float32)
        np.add(h, r @ w["B"], out=z[:, :WIDTH])
        p = self._classes(z)
        np.exp(p, out=p)
        return p, p @ ONES[:CLASSES], (x, q, k, v, s, inverse, given, h, r, z)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Log probabilities (natural) of the next class at every place of inputs (windows, CONTEXT, WIDTH)."""
        p, total, kept = self.places(x)
        return np.log(p / total[:, None]).reshape(*x.shape[:2], CLASSES), (p, total, kept)

    def scored(self, x: np.ndarray, window: np.ndarray, place: np.ndarray, target: np.ndarray, since: int = 0) -> np.ndarray:
        """log10 probabilities of target classes at some places of windows, none before `since`; the same sums as forward,
        without what only training needs."""
        w = self.w
        x = x + w["pos"]
        joined = self._joined()
        kv = (x.reshape(-1, WIDTH) @ joined[:, WIDTH:]).reshape(-1, CONTEXT, 2 * WIDTH)
        q = (x[:, since:].reshape(-1, WIDTH) @ joined[:, :WIDTH]).reshape(-1, CONTEXT - since, WIDTH)
        s, inverse = self._weights(q, kv[:, :, :WIDTH])
        own = window * (CONTEXT - since) + (place - since)
        h = x[window, place] + (s @ kv[:, :, WIDTH:]).reshape(-1, WIDTH)[own] * inverse[own]
        z = np.ones((len(h), WIDTH + 1), np.float32)
        np.add(h, np.clip(h @ w["A"], 0, np.inf) @ w["B"], out=z[:, :WIDTH])
        o = self._classes(z)
        own = o[np.arange(len(o)), target]
        np.exp(o, out=o)
        return (own - np.log(o @ ONES[:CLASSES])) / math.log(10)

    def gradients(self, p: np.ndarray, total: np.ndarray, kept: tuple, target: np.ndarray, valid: np.ndarray) -> tuple[dict, np.ndarray]:
        """(gradients of the parameters, of the inputs in rows) of the mean negative log probability of target classes at
        the valid places. Uses up what places() gave."""
        w, (x, q, k, v, s, inverse, given, h, r, z) = self.w, kept
        share = valid.ravel() / np.float32(max(valid.sum(), 1))
        p *= (share / total)[:, None]
        p[np.arange(len(p)), target.ravel()] -= share
        g_out = z.T @ p
        dz = p @ w["out"].T
        dr = dz @ w["B"].T
        dr *= r > 0
        dh = dz + dr @ w["A"].T
        # Of a softmax: weights times (their gradients less the weighted mean of these).
        own = dh * inverse
        less = np.einsum("ij,ij->i", own, given)
        own = own.reshape(-1, CONTEXT, WIDTH)
        ds = own @ v.transpose(0, 2, 1)
        ds -= less.reshape(-1, CONTEXT, 1)
        ds *= s
        back = np.concatenate([ds @ k, ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ own], 2).reshape(-1, 3 * WIDTH)
        g_joined = x.T @ back
        dx = dh + back @ self._joined().T
        g = {"out": g_out[:-1], "bias": g_out[-1], "B": r.T @ dz, "A": h.T @ dr, "Q": g_joined[:, :WIDTH] * np.float32(WIDTH**-0.5)}
        return g | {"K": g_joined[:, WIDTH : 2 * WIDTH], "V": g_joined[:, 2 * WIDTH :], "pos": dx.reshape(-1, CONTEXT, WIDTH).sum(0)}, dx

    def embedded(self, at: np.ndarray, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Mean subword embedding of every word."""
        return self.means(at, n, ids)[0]

    def means(self, at: np.ndarray, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(mean subword embedding of every word, the words longest first, and, for first subwords, second ones and so on to
        the eighth, the rest of long words last: which of the words in that order has each, and their ids)."""
        emb = self.w["emb"]
        order = np.argsort(-np.minimum(n, 9).astype(np.int8), kind="stable")
        at, n = at[order], n[order]
        sums = np.zeros((len(at), WIDTH), np.float32)
        which, rows = [], []
        for nth in range(min(8, int(n[0]) if len(n) else 0)):
            some = np.count_nonzero(n > nth)
            which.append(np.arange(some))
            rows.append(ids[at[:some] + nth])
            sums[:some] += emb.take(rows[-1], axis=0)
        if some := np.count_nonzero(n > 8):
            rest = n[:some] - 8
            which.append(np.repeat(np.arange(some), rest))
            rows.append(ids[ragged(at[:some] + 8, rest)])
            sums[:some] += np.add.reduceat(emb.take(rows[-1], axis=0), np.cumsum(rest) - rest, axis=0)
        sums /= n[:, None].astype(np.float32)
        out = np.empty_like(sums)
        out[order] = sums
        return out, order, which, rows


def windows(length: int) -> list[int]:
    """Starts of the windows over that many places: the first scores all of its places, the others those after OVERLAP."""
    return [0, *range(CONTEXT - OVERLAP, max(length - OVERLAP, 0), CONTEXT - OVERLAP)]


class Learner:
    """Adam over the windows of blocks of texts, from some weights; what it changed, in chunks."""

    def __init__(self, w: dict[str, np.ndarray], klass: np.ndarray, rate, seed: int):
        self.start, self.model = w, Attention({k: v.copy() for k, v in w.items()})
        self.klass, self.rate, self.rng = klass, rate, np.random.default_rng(seed)
        self.moments = 0.0, 0.0
        self.emb_m, self.emb_v = np.zeros_like(w["emb"]), np.zeros_like(w["emb"])
        self.touched, self.met, self.number = np.zeros(N_IDS, bool), np.zeros(N_IDS, bool), np.zeros(N_IDS, np.int64)
        self.step, self.windows = 0, 0

    def learn(self, s: Spelled) -> None:
        """One pass over the block: every word, and every text's end, is predicted once."""
        ids, n = np.append(s.flat, END), np.append(s.n[s.which], 1)
        at = np.append(s.begin[s.which], len(s.flat))
        end_word = len(n) - 1
        first = s.words.first[:-1].astype(np.int64)
        count = np.diff(s.words.first).astype(np.int64)
        n_windows = count // CONTEXT + 1
        text = np.repeat(np.arange(len(count)), n_windows)
        start = (np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)) * CONTEXT
        order = self.rng.permutation(len(text))
        self.windows += len(text)
        for a in range(0, len(order), BATCH):
            picked = order[a : a + BATCH]
            place, own = start[picked][:, None] + np.arange(CONTEXT), text[picked][:, None]
            size = count[own]
            target = np.where(place < size, first[own] + np.minimum(place, np.maximum(size - 1, 0)), end_word)
            given = np.where(place == 0, end_word, first[own] + np.clip(place - 1, 0, np.maximum(size - 1, 0)))
            # Places behind a text's end are masked; an empty text at the block's end has no word to stand there.
            self._step(ids, at, n, np.minimum(given, end_word), np.minimum(target, end_word), place <= size)

    def _step(self, ids, at, n, given, target, valid) -> None:
        self.step += 1
        first = at
        model, lr = self.model, self.rate(self.step)
        at, n = at[given.ravel()], n[given.ravel()]
        x, order, which, rows = model.means(at, n, ids)
        p, total, kept = model.places(x.reshape(*given.shape, WIDTH))
        grads, dx = model.gradients(p, total, kept, self.klass[ids[first[target]]], valid)
        g = np.concatenate([x.ravel() for x in grads.values()])
        m, v = self.moments
        self.moments = m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        change, done = lr * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8), 0
        for name, own in grads.items():
            model.w[name] = (model.w[name] - change[done : done + own.size].reshape(own.shape)).astype(np.float32)
            done += own.size
        rows = np.concatenate(rows)
        self.met[rows] = True
        own = np.flatnonzero(self.met)
        self.met[own] = False
        self.touched[own] = True
        self.number[own] = np.arange(0, WIDTH * len(own), WIDTH)
        # Each subword's gradients summed by place in a table of WIDTH columns.
        dx /= n[:, None].astype(np.float32)
        each = dx.take(order.take(np.concatenate(which)), axis=0)
        cells = self.number.take(rows)[:, None] + np.arange(WIDTH)
        g = np.bincount(cells.ravel(), each.ravel(), WIDTH * len(own)).reshape(-1, WIDTH).astype(np.float32)
        m, v = 0.8 * self.emb_m.take(own, axis=0) + 0.2 * g, 0.95 * self.emb_v.take(own, axis=0) + 0.05 * g * g
        self.emb_m[own], self.emb_v[own] = m, v
        model.w["emb"][own] -= lr * m / (np.sqrt(v) + 1e-8)

    def changes(self, task: int) -> pa.RecordBatch:
        """(chunk, task, windows, ids, change): embeddings by chunk, those touched only; all else as chunk -1."""
        w, rows = self.model.w, []
        dense = np.concatenate([(w[k] - self.start[k]).ravel() for k in sorted(w) if k != "emb"])
        rows.append((-1, task, self.windows, b"", dense.astype("<f4").tobytes()))
        own = np.flatnonzero(self.touched)
        for ids in np.split(own, np.flatnonzero(np.diff(own // CHUNK)) + 1) if len(own) else []:
            rows.append((int(ids[0]) // CHUNK, task, self.windows, ids.astype("<i4").tobytes(), (w["emb"][ids] - self.start["emb"][ids]).astype("<f4").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "task", "windows", "ids", "change"])


CHANGES = "chunk int, task int, windows long, ids binary, change binary"


def _averaged(table: pa.Table) -> pa.Table:
    """The mean change of a chunk, weighted by windows; of an embedding, over the tasks that met it."""
    rows = sorted(table.to_pylist(), key=lambda r: r["task"])
    if rows[0]["chunk"] < 0:
        total = sum(np.frombuffer(r["change"], "<f4").astype(float) * r["windows"] for r in rows) / sum(r["windows"] for r in rows)
        ids = np.zeros(0, np.int64)
    else:
        base = rows[0]["chunk"] * CHUNK
        change, weight = np.zeros((CHUNK, WIDTH)), np.zeros(CHUNK)
        for r in rows:
            own = np.frombuffer(r["ids"], "<i4") - base
            change[own] += np.frombuffer(r["change"], "<f4").reshape(-1, WIDTH) * float(r["windows"])
            weight[own] += r["windows"]
        ids = np.flatnonzero(weight)
        total = change[ids] / weight[ids, None]
        ids = ids + base
    out = [[rows[0]["chunk"]], [0], [0], [ids.astype("<i4").tobytes()], [total.astype("<f4").tobytes()]]
    return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "task", "windows", "ids", "change"])


def train(docs: DataFrame, klass: np.ndarray, windows: int, steps: int = STEPS, rate: float = 0.01, rounds: int = ROUNDS) -> Attention:
    """The layer, from all training rows (doc_id, text, ..); windows: about how many these have.

    A corpus of less than `steps` steps is passed over by one task until it has made so many; a larger one is read
    once, each text in the round that its hash decides, by as many tasks as have `steps` steps each to make."""
    model = Attention.fresh()
    tasks = min(max(1, windows // (steps * BATCH)), docs.rdd.getNumPartitions())
    passes = max(1, -(-steps * BATCH // max(1, windows)))
    rounds = rounds if tasks > 1 else 1
    expected = max(1, passes * windows // (BATCH * tasks * rounds))
    for nth in range(rounds):
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == nth).coalesce(tasks)
        shared = docs.sparkSession.sparkContext.broadcast((model.w, klass))  # size set by the vocabulary and the layer

        def run(batches: Iterator[pa.RecordBatch], nth=nth, shared=shared) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            weights, own_klass = shared.value
            decayed = lambda step: rate * min(1, step / 50) * (1 - 0.9 * min(1, (nth + step / expected) / rounds))
            learner = Learner(weights, own_klass, decayed, 1000 * task + nth)
            texts = ((data, offsets) for batch in batches for _, _, data, offsets in blocks(batch, "text", most=BLOCK))
            # More than one pass is made over less than `steps` steps only.
            for data, offsets in texts if passes == 1 else [(d.copy(), o) for d, o in texts] * passes:
                learner.learn(Spelled(data, offsets))
            if learner.windows:
                yield learner.changes(task)

        for r in part.mapInArrow(run, CHANGES).groupBy("chunk").applyInArrow(_averaged, CHANGES).collect():
            change, at = np.frombuffer(r["change"], "<f4"), 0
            if r["chunk"] >= 0:
                model.w["emb"][np.frombuffer(r["ids"], "<i4")] += change.reshape(-1, WIDTH)
                continue
            for k in sorted(k for k in model.w if k != "emb"):
                model.w[k] = model.w[k] + change[at : at + model.w[k].size].reshape(model.w[k].shape)
                at += model.w[k].size
        shared.destroy()
    return model


def model_scores(s: Spelled, model: Attention, speller: Speller) -> np.ndarray:
    """log10 probability of every row's first subwords, of its words and its end; spellings not included."""
    words = s.words
    rows = len(words.first) - 1
    count = np.diff(words.first)
    places = count + 1
    # Words of all rows, each row followed by the end token: targets; inputs are one place behind.
    row_of = np.repeat(np.arange(rows), places)
    index = np.arange(len(row_of)) - (np.cumsum(places) - places)[row_of]
    is_end = index == count[row_of]
    first_id = np.full(len(row_of), END)
    first_id[~is_end] = s.first_id
    klass = speller.klass[first_id]
    # What is behind an end is a row's first place, whose input is the end token.
    inputs = np.concatenate([model.embedded(s.begin, s.n, s.flat), model.w["emb"][END:][:1]])
    given = np.full(len(row_of), len(inputs) - 1)
    given[np.flatnonzero(~is_end) + 1] = s.which
    base = np.cumsum(places) - places
    step = CONTEXT - OVERLAP
    n_windows = np.maximum(1, -(-(places - OVERLAP) // step))
    nth = np.arange(int(n_windows.sum())) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    row = np.repeat(np.arange(rows), n_windows)
    begin = base[row] + nth * step
    size = np.minimum(CONTEXT, places[row] - nth * step)
    out = speller.within[first_id]
    # A text's first window, and those of which only places after OVERLAP are scored.
    for since, some in ((0, np.flatnonzero(nth == 0)), (OVERLAP, np.flatnonzero(nth > 0))):
        for a in range(0, len(some), SCORED_AT_ONCE):
            own = some[a : a + SCORED_AT_ONCE]
            w, p = np.nonzero(np.arange(since, CONTEXT) < size[own, None])
            place = np.minimum(begin[own, None] + np.arange(CONTEXT), len(given) - 1)
            target = place[w, p + since]
            out[target] += model.scored(inputs.take(given.take(place), axis=0), w, p + since, klass[target], since)
    return np.bincount(row_of, out, rows)


SCORED = "doc_id long, row long, n_tokens long, score double, part double, known long, rare long, bucket int, words binary, docs binary, n binary"


class Hot:
    """The frequent words' hashes (sorted), counts in training texts, and spellings."""

    def __init__(self, word: np.ndarray, n: np.ndarray, spelling: np.ndarray):
        order = np.argsort(word.view(np.uint64))
        self.word, self.n, self.spelling = word.view(np.uint64)[order], n[order], spelling[order]

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(held, log10(count + 0.5), count > 0, spelling) of each word; zeros for words not held."""
        if not len(self.word):
            return np.zeros(len(words), bool), *(np.zeros(len(words)) for _ in range(3))
        at = np.minimum(np.searchsorted(self.word, words), len(self.word) - 1)
        held = self.word[at] == words
        n = self.n[at]
        return held, np.where(held, np.log10(n + 0.5), 0.0), (held & (n > 0)).astype(float), np.where(held, self.spelling[at], 0.0)


def score_texts(docs: DataFrame, shared, buckets: int) -> DataFrame:
    """Two kinds of rows (SCORED) from docs(doc_id, text, train, row): without a bucket, the scores of a document by the
    model and by its frequent words, and how many rare ones it has; with a bucket, (word, row, times) of rare words.
    shared: broadcast (layer's weights, Speller, Hot)."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in SCORED.split(", ")]

    def batch_of(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, speller, hot = shared.value
        layer = Attention(w)
        held: list = []

        def flush() -> Iterator[pa.RecordBatch]:
            key, doc, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            rows = list(to_buckets(key, [doc, n], buckets))
            for a in range(0, len(rows), 2000):
                own = rows[a : a + 2000]
                yield batch_of({"bucket": [b for b, _ in own]} | {c: [x[k] for _, x in own] for k, c in enumerate(("words", "docs", "n"))}, len(own))

        for batch, a, b, s in _blocks(batches):
            row_id, row, rows = batch.column(3)[a:b].to_numpy(), s.words.row, b - a
            frequent, part, known, spelling = hot.look_up(s.kind_hashes)
            total = lambda x, s=s, row=row, rows=rows: np.bincount(row, x[s.which], rows)
            rare = np.flatnonzero(~frequent[s.which])
            columns = {
                "doc_id": batch.column(0)[a:b],
                "row": row_id,
                "n_tokens": np.diff(s.words.first) + 1,
                "score": model_scores(s, layer, speller) + total(spelling),
                "part": total(part),
                "known": total(known).astype(np.int64),
                "rare": np.bincount(row[rare], minlength=rows),
            }
            yield batch_of(columns, rows)
            if len(rare):
                own, times = np.unique(row[rare] * len(s.n) + s.which[rare], return_counts=True)
                held.append((s.kind_hashes[own % len(s.n)], row_id[own // len(s.n)], times.astype(np.uint32)))
                if sum(len(h[0]) for h in held) >= FLUSH:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text", "train", "row").mapInArrow(run, SCORED)


def rare_parts(packed: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """(row, part, known, spelling, words): sums of log10(c + 0.5), known counts, spellings and counts of each row's rare
    words. packed(bucket, words, docs, n) as from score_texts, words(word, n, spelling)."""
    columns = ("docs", "part", "known", "spelling", "words")
    dtypes = (np.int64, np.float64, np.int64, np.float64, np.int64)

    def whole(table: pa.Table, name: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)

    def sums(doc: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        docs_of, inverse = np.unique(doc, return_inverse=True)
        return [docs_of, *(np.bincount(inverse, x, len(docs_of)).astype(t) for x, t in zip(values, dtypes[1:], strict=True))]

    def look_up(table: pa.Table, own: pa.Table) -> pa.Table:
        key, doc, n = whole(table, "words", np.uint64), whole(table, "docs", np.int64), whole(table, "n", np.uint32)
        word = own.column("word").to_numpy().view(np.uint64)
        order = np.argsort(word)
        at = order[np.searchsorted(word, key, sorter=order)] if len(word) else np.zeros(0, np.int64)
        c, spelling = own.column("n").to_numpy()[at], own.column("spelling").to_numpy()[at]
        found = sums(doc, [n * np.log10(c + 0.5), n * (c > 0), n * spelling, n])
        rows = list(to_buckets(found[0].view(np.uint64), found[1:], -(-buckets // 8)))
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32())} | {c: pa.array([x[k] for _, x in rows], pa.binary()) for k, c in enumerate(columns)})

    def add_up(table: pa.Table) -> pa.Table:
        docs, *values = (whole(table, c, t) for c, t in zip(columns, dtypes, strict=True))
        return pa.table(dict(zip(("row", *columns[1:]), sums(docs, values), strict=True)))

    # The bucket of a word as to_buckets deals it.
    bucket = F.shiftright(F.shiftrightunsigned("word", 32) * F.lit(buckets).cast("long"), 32).cast("int")
    dealt = words.withColumn("bucket", bucket).groupBy("bucket")
    by_document = packed.groupBy("bucket").cogroup(dealt).applyInArrow(look_up, "bucket int, " + ", ".join(f"{c} binary" for c in columns))
    return by_document.groupBy("bucket").applyInArrow(add_up, "row long, part double, known long, spelling double, words long")


def lm_scores(docs: DataFrame, train_where=None, steps: int = STEPS, hot: int = HOT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs.

    train_where: a column that tells training rows (all if none). Null and empty texts are one end token; very long
    texts are scored whole; repeated rows are scored each, and counted each in training; rows may share a doc_id or
    have none. hot: most words that are broadcast; the result is the same for any.
    An empty table gives no rows; columns other than doc_id and text are not read.
    """
    learn = F.lit(True) if train_where is None else train_where
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("train"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    words = written(spellings(docs), "spellings")
    totals = words.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum("n_all")).first()
    train_docs = docs.where("train").count()
    train_tokens, distinct = (totals[0] or 0) + train_docs, totals[1] + (1 if train_docs else 0)
    speller = Speller(first_counts(words, train_docs))
    model = train(docs.where("train"), speller.klass, train_tokens // CONTEXT + train_docs // 2, steps)
    scores = written(spelled(words), "spelled")
    often = max(1, -(-(totals[2] or 0) // hot))
    # At most `hot` rows, as each has `often` of all occurrences.
    frequent = scores.where(F.col("n_all") >= often).select("word", "n", "spelling").toPandas()
    table = Hot(*(frequent[c].to_numpy(t) for c, t in (("word", np.int64), ("n", np.int64), ("spelling", np.float64))))
    rare = scores.where(F.col("n_all") < often)
    # A bucket of words holds some 2**17 of the rare ones, one of documents eight times as many.
    buckets = max(8, (rare.agg(F.sum("n_all")).first()[0] or 0) >> 17)
    shared = docs.sparkSession.sparkContext.broadcast((model.w, speller, table))  # sizes set by the vocabulary, the layer and HOT
    scored = written(score_texts(docs, shared, buckets), "lm-scores")
    shared.destroy()  # the scores are stored
    summed = rare_parts(scored.where("bucket is not null").select("bucket", "words", "docs", "n"), rare.select("word", "n", "spelling"), buckets)
    summed = summed.select("row", *[F.col(c).alias(f"_{c}") for c in ("part", "known", "spelling", "words")])
    out = scored.where("bucket is null").join(written(summed, "rare-parts").hint("merge"), "row", "left")
    # Equal rows' rare words are added up together: each row has its share of the sums.
    share = lambda c: F.coalesce(F.col(f"_{c}") * F.col("rare") / F.col("_words"), F.lit(0.0))
    end, norm = math.log10(train_docs + 0.5), math.log10(train_tokens + 0.5 * (distinct + 1))
    base = F.col("part") + share("part") + F.lit(end) - F.col("n_tokens") * F.lit(norm)
    known = F.col("known") + F.round(share("known")) + F.lit(1 if train_docs else 0)
    return out.select("doc_id", "n_tokens", known.cast("long").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + share("spelling")).alias("score"))


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = lm_scores(docs, fold("doc_id") != 1)
    return scored.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
