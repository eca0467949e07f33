"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words, all of them. Every passage is encoded by a learned layer over its words
(the mean of embeddings learned for WORDS hashes of lower-cased words) and surface statistics of its bytes and words; a
gated attention learned from document labels alone weighs the passages, and the weighted representation is scored.
Training runs in numpy on a bounded sample of labelled rows; scoring runs in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import fold, map_batches
from quillstream.llm.textcore import Words, blocks, ragged

PASSAGE = 48
SAMPLE = 6_000  # most labelled documents that are learned from, each by its whole text
WORDS = 4_096  # hashes of words that have an embedding
STEPS = 150  # of training, at least
THRESHOLD = 0.3
HIDDEN, GATE = 16, 8

_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "#$%&*@^~=+", "|/\\<>[]{}", "()'\"-_`", "\n"]
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _i, _s in enumerate(_CLASSES):
    _CLASS[list(_s.encode())] = _i
_CLASS[128:] = len(_CLASSES) + 1
N_FEATURES = len(_CLASSES) + 2 + 7


class Bags:
    """Passages of some documents: features x, hashed words of all passages (words, with the first of each passage) and
    the first passage of each document. A document without words has one passage of zeros and no words."""

    def __init__(self, x: np.ndarray, words: np.ndarray, word_at: np.ndarray, first: np.ndarray):
        self.x, self.words, self.word_at, self.first = x, words, word_at, first

    def take(self, docs: np.ndarray) -> Bags:
        n = np.diff(self.first)[docs]
        rows = ragged(self.first[:-1][docs], n)
        size = np.diff(self.word_at)[rows]
        return Bags(self.x[rows], self.words[ragged(self.word_at[:-1][rows], size)], np.r_[0, np.cumsum(size)], np.r_[0, np.cumsum(n)])

    @classmethod
    def joined(cls, parts: list[Bags]) -> Bags:
        if not parts:
            return cls(np.zeros((0, N_FEATURES)), np.zeros(0, np.uint16), np.zeros(1, np.int64), np.zeros(1, np.int64))
        ends = lambda at: np.r_[0, np.cumsum(np.concatenate([np.diff(a) for a in at]))].astype(np.int64)
        return cls(np.concatenate([p.x for p in parts]), np.concatenate([p.words for p in parts]), ends([p.word_at for p in parts]), ends([p.first for p in parts]))


def passages(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE) -> Bags:
    words = Words(data, offsets)
    rows = len(offsets) - 1
    n_words = np.diff(words.first)
    n = np.maximum(1, -(-n_words // size))
    first = np.r_[0, np.cumsum(n)]
    out = np.zeros((first[-1], N_FEATURES))
    if not len(words.starts):
        return Bags(out, np.zeros(0, np.uint16), np.zeros(first[-1] + 1, np.int64), first)
    row = words.row
    passage = first[row] + (np.arange(len(row)) - words.first[row]) // size
    begin = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    end = np.r_[begin[1:], len(row)]
    at = passage[begin]
    a, b = words.starts[begin], words.ends[end - 1]
    length = np.maximum(b - a, 1)
    kind = _CLASS[data]
    for c in range(len(_CLASSES) + 2):
        total = np.r_[0, np.cumsum(kind == c)]
        out[at, c] = (total[b] - total[a]) / length
    count = end - begin
    hashes = words.hashes()
    word_length = words.ends - words.starts
    together = passage[1:] == passage[:-1]
    columns = [
        word_length / 10,
        (word_length > 25).astype(float),
        np.r_[0.0, (hashes[1:] == hashes[:-1]) & together],
        (kind[words.starts] == 1).astype(float),
        (kind[words.ends - 1] > 3).astype(float) * (kind[words.ends - 1] < len(_CLASSES)),
        (word_length == 1).astype(float),
    ]
    for c, values in enumerate(columns):
        total = np.r_[0.0, np.cumsum(values)]
        out[at, len(_CLASSES) + 2 + c] = (total[end] - total[begin]) / count
    order = np.lexsort((hashes, passage))
    fresh = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    out[at, N_FEATURES - 1] = np.bincount(passage[order][fresh], minlength=first[rows])[at] / count
    lower = Words(data, offsets, lower=True).hashes()
    return Bags(out, ((lower >> np.uint64(40)) % np.uint64(WORDS)).astype(np.uint16), np.r_[0, np.cumsum(np.bincount(passage, minlength=first[rows]))], first)


class Model:
    """Gated attention over encoded passages; parameters as a dict of arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    def forward(self, bags: Bags) -> tuple[np.ndarray, dict]:
        w, first = self.w, bags.first
        x = (bags.x - w["mean"]) / w["scale"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        size = np.diff(bags.word_at)
        full = np.flatnonzero(size)
        lexical = np.zeros((len(x), HIDDEN))
        if len(full):
            lexical[full] = np.add.reduceat(w["T"][bags.words], bags.word_at[:-1][full], axis=0) / size[full, None]
        h = np.tanh(x @ w["E"] + lexical + w["e"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (t * g) @ w["a"]
        s = np.exp(s - np.maximum.reduceat(s, first[:-1])[bag])
        attention = s / np.add.reduceat(s, first[:-1])[bag]
        z = np.add.reduceat(attention[:, None] * h, first[:-1], axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30)))
        return p, {"x": x, "bags": bags, "h": h, "t": t, "g": g, "attention": attention, "z": z, "bag": bag}

    def gradients(self, y: np.ndarray, p: np.ndarray, k: dict, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, bag = self.w, k["bag"]
        d = (p - y) * weight / len(y)
        dz = d[:, None] * w["c"]
        from_z = (dz[bag] * k["h"]).sum(1)
        mean = np.bincount(bag, k["attention"] * from_z, len(y))
        ds = k["attention"] * (from_z - mean[bag])
        dt, dg = ds[:, None] * w["a"] * k["g"] * (1 - k["t"] ** 2), ds[:, None] * w["a"] * k["t"] * k["g"] * (1 - k["g"])
        dh = (k["attention"][:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - k["h"] ** 2)
        bags = k["bags"]
        size = np.diff(bags.word_at)
        order = np.argsort(bags.words, kind="stable")
        of_word = (dh / np.maximum(size, 1)[:, None])[np.repeat(np.arange(len(size)), size)[order]]
        held = bags.words[order]
        starts = np.flatnonzero(np.r_[True, held[1:] != held[:-1]][: len(held)])
        dT = np.zeros_like(w["T"])
        if len(held):
            dT[held[starts]] = np.add.reduceat(of_word, starts, axis=0)
        return {"T": dT, "E": k["x"].T @ dh, "e": dh.sum(0), "V": k["h"].T @ dt, "U": k["h"].T @ dg, "a": (k["t"] * k["g"]).T @ ds, "c": k["z"].T @ d, "b": d.sum()}


def train(bags: Bags, y: np.ndarray, epochs: int = 16, batch: int = 256, rate: float = 0.015, seed: int = 7) -> Model:
    """Adam on the logistic loss of the documents' labels; both classes weigh the same in total, within 4 to 1."""
    x = bags.x
    rng = np.random.default_rng(seed)
    scale = x.std(0) if len(x) else np.ones(N_FEATURES)
    w = {"mean": x.mean(0) if len(x) else np.zeros(N_FEATURES), "scale": np.where(scale > 1e-9, scale, 1.0)}
    w |= {k: rng.normal(0, 0.3, s) for k, s in {"E": (N_FEATURES, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "a": GATE, "c": HIDDEN}.items()}
    w |= {"e": np.zeros(HIDDEN), "b": np.array(0.0), "T": np.zeros((WORDS, HIDDEN))}
    model = Model(w)
    if len(y) == 0:
        return model
    share = min(max(y.mean(), 0.1), 0.9)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) if 0 < y.mean() < 1 else np.ones(len(y))
    weight = np.clip(weight, 0.5, 2)
    moments, step = {}, 0
    for _ in range(max(epochs, STEPS // max(1, len(y) // batch))):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            own = order[a : a + batch]
            p, kept = model.forward(bags.take(own))
            step += 1
            for name, g in model.gradients(y[own], p, kept, weight[own]).items():
                g = g + 1e-4 * w[name]
                m, v = moments.get(name, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                moments[name] = m, v
                w[name] = w[name] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns labels.quality from labelled rows whose fold is not 0: the `sample` first by a hash of their doc_id.

    Several labels of one document are averaged (a half counts as 1); null labels, labels without a document and null
    texts are left out. Of rows that share a doc_id the smallest text is learned, once. Without any label the model is as
    it was before training.
    """
    chosen = labels.where("quality is not null and doc_id is not null").where(fold("doc_id") != 0)
    chosen = chosen.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_y").alias("_y"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                bags = passages(data, offsets)
                own = [bags.take(np.array([row])) for row in range(b - a)]
                columns = [[f(o).tobytes() for o in own] for f in (lambda o: o.x.astype("<f8"), lambda o: o.words.astype("<u2"), lambda o: np.diff(o.word_at).astype("<i4"))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(2)[a:b], *(pa.array(c, pa.binary()) for c in columns)], names=["doc_id", "y", "x", "words", "sizes"])

    # At most `sample` documents.
    found = sorted(rows.mapInArrow(features, "doc_id long, y int, x binary, words binary, sizes binary").collect(), key=lambda r: (r["doc_id"], r["x"]))
    bags = []
    for r in found:
        x = np.frombuffer(r["x"], "<f8").reshape(-1, N_FEATURES)
        bags.append(Bags(x, np.frombuffer(r["words"], "<u2"), np.r_[0, np.cumsum(np.frombuffer(r["sizes"], "<i4"))].astype(np.int64), np.array([0, len(x)])))
    return train(Bags.joined(bags), np.array([r["y"] for r in found], float))


def _scored(batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of passages and the passage of most attention of each row."""
    score, n, best = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in blocks(batch, "text"):
        bags = passages(data, offsets)
        first = bags.first
        p, kept = model.forward(bags)
        order = np.lexsort((kept["attention"], kept["bag"]))
        score.append(p)
        n.append(np.diff(first))
        best.append(order[first[1:] - 1] - first[:-1])
    return np.concatenate(score), np.concatenate(n), np.concatenate(best)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1), predicted, n_passages, best_passage of every row.

    Null and empty texts have one passage of zeros; repeated rows and rows that share a doc_id, or have none, are scored
    each; texts of any length are scored whole. Of passages with equal attention the last is best_passage. An empty
    table gives no rows; no column but doc_id and text is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n, best = _scored(batch, model)
            columns = [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(n, pa.int64()), pa.array(best, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", "n_passages", "best_passage"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int, n_passages long, best_passage long")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns; null and empty texts, repeated rows and
    very long texts as in score()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch, model)[0] >= threshold))

    return map_batches(docs, run, docs.schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted", "n_passages", "best_passage")
