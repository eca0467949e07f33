"""SentencePiece encoding and decoding with numpy, over the distinct words of each block of text.

Words are cut where a space follows a non-space (no piece of the model reaches over that). Those not met before are
grouped by their number of characters, and words of one length advance together: hashes of substrings probe the sorted
keys of all pieces, a vectorised maximum over the piece that ends at a character stores its back pointer.
A model of merges (BPE) is not additive, so its own ids come from `merges`, which works on the same equal-length
blocks and probes: the best-ranked neighbouring pair of every word is joined in each step. Words longer than LONG (a text
without spaces is one word) are few of a length: their substrings are probed at once, and one sweep or one heap goes
over what was found, in time that grows with their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.textcore import _RANDOM, PieceCache, blocks, mix, ragged, spans_hash

MODEL = "piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
LONG = 64  # characters
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Pieces:
    """A model's pieces: sorted hashes of their characters, ids and scores; bytes of every id for decoding."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        size = sp.get_piece_size()
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)])
        self.byte = np.zeros(256, np.int64)
        text: list[bytes] = []
        normal = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                text.append(bytes([int(piece[3:5], 16)]))
            elif special[i]:
                text.append(b"")
            else:
                normal.append(i)
                text.append(piece.replace("▁", " ").encode())
        words = [sp.id_to_piece(i).replace("▁", " ") for i in normal]
        self.longest = max(map(len, words))
        keys = np.zeros(len(words), np.uint64)
        for n in {len(w) for w in words}:
            own = [j for j, w in enumerate(words) if len(w) == n]
            total = self.prefix(self.letters([words[j] for j in own], n))
            keys[own] = self.span(total, 0, n)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal)[order]
        self.seen = np.zeros(1 << 21, bool)  # by the key's first bits: most substrings are no piece
        self.seen[self.keys >> np.uint64(43)] = True
        self.score = np.array([sp.get_score(i) for i in normal])[order]
        self.unknown = float(self.score.min()) - UNKNOWN_PENALTY
        self.by_text = {w: (sp.get_score(i), i) for w, i in zip(words, normal, strict=True)}
        self.text_at = np.r_[0, np.cumsum([len(t) for t in text])]
        self.text = np.frombuffer(b"".join(text), np.uint8)

    @staticmethod
    def letters(words: list[str], n: int) -> np.ndarray:
        return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n)

    @staticmethod
    def prefix(letters: np.ndarray) -> np.ndarray:
        """Rolling hash of the first 0, 1, .. n characters of every word."""
        total = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
        values = mix(letters.astype(np.uint64) + np.uint64(0x51ED270B))
        for j in range(letters.shape[1]):
            total[:, j + 1] = total[:, j] * _BASE + values[:, j]
        return total

    @staticmethod
    def span(total: np.ndarray, i, j) -> np.ndarray:
        return total[:, j] - total[:, i] * np.uint64(pow(int(_BASE), j - i, 1 << 64))

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the pieces, -1 if it is none."""
        out = np.full(keys.shape, -1)
        maybe = np.flatnonzero(self.seen[(keys >> np.uint64(43)).ravel()])
        own = keys.ravel()[maybe]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        out.ravel()[maybe] = np.where(self.keys[at] == own, at, -1)
        return out


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """Words of LONG characters at most, by their length."""
    own: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) <= LONG:
            own.setdefault(len(w), []).append(i)
    yield from own.items()


def _long_viterbi(model: Pieces, word: str) -> tuple[list[int], list[int]]:
    """(ids, ends) of a long word, as `viterbi` defines them."""
    n = len(word)
    total = model.prefix(model.letters([word], n))
    starts, ends, places = [], [], []
    for size in range(1, min(model.longest, n) + 1):
        at = model.probe(total[0, size:] - total[0, :-size] * np.uint64(pow(int(_BASE), size, 1 << 64)))
        found = np.flatnonzero(at >= 0)
        starts.append(found)
        ends.append(found + size)
        places.append(at[found])
    start, end, place = (np.concatenate(x) for x in (starts, ends, places))
    order = np.lexsort((start, end))
    first = np.searchsorted(end[order], np.arange(n + 2)).tolist()
    start, score, ids = start[order].tolist(), model.score[place[order]].tolist(), model.ids[place[order]].tolist()
    best, back, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        own, top, came, own_id = range(first[j], first[j + 1]), None, j - 1, -1
        for c in own:
            value = best[start[c]] + score[c]
            if top is None or value > top:
                top, came, own_id = value, start[c], ids[c]
        if not own or start[own[-1]] != j - 1:
            value = best[j - 1] + model.unknown
            if top is None or value > top:
                top, came, own_id = value, j - 1, -1
        best[j], back[j], piece[j] = top, came, own_id
    cuts = []
    while n:
        cuts.append(n)
        n = back[n]
    return [piece[j] for j in reversed(cuts)], cuts[::-1]


def _long_merges(model: Pieces, word: str) -> tuple[list[int], list[int]]:
    """(ids, ends) of a long word, as `merges` defines them: a heap of neighbouring pairs, stale ones skipped."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by a piece's first character; 0 for those joined away

    def pair(i: int) -> None:
        j = end[i]
        if j < n and (found := model.by_text.get(word[i : end[j]])):
            heapq.heappush(heap, (-found[0], i, j, end[j]))

    heap: list[tuple] = []
    for i in range(n - 1):
        pair(i)
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if end[i] != j or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
        pair(i)
        if before[i] >= 0:
            pair(before[i])
    ids, ends, i = [], [], 0
    while i < n:
        ids.append(model.by_text.get(word[i : end[i]], (0, -1))[1])
        ends.append(end[i])
        i = end[i]
    return ids, ends


def _add_long(out: _Found, model: Pieces, words: list[str], one) -> None:
    for i, w in enumerate(words):
        if len(w) > LONG:
            out.add_one(i, *one(model, w))


class _Found:
    """Ids of words, gathered group by group; spans in no piece (-1) become the ids of their UTF-8 bytes."""

    def __init__(self, model: Pieces, words: list[str]):
        self.model, self.words = model, words
        self.owner: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, words: np.ndarray, ids: np.ndarray, cuts: np.ndarray) -> None:
        """One row of ids for each word, -2 where there is none; cuts: end of each id's span, in characters."""
        plain = (ids != -1).all(1)
        mask = ids[plain] >= 0
        self.owner.append(np.broadcast_to(words[plain][:, None], mask.shape)[mask])
        self.ids.append(ids[plain][mask])
        for word, own, ends in zip(words[~plain].tolist(), ids[~plain].tolist(), cuts[~plain].tolist(), strict=True):
            spelled, a = [], 0
            for i, b in zip(own, ends, strict=True):
                if i != -2:
                    spelled += [i] if i >= 0 else self.model.byte[list(self.words[word][a:b].encode())].tolist()
                    a = b
            self.owner.append(np.full(len(spelled), word))
            self.ids.append(np.array(spelled))

    def add_one(self, word: int, ids: list[int], ends: list[int]) -> None:
        self.add(np.array([word]), np.array([ids]), np.array([ends]))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.owner:
            return np.zeros(len(self.words), np.int64), np.zeros(0, np.int64)
        owner = np.concatenate(self.owner)
        return np.bincount(owner, minlength=len(self.words)), np.concatenate(self.ids)[np.argsort(owner, kind="stable")]


def viterbi(model: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Best total score of pieces for every word; a character in no piece costs the lowest score less a penalty and
    becomes its bytes. Of equal totals, the longest last piece wins."""
    out = _Found(model, words)
    for n, own in _by_length(words):
        total = model.prefix(model.letters([words[i] for i in own], n))
        best = np.full((n + 1, len(own)), -np.inf)
        best[0] = 0
        back = np.zeros((n + 1, len(own)), np.int64)
        piece = np.full((n + 1, len(own)), -1)
        for j in range(1, n + 1):
            starts = np.arange(max(0, j - model.longest), j)
            at = np.stack([model.probe(model.span(total, i, j)) for i in starts.tolist()])
            score = best[starts] + np.where(at >= 0, model.score[at], -np.inf)
            score[-1] = np.where(at[-1] >= 0, score[-1], best[j - 1] + model.unknown)
            pick = score.argmax(0)
            all_rows = np.arange(len(own))
            best[j], back[j], at = score[pick, all_rows], starts[pick], at[pick, all_rows]
            piece[j] = np.where(at >= 0, model.ids[at], -1)
        rows, end = np.arange(len(own)), np.full(len(own), n)
        ids, cuts = np.full((len(own), n), -2), np.zeros((len(own), n), np.int64)
        for k in range(n - 1, -1, -1):
            ids[rows, k], cuts[rows, k] = piece[end, rows], end
            end = back[end, rows]
            rows, end = rows[end > 0], end[end > 0]
            if not len(rows):
                break
        out.add(np.array(own), ids, cuts)
    _add_long(out, model, words, _long_viterbi)
    return out.result()


def merges(model: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a merge (BPE) model: in each step the neighbouring pair with the best score, leftmost of equals."""
    out = _Found(model, words)
    for n, own in _by_length(words):
        total = model.prefix(model.letters([words[i] for i in own], n))
        powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(n + 1)], np.uint64)

        def probe(rows: np.ndarray, a: np.ndarray, b: np.ndarray, total=total, powers=powers) -> np.ndarray:
            return model.probe(total[rows, b] - total[rows, a] * powers[b - a])

        cuts, index = np.tile(np.arange(n + 1), (len(own), 1)), np.arange(len(own))
        rows = index[:, None]
        at = probe(rows, cuts[:, :-2], cuts[:, 2:]) if n > 1 else np.full((len(own), 0), -1)
        score = np.where(at >= 0, model.score[at], -np.inf)
        own = np.array(own)
        while len(index):
            all_rows = np.arange(len(index))
            best = score.argmax(1) if score.shape[1] else np.zeros(len(index), np.int64)
            go = score[all_rows, best] > -np.inf if score.shape[1] else np.zeros(len(index), bool)
            if not go.all():
                rows, ends = index[~go], cuts[~go]
                at = probe(rows[:, None], ends[:, :-1], ends[:, 1:])
                out.add(own[rows], np.where(at >= 0, model.ids[at], -1), ends[:, 1:])
            index, cuts, score, best = index[go], cuts[go], score[go], best[go]
            if not len(index):
                break
            # The pair's inner cut goes, and with it the pair's own entry; the entries beside it are looked up anew.
            all_rows = np.arange(len(index))
            keep = np.ones(cuts.shape, bool)
            keep[all_rows, best + 1] = False
            cuts = cuts[keep].reshape(len(index), -1)
            keep = np.ones(score.shape, bool)
            keep[all_rows, best] = False
            score = score[keep].reshape(len(index), -1)
            for side in (best - 1, best):
                has = np.flatnonzero((side >= 0) & (side < score.shape[1]))
                if len(has):
                    k = side[has]
                    at = probe(index[has], cuts[has, k], cuts[has, k + 2])
                    score[has, k] = np.where(at >= 0, model.score[at], -np.inf)
    _add_long(out, model, words, _long_merges)
    return out.result()


_models: dict[str, Pieces] = {}
_caches: dict[tuple[str, str], PieceCache] = {}
ALGORITHMS = {"viterbi": viterbi, "merges": merges}


def _model(name: str) -> Pieces:
    if name not in _models:
        _models[name] = Pieces(name)
    return _models[name]


def _cache(name: str, algorithm: str) -> PieceCache:
    if (name, algorithm) not in _caches:
        _caches[name, algorithm] = PieceCache(lambda words: ALGORITHMS[algorithm](_model(name), words), 1_500_000)
    return _caches[name, algorithm]


class Chunks:
    """Words of UTF-8 texts, each with the spaces before it (every non-empty text gets one leading space), the distinct
    ones found once for all algorithms."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 0x20)
        offsets = offsets + np.r_[0, np.cumsum(full)]
        begin = np.zeros(len(data) + 1, bool)
        begin[offsets] = True
        begin[1:-1] |= (data[1:] == 0x20) & (data[:-1] != 0x20)
        self.starts = np.flatnonzero(begin[:-1])
        self.ends = np.r_[self.starts[1:], len(data)].astype(np.int64)
        self.raw, self.rows = data.tobytes(), np.searchsorted(self.starts, offsets)
        self.keys, self.first, self.which = np.unique(spans_hash(_RANDOM[data], self.starts, self.ends), return_index=True, return_inverse=True)

    def encoded(self, model: str, algorithm: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of each row in them)."""
        cache = _cache(model, algorithm)
        at, n = cache.of(self.keys, self.first, lambda i: self.raw[self.starts[i] : self.ends[i]].decode())
        at, n = at[self.which], n[self.which]
        return cache.ids[ragged(at, n)], np.r_[0, np.cumsum(n)][self.rows]


def encode_block(data: np.ndarray, offsets: np.ndarray, model: str = MODEL, algorithm: str = "viterbi") -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, offsets of each row in them) of UTF-8 texts; every non-empty text gets one leading space."""
    return Chunks(data, offsets).encoded(model, algorithm)


def decode_block(ids: np.ndarray, offsets: np.ndarray, model: str = MODEL) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of id rows: pieces' bytes joined, without the leading space."""
    pieces = _model(model)
    n = np.diff(pieces.text_at)[ids]
    data = pieces.text[ragged(pieces.text_at[:-1][ids], n)]
    at = np.r_[0, np.cumsum(n)][offsets]
    full = np.diff(at) > 0
    lead = at[:-1][full]
    lead = lead[data[lead] == 0x20]
    less = np.zeros(len(at), np.int64)
    less[1:] = np.cumsum(np.isin(at[:-1], lead) & full)
    return np.delete(data, lead), at - less


def encode(docs: DataFrame, model: str = MODEL, algorithm: str = "viterbi", text: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row.

    Null and empty texts give no ids. Very long texts and words are encoded whole. Of segmentations with equal scores
    the one whose last piece is longest is taken (of equal merges the leftmost). Repeated rows give repeated rows, an
    empty table none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                ids, at = encode_block(data, offsets, model, algorithm)
                rows = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], rows], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null and empty ids give an empty text, ids that spell no whole
    character a replacement mark. Repeated rows give repeated rows, an empty table none; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            n = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
            data, at = decode_block(lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(n)], model)
            text = [data[x:y].tobytes().decode(errors="replace") for x, y in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_report(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: its Viterbi ids and its merge ids, their numbers and crc32, and whether both decode to its text.
    Rows as in encode()."""
    names = ["doc_id", *(f"{a}{c}" for a in ALGORITHMS for c in ("_ids", "_n", "_crc32")), "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                columns, same, chunks = [], np.ones(b - a, bool), Chunks(data, offsets)
                for algorithm in ALGORITHMS:
                    ids, at = chunks.encoded(model, algorithm)
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
                    columns.append(pa.array(np.diff(at), pa.int64()))
                    own = ids.astype("<u4")
                    columns.append(pa.array([zlib.crc32(own[x:y].tobytes()) for x, y in zip(at, at[1:], strict=False)], pa.int64()))
                    back, to = decode_block(ids, at, model)
                    if not (np.array_equal(to, offsets) and np.array_equal(back, data)):
                        same &= [np.array_equal(back[to[i] : to[i + 1]], data[offsets[i] : offsets[i + 1]]) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *columns, pa.array(same)], names=names)

    own = ", ".join(f"{a}_ids array<int>, {a}_n long, {a}_crc32 long" for a in ALGORITHMS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {own}, round_trip boolean")


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
