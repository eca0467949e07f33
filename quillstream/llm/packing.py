"""Best-fit packing of tokenised documents into fixed-length sequences by minimum bin slack.

Lengths are integers up to the capacity, so the whole corpus is a histogram of at most `capacity` counts. Minimum bin
slack runs on that histogram: seed a bin with the longest piece left, then a bitset subset-sum over the lengths still
available finds the fullest combination, which is taken as many times as the counts allow. The plan's size depends on
the capacity alone. Pieces find their place in it by their rank among pieces of the same length; ranks come from
counts per (length, salt), so a length that a third of all pieces share is numbered in many tasks.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.stage import partitions, written
from quillstream.llm.textcore import _RANDOM, PieceCache, blocks, flattened, ragged, spans_hash

CAPACITY, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]] = True
#: Bytes that may begin white space, so that a space before them is no sure boundary.
_MAYBE_BLANK = np.zeros(256, bool)
_MAYBE_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_KIND = np.select([_LETTER, _DIGIT, _MARK], [1, 2, 3], 0).astype(np.uint8)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where the byte-level BPE's pattern surely begins a new token: a space before a visible character,
    or a change among ASCII letters, digits and marks (never next to an apostrophe). Chunks between them can be
    tokenised alone."""
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets] = True
    if len(data) > 1:
        begin[:-2] |= (data[:-1] == 0x20) & ~_MAYBE_BLANK[data[1:]]
        kind = _KIND[data]
        begin[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    return np.flatnonzero(begin[:-1])


#: The vocabulary's one added token: where a text holds it, tokenizers gives its id, and tokenises what is before and
#: behind it apart.
ADDED, ADDED_ID = "<|endoftext|>", 50256
_ADDED = re.compile(re.escape(ADDED.encode()))


def isolate_added(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """starts, with each occurrence of the added token a chunk of its own."""
    found = [m.span() for m in _ADDED.finditer(data.tobytes())]
    row = np.searchsorted(offsets, [a for a, _ in found], "right")
    for (a, b), r in zip(found, row.tolist(), strict=True):
        if b <= offsets[r]:  # not across two texts
            starts = np.r_[starts[starts < a], a, [b] if b < len(data) else np.zeros(0, int), starts[starts > b]].astype(np.int64)
    return starts


#: White space of the BPE's pattern other than what parts words.
_WIDE_BLANK = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class BpeCache(PieceCache):
    """Ids of chunks by a byte-level BPE."""

    def __init__(self, model, ranks: dict[bytes, int], most: int):
        super().__init__(lambda texts: flattened([[ADDED_ID] if t == ADDED else model.encode_ordinary(t) for t in texts]), most)
        self.model, self.size = model, np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(x) for x in ranks]

    def encode_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each, all ids) of words data[start:end] that each have a space put before them.

        The pattern always begins a token at such a space, so that they are encoded as one text; words that hold white
        space of other kinds, which could go together with the next word's space, are encoded alone."""
        size = ends - starts + 1
        stop = np.cumsum(size)
        joined = np.full(int(size.sum()), 0x20, np.uint8)
        joined[ragged(stop - size + 1, size - 1)] = data[ragged(starts, size - 1)]
        raw = joined.tobytes()
        alone = np.searchsorted(stop, [m.start() for m in _WIDE_BLANK.finditer(raw)], "right")
        cuts = np.unique(np.r_[0, (stop - size)[alone], stop[alone], len(raw)]).tolist()
        ids = [self.model.encode_ordinary(raw[a:b].decode()) for a, b in zip(cuts, cuts[1:], strict=False)]
        flat = np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in ids)])
        return np.diff(np.searchsorted(np.cumsum(self.size[flat]), stop) + 1, prepend=0), flat


_caches: dict[tuple, BpeCache] = {}


def bpe_cache(vocabulary: str, most: int = 1_000_000) -> BpeCache:
    """The worker's cache for a byte-level BPE vocabulary of the public tokenizers (its ranks file)."""
    if (vocabulary, most) not in _caches:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary)) as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
        model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _caches[vocabulary, most] = BpeCache(model, ranks, most)
    return _caches[vocabulary, most]


def token_ids(data: np.ndarray, offsets: np.ndarray, cache: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, offsets of each row in them)."""
    starts = isolate_added(data, offsets, chunk_starts(data, offsets))
    ends = np.r_[starts[1:], len(data)].astype(np.int64)
    raw = data.tobytes()
    at, n, _ = cache.look_up(spans_hash(_RANDOM[data], starts, ends), lambda i: raw[starts[i] : ends[i]].decode())
    total = np.r_[0, np.cumsum(n)]
    return cache.ids[ragged(at, n)], total[np.searchsorted(starts, offsets)]


def tokenised_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = "byte_bpe_50k.tiktoken", with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: its ids and `end_id`, cut only where longer than `capacity`.

    All pieces of a cut document are full but the first, which may be shorter. Null and empty texts give one piece
    that holds the end id alone; texts are tokenised whole. with_ids adds the ids themselves.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = bpe_cache(vocabulary)
        try:
            for batch in batches:
                ids_of = batch.column(0)
                for a, b, data, offsets in blocks(batch, "text"):
                    ids, at = token_ids(data, offsets, cache)
                    out = []
                    for row in range(b - a):
                        own = np.append(ids[at[row] : at[row + 1]], np.uint16(end_id)).astype("<u4")
                        first = len(own) % capacity or capacity
                        cuts = [0, *range(first, len(own), capacity), len(own)] if len(own) > capacity else [0, len(own)]
                        doc = ids_of[a + row].as_py()
                        for piece, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                            out.append((doc, piece, x, y - x, zlib.crc32(own[x:y].tobytes())) + ((own[x:y].astype(np.int32),) if with_ids else ()))
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names=names)
        finally:
            _caches.clear()  # a worker lives on, and later stages need its memory

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths (with repeats) whose sum is the largest reachable one up to `room`, by bitset subset sums."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, k = min(int(counts[length]), room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, []
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            taken += [length] * k
            total -= length * k
    return taken


def slack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies of the length in each sequence, offset) of every run."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used, sequence, plan = np.zeros(capacity + 1, np.int64), 0, []
    while counts.any():
        seed = int(np.flatnonzero(counts)[-1])
        counts[seed] -= 1
        lengths, copies = np.unique([seed, *fullest(counts, capacity - seed)], return_counts=True)
        counts[seed] += 1
        times = int((counts[lengths] // copies).min())
        offset = 0
        for length, m in zip(lengths[::-1].tolist(), copies[::-1].tolist(), strict=True):
            plan.append((length, int(used[length]), int(used[length]) + times * m, sequence, m, offset))
            used[length] += times * m
            offset += length * m
        counts[lengths] -= times * copies
        sequence += times
    return plan


def place(plan: list[tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (.., length, .., rank) -> the same without rank, with sequence_id and offset; other values go by untouched."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)
    starts = (table[:, 0] << 48) | table[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            _, first, _, sequence, copies, offset = table[np.searchsorted(starts, (length << 48) | rank, "right") - 1].T
            nth = rank - first
            names = [n for n in batch.schema.names if n != "rank"]
            columns = [*(batch.column(n) for n in names), pa.array(sequence + nth // copies), pa.array(offset + nth % copies * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. Needs doc_id, piece and length (1 to capacity); keeps the other columns."""
    salts = 8 * partitions(pieces.sparkSession)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = written(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    # At most `capacity` rows, whatever the corpus.
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("_own", own).join(offsets.hint("merge"), ["length", "_salt"])
    ranked = ranked.withColumn("rank", F.col("_own") + F.col("_before")).select(*pieces.columns, "rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place(slack_plan(histogram, capacity)), fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **kind) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Null or empty text: one piece of the end id. Very long texts: cut. Repeated rows: packed once each, as are rows that
    share a doc_id or have none (null stays null). Pieces of one length may stand for each other: which of them takes
    which place follows doc_id and piece. An empty table gives no rows; columns other than doc_id and text are not read.
    """
    return pack(written(tokenised_pieces(docs, capacity, **kind), "pieces"), capacity)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
