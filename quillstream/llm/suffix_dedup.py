"""Repeated byte strings by suffix arrays, over whole texts.

A string of LENGTH bytes has one anchor, the smallest hashed GRAM-byte gram in it (the rightmost of equals), and equal
strings have it at the same place. So:

1. the anchors of all strings are dealt by hash; those that occur once in the corpus are dropped;
2. around each anchor left, the bytes of all strings that have it are its context. Equal contexts are merged, and the
   contexts of an anchor go to one bucket, which sorts their suffixes: those smaller than their successor directly, the
   rest induced from these by scanning the buckets of first bytes in order. Neighbours in that order with a common prefix
   of LENGTH bytes are repeats. Suffixes too short for one are sorted only as far as others are induced from them;
3. an anchor with very many different contexts is not one group: its strings are halved by their distance from the
   anchor. All strings of a half share more bytes than those that the anchor holds, which deal them anew, and contexts
   cut down to a half agree more often. In the last of at most ten halvings a group is a single string.

Bytes are compared themselves; 64-bit hashes only deal them out and name contexts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import bucket_count, written
from quillstream.llm.substring_dedup import PACKED, Sender, distinct_rows, flags, grouped, row_key
from quillstream.llm.textcore import _RANDOM, blocks, mix, ragged, spans_hash

LENGTH, GRAM = 400, 32
GROUP = 2048  # contexts of an anchor that are sorted in one task
BUCKET_BYTES = 2 << 20
FLUSH_BYTES = 16 << 20
FEW = 1_000_000  # hot anchors, 8 bytes each, that may be broadcast
_PLACE_BITS = 20  # of a slice of a text, whose windows are looked at together
CONTEXTS = "key long, id long, content binary, base int, many boolean, least int"


def winnowed(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of each anchor, its hash, first window that has it, number of such windows) over all rows of a block."""
    width, slice_size = length - gram + 1, 1 << _PLACE_BITS
    found = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= length:
            found.append((a, b - length + 1))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    n_grams = len(data) - gram + 1
    at = np.arange(n_grams)
    hashes = spans_hash(_RANDOM[data], at, at + gram)
    windows = len(data) - length + 1
    place = np.empty(windows, np.int64)
    low = np.uint64(slice_size - 1)
    step = slice_size - width
    for x in range(0, windows, step):
        own = hashes[x : x + step + width - 1]
        local = (own & ~low) | (low - np.arange(len(own), dtype=np.uint64))
        table = np.full(-(-len(own) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        table[: len(own)] = local
        table = table.reshape(-1, width)
        # Of a window that spans two rows of the table: the smallest to the end of one and from the start of the next.
        ahead = np.minimum.accumulate(table, 1).ravel()
        behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
        m = min(step, windows - x)
        least = np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])
        place[x : x + m] = x + (low - (least & low)).astype(np.int64)
    windows = ragged(*(np.array(c) for c in zip(*[(a, b - a) for a, b in found], strict=True)))
    place = place[windows]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[first], hashes[place[first]], windows[first], np.diff(np.r_[first, len(place)])


def _types(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor; the end of a text is smaller than any byte."""
    sign = np.empty(len(data), np.int8)
    sign[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    sign[ends - 1] = -1
    decided = np.where(sign != 0, np.arange(len(sign)), len(sign) - 1)
    return sign[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def sort_directly(data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places `at` in the order of data[at:stop]: by two words of eight bytes, and bytes where these are equal. Behind
    every text there are sixteen zero bytes."""
    words = sliding_window_view(data, 8)
    word = lambda p: np.ascontiguousarray(words[p]).view(">u8")[:, 0].astype(np.uint64)
    first, second = word(at), word(at + 8)
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    edge = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]), True])
    at, stop, raw = at[order], stop[order], data.tobytes()
    out = at.copy()
    tied = np.flatnonzero(np.diff(edge) > 1)
    for a, b in zip(edge[tied].tolist(), edge[tied + 1].tolist(), strict=True):
        keys = [raw[p:q] for p, q in zip(at[a:b].tolist(), stop[a:b].tolist(), strict=True)]
        out[a:b] = at[a:b][sorted(range(b - a), key=keys.__getitem__)]
    return out


def suffix_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """The suffixes of texts data[start:end] of at least `length` bytes, sorted (by their first `length` bytes at least),
    and those that they are induced from among them."""
    smaller = _types(data, ends)
    places = np.append(np.flatnonzero(smaller), len(data))
    # A text's suffixes from its start to the first directly sorted one that is too short, or to its end.
    last = places[np.searchsorted(places, ends - length)]
    to_end = last >= ends
    sorted_too = np.zeros(len(data), bool)
    sorted_too[ragged(starts, np.where(to_end, ends, last + 1) - starts)] = True
    text_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))
    direct = np.flatnonzero(smaller & sorted_too)
    direct = sort_directly(data, direct, np.minimum(direct + length, ends[text_of[direct]]))
    induced = sorted_too & ~smaller
    is_first = np.zeros(len(data), bool)
    is_first[starts] = True
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def scan(places: np.ndarray) -> None:
        """Predecessors that are larger than these suffixes wait, in this order, in the bucket of their first byte."""
        before = places[~is_first[places]] - 1
        wait(before[induced[before]])

    def wait(before: np.ndarray) -> None:
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        edge = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else []
        for a, b in zip(edge, np.append(edge[1:], len(byte)) if len(byte) else [], strict=True):
            waiting[byte[a]].append(before[a:b])

    wait(ends[to_end] - 1)
    out, bounds = [], np.searchsorted(data[direct], np.arange(257))
    for byte in range(256):
        # Suffixes that start with a run of this byte wait while the bucket is scanned.
        while waiting[byte]:
            now = np.concatenate(waiting[byte])
            waiting[byte] = []
            out.append(now)
            scan(now)
        out.append(own := direct[bounds[byte] : bounds[byte + 1]])
        scan(own)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int, each: int = 4096) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to `length`."""
    rows = sliding_window_view(data, length)
    out = np.empty(len(a), np.int64)
    for x in range(0, len(a), each):
        same = rows[a[x : x + each]] == rows[b[x : x + each]]
        out[x : x + each] = np.where(same.all(1), length, same.argmin(1))
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Of every text (of at least `length` bytes), which of its strings of `length` bytes start again anywhere."""
    size = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.r_[0, size[:-1] + 16])
    data = np.frombuffer(b"".join(t + bytes(16) for t in texts), np.uint8)
    ends = starts + size
    long_enough = np.zeros(len(data), bool)
    long_enough[ragged(starts, size - length + 1)] = True
    order = suffix_order(data, starts, ends, length)
    order = order[long_enough[order]]
    again = common_prefixes(data, order[:-1], order[1:], length) == length
    hit = np.zeros(len(data), bool)
    hit[order[:-1][again]] = True
    hit[order[1:][again]] = True
    return [hit[a : b - length + 1] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _runs(hit: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of True, flat."""
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].view(np.int8)))
    return edge.astype("<i8")


class _Contexts:
    """Gathers the contexts of a task; equal ones are one row, with all their occurrences."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.held: dict[bytes, list] = {}
        self.bytes = 0

    def add(self, key: int, content_id: int, content: bytes, base: int, many: bool, row: int, start: int) -> None:
        own = self.held.get(content)
        if own is None:
            own = self.held[content] = [key, content_id, base, many, [], []]
            self.bytes += len(content)
        own[4].append(row)
        own[5].append(start)
        self.bytes += 16

    def flush(self) -> Iterator[pa.RecordBatch]:
        rows = list(self.held.items())
        for a in range(0, len(rows), 5000):
            part = rows[a : a + 5000]
            columns = [
                pa.array([x[0] for _, x in part], pa.int64()),
                pa.array([x[1] for _, x in part], pa.int64()),
                pa.array([c for c, _ in part], pa.binary()),
                pa.array([x[2] for _, x in part], pa.int32()),
                pa.array([x[3] or len(x[4]) > 1 for _, x in part], pa.bool_()),
                pa.array(np.zeros(len(part), np.int32)),
                pa.array([np.array(x[4], "<i8").tobytes() for _, x in part], pa.binary()),
                pa.array([np.array(x[5], "<i8").tobytes() for _, x in part], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*_names(CONTEXTS), "rows", "starts"])
        self.clear()


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def shared_contexts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of all anchors that occur more than once in docs(row, text, many): CONTEXTS with the rows and places
    where each starts, merged within tasks. many: equal to another context's bytes, or of a row that stands for several."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = bucket_count(spark, 2 * size / (length - gram + 2))  # anchors of random text

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, np.int64)
        for batch in batches:
            ids, many = batch.column("row").to_numpy(), batch.column("many").to_numpy(zero_copy_only=False)
            for a, _, data, offsets in blocks(batch, "text"):
                place, key, first, n = winnowed(data, offsets, length, gram)
                row = np.searchsorted(offsets, place, "right") - 1
                # Where the anchor is in its text, in its context, and how many windows the context has.
                packed = ((place - offsets[row]) << 20) | ((place - first) << 10) | (n - 1)
                yield from sender.add(key, ids[a + row], packed, key, many[a + row])
        yield from sender.flush()

    shared = flags(docs.mapInArrow(seeds, PACKED), np.int64).groupBy("row").agg(F.collect_list("places").alias("seeds"))
    seeded = docs.join(shared.hint("merge"), "row").select("row", "text", "many", "seeds")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Contexts()
        for batch in batches:
            ids, many, lists = batch.column("row").to_pylist(), batch.column("many").to_pylist(), batch.column("seeds")
            for a, b, data, offsets in blocks(batch, "text"):
                own = [np.concatenate([np.frombuffer(x, np.int64) for x in lists[r].as_py()]) for r in range(a, b)]
                row = np.repeat(np.arange(b - a), [len(x) for x in own])
                packed = np.concatenate(own)
                place, base, n = offsets[row] + (packed >> 20), (packed >> 10) & 1023, (packed & 1023) + 1
                start = place - base
                end = start + n - 1 + length
                values = _RANDOM[data]
                key = spans_hash(values, place, place + gram).view(np.int64).tolist()
                content_id = spans_hash(values, start, end).view(np.int64).tolist()
                raw = data.tobytes()
                for k, (r, x, y) in enumerate(zip(row.tolist(), start.tolist(), end.tolist(), strict=True)):
                    held.add(key[k], content_id[k], raw[x:y], int(base[k]), many[a + r], ids[a + r], x - int(offsets[r]))
                if held.bytes > FLUSH_BYTES:
                    yield from held.flush()
        yield from held.flush()

    return written(seeded.mapInArrow(cut, CONTEXTS + ", rows binary, starts binary"), "contexts")


def merged(contexts: DataFrame) -> DataFrame:
    """One row for each context, where it is dealt by key or by what follows from key."""
    # Two contexts with one id are one that occurs more than once.
    keys = [c for c in ("bucket", "key") if c in contexts.columns]
    return contexts.groupBy(*keys, "id").agg(F.first("content").alias("content"), F.first("base").alias("base"), (F.max("many") | (F.count(F.lit(1)) > 1)).alias("many"), F.first("least").alias("least"))


def halves(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """Contexts of strings that start `least` to least + width - 1 bytes before the anchor, cut down to those of each half
    of that range, under a key of what all strings of the half have in common; parent_key, parent_id and shift tell from
    which context each is cut, and where."""
    half = width // 2
    code = lambda own: spans_hash(_RANDOM[np.frombuffer(own, np.uint8)], np.array([0]), np.array([len(own)]))
    signed = lambda x: int(x.view(np.int64)[0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                content, base = row["content"], row["base"]
                n = len(content) - length + 1
                for least in (row["least"], row["least"] + half):
                    far, near = min(base, least + half - 1), max(base - n + 1, least)
                    if near > far:
                        continue
                    own = content[base - far : base - near + length]
                    common = content[base - least : base - least - half + 1 + length]
                    above = mix(np.array([row["key"]], np.int64).view(np.uint64) + np.uint64(least * width + half))
                    out.append((signed(mix(code(common) ^ above)), signed(code(own)), own, far, row["many"], least, row["key"], row["id"], base - far))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*_names(CONTEXTS), "parent_key", "parent_id", "shift"])

    return contexts.select(*_names(CONTEXTS)).mapInArrow(cut, CONTEXTS + ", parent_key long, parent_id long, shift long")


def sorted_suffixes(contexts: DataFrame, length: int) -> DataFrame:
    """(key, id, spans): runs of windows (int64 starts and ends, from the context's start) that start again elsewhere."""
    spark = contexts.sparkSession
    size = contexts.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
    bucket = F.pmod(F.col("key"), F.lit(bucket_count(spark, size, BUCKET_BYTES))).cast("int")
    # Dealt once, by bucket: what follows is settled in the same partition.
    dealt = merged(contexts.select(bucket.alias("bucket"), *_names(CONTEXTS)).repartition("bucket"))

    def repeats(table: pa.Table) -> pa.Table:
        hits = repeated_windows(table.column("content").to_pylist(), length)
        spans = [_runs(np.ones(len(h), bool) if many else h).tobytes() for h, many in zip(hits, table.column("many").to_pylist(), strict=True)]
        out = pa.table({"key": table.column("key"), "id": table.column("id"), "spans": pa.array(spans, pa.binary())})
        return out.filter(pa.compute.greater(pa.compute.binary_length(out.column("spans")), 0))

    return dealt.groupBy("bucket").applyInArrow(repeats, "key long, id long, spans binary")


def repeated_contexts(contexts: DataFrame, length: int, width: int, group: int = GROUP) -> DataFrame:
    """(key, id, spans) of written CONTEXTS whose strings start within `width` places before the anchor; in one or more
    rows for each context."""
    hot = contexts.select("key", "id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
    hot = written(hot.select("key"), "hot-anchors")
    n_hot = hot.count()
    if not n_hot or width == 1:  # strings of one place that share a key are one string
        return sorted_suffixes(contexts, length)
    hot = hot.hint("broadcast" if n_hot <= FEW else "merge")
    found = sorted_suffixes(contexts.join(hot, "key", "left_anti"), length)
    parts = written(halves(merged(contexts.join(hot, "key", "left_semi")), length, width), "halves")
    below = written(repeated_contexts(parts, length, width // 2, group), "repeats")

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, own, shift, spans = (batch.column(c) for c in ("parent_key", "parent_id", "shift", "spans"))
            moved = [(np.frombuffer(x, "<i8") + d).tobytes() for x, d in zip(spans.to_pylist(), shift.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([key, own, pa.array(moved, pa.binary())], names=["key", "id", "spans"])

    back = parts.select("key", "id", "parent_key", "parent_id", "shift").join(below.hint("merge"), ["key", "id"])
    return found.unionByName(back.mapInArrow(shifted, "key long, id long, spans binary"))


def repeated_spans(docs: DataFrame, length: int, gram: int, group: int = GROUP) -> DataFrame:
    """(row, spans): runs of places of docs(row, text, many) where a string of `length` bytes starts that starts at least
    twice, as int64 starts and ends; in several lists each."""
    contexts = shared_contexts(docs, length, gram)
    width = 1 << (length - gram).bit_length()
    found = written(repeated_contexts(contexts.select(*_names(CONTEXTS)), length, width, group), "repeats")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, of = [], []
            for rows, starts, spans in zip(*(batch.column(c).to_pylist() for c in ("rows", "starts", "spans")), strict=True):
                own = np.frombuffer(spans, "<i8").reshape(-1, 2)
                of.append((np.frombuffer(starts, "<i8")[:, None, None] + own).reshape(-1, 2))
                at.append(np.repeat(np.frombuffer(rows, "<i8"), len(own)))
            if at:
                yield from grouped(np.concatenate(at), np.concatenate(of)).to_batches()

    joined = contexts.select("key", "id", "rows", "starts").join(found.hint("merge"), ["key", "id"])
    return joined.select("rows", "starts", "spans").mapInArrow(placed, "row long, places binary").groupBy("row").agg(F.collect_list("places").alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_bytes: bool = True, group: int = GROUP) -> DataFrame:
    """Removes every byte covered by a string of `length` bytes that also starts elsewhere, in the same text or another.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal runs removed), kept_sha256 and, with_bytes, kept (the bytes left,
    which need not be whole characters). Strings are judged on the input. Null and empty texts have no bytes; texts
    shorter than `length` lose none; very long ones are read whole. Rows that repeat a text are copies of each other and
    lose all of its strings, whether they share a doc_id or not; a null doc_id stays null. An empty table gives no rows;
    other columns are not read. `length` is at most 1024; `group`: contexts of one anchor sorted in one task, more are
    halved.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.select(row_key().alias("row"), "doc_id", "text")
    spans = repeated_spans(distinct_rows(docs.select("row", "text")), length, gram, group)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                edge = np.zeros(len(data) + 1, np.int32)
                for row, lists in enumerate(batch.column("spans")[a:b].to_pylist()):
                    for own in lists or ():
                        start, end = np.frombuffer(own, "<i8").reshape(-1, 2).T + offsets[row]
                        np.add.at(edge, start, 1)
                        np.add.at(edge, end - 1 + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inside = offsets[:-1][offsets[:-1] < len(data)]
                opens[inside] = gone[inside]
                per_row = lambda at: np.bincount(np.searchsorted(offsets, at, "right") - 1, minlength=b - a)  # noqa: B023, E731
                removed = per_row(np.flatnonzero(gone))
                left, size = data[~gone].tobytes(), np.diff(offsets)
                ends = np.cumsum(size - removed).tolist()
                kept = [left[x:y] for x, y in zip([0, *ends], ends, strict=False)]
                columns = [batch.column("doc_id")[a:b], pa.array(size), pa.array(removed), pa.array(per_row(np.flatnonzero(opens))), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                if with_bytes:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=_names(schema))

    return docs.join(spans.hint("merge"), "row", "left").select("doc_id", "text", "spans").mapInArrow(cut, schema)


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_bytes=False)


SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS key FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM texts)),
repeated AS (SELECT doc_id, i FROM windows JOIN (SELECT key FROM windows GROUP BY key HAVING count(*) > 1) USING (key)),
opened AS (SELECT *, coalesce(i - lag(i) OVER w > 400, true) AS opens FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM opened) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1000000000) AS next FROM (SELECT * FROM runs UNION ALL SELECT doc_id, -1, 0 FROM texts)),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * b + 1, 2 * (next - b)), '' ORDER BY b) AS h FROM gaps g JOIN texts USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, len(t.h) // 2 AS n_bytes, (len(t.h) - len(k.h)) // 2 AS n_removed, (SELECT count(*) FROM runs r WHERE r.doc_id = t.doc_id) AS n_spans, sha256(unhex(k.h)) AS kept_sha256 FROM texts t JOIN kept k USING (doc_id)
"""
