"""Repeated passages by seed and extend, over whole texts.

A match of WINDOW words holds, at the same place in both copies, the smallest hashed SEED-word gram of its grams, since
equal words have equal grams: winnowing with WINDOW - SEED + 1 grams a window picks it in both. So:

1. seeds: the winnowed anchors of all texts are dealt by hash, and those that occur once in the corpus are dropped;
2. extend: around each seed left, the windows that hold it as their anchor, up to WINDOW - SEED words to both sides,
   are dealt by the hash of their words; those that occur once are dropped. Neighbouring windows that are left are the
   maximal repeats: a run of r of them is a repeat of r + WINDOW - 1 words.

Extension compares fingerprints of whole windows rather than pairs of occurrences, so a passage shared by a third of all
documents costs a row per occurrence, not per pair. Hashes have 64 bits; each task sends a hash once for all of its own
occurrences, so copies inside a task are settled there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import bucket_count, free_name, map_batches, to_buckets
from quillstream.llm.textcore import Words, blocks, ragged

WINDOW, SEED = 35, 12
SPANS = "_repeated_spans_"  # added beside the columns of a table of documents
FLUSH = 1 << 21
PACKED = "bucket int, keys binary, seen binary, docs binary, places binary, row long"
REPEATED = "row long, places binary"


def row_key() -> Column:
    """What tells rows apart: a hash of doc_id, which may be null or shared, and text. Rows that agree in both are copies
    of each other and lose the same words."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def distinct_rows(docs: DataFrame) -> DataFrame:
    """(row, text, many) with one row for those of docs(row, text) that are copies of each other; many: it stands for
    several. Texts are exchanged for that only if there are such rows at all, which their keys tell."""
    if docs.groupBy("row").count().where("count > 1").isEmpty():
        return docs.withColumn("many", F.lit(False))
    return docs.groupBy("row").agg(F.first("text").alias("text"), (F.count(F.lit(1)) > 1).alias("many"))


def anchors(words: Words, hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of all windows, first word of each window's anchor, hash of each gram).

    A window's anchor is its smallest gram hash, the rightmost of equals.
    """
    grams, gram_hash = words.windows(hashes, seed)
    width = window - seed + 1
    full = np.full(max(len(hashes), 1), np.iinfo(np.uint64).max, np.uint64)
    full[grams] = gram_hash
    at = np.arange(max(0, len(hashes) - window + 1))
    starts = at[words.row[at] == words.row[at + window - 1]] if len(at) else at
    if not len(starts):
        return starts, starts, full
    # Smallest of `width` neighbours by doubling: least[i] covers full[i : i + size]; places break ties to the right.
    least, place, size = full, np.arange(len(full)), 1
    while size < width:
        step = min(size, width - size)
        n = len(least) - step
        later = least[step:] <= least[:n]
        least, place = np.where(later, least[step:], least[:n]), np.where(later, place[step:], place[:n])
        size += step
    return starts, place[starts], full


def flags(bucketed: DataFrame, kind=np.int32) -> DataFrame:
    """(row, places) of the keys seen more than once, in several rows a document; rows without keys are settled."""

    def repeated(table: pa.Table) -> pa.Table:
        def column(name, dtype):
            return np.frombuffer(b"".join(fresh.column(name).to_pylist()), dtype)

        fresh = table.filter(pa.compute.is_valid(table.column("keys")))
        keys, seen, docs, places = column("keys", np.uint64), column("seen", np.uint8), column("docs", np.int64), column("places", kind)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        same = np.r_[False, keys[1:] == keys[:-1], False] if len(keys) else np.zeros(1, bool)
        hit = np.empty(len(keys), bool)
        hit[order] = same[1:] | same[:-1]
        hit &= seen == 1  # what a task has seen more than once, it has settled itself
        settled = table.filter(pa.compute.is_null(table.column("keys"))).select(["row", "places"])
        return pa.concat_tables([grouped(docs[hit], places[hit]), settled])

    return bucketed.groupBy("bucket").applyInArrow(repeated, REPEATED)


def grouped(docs: np.ndarray, places: np.ndarray) -> pa.Table:
    order = np.argsort(docs, kind="stable")
    docs, places = docs[order], places[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
    ends = np.append(first, len(docs))[1:]
    rows = [places[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
    return pa.table({"row": pa.array(docs[first], pa.int64()), "places": pa.array(rows, pa.binary())})


class Sender:
    """Gathers (key, doc, place) of a task; sends each key once, with 2 for keys seen more often, and gives those
    repeated inside the task as (row, places) rows without keys, dealt evenly. kind: the type of places."""

    def __init__(self, buckets: int, kind=np.int32):
        self.buckets, self.kind, self.parts, self.n = buckets, kind, [], 0

    def add(self, keys: np.ndarray, docs: np.ndarray, places: np.ndarray, deal: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        """deal: what decides a key's bucket; the same for equal keys. many: keys of rows that stand for several."""
        self.parts.append((keys, docs, places.astype(self.kind), deal, many))
        self.n += len(keys)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys, docs, places, deal, many = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        _, first, inverse, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        again = (times + np.bincount(inverse, many, len(times)))[inverse] > 1
        sent = np.zeros(len(keys), bool)
        sent[first] = True
        # In the order of documents, which packs well.
        rows = list(to_buckets(keys[sent], [1 + again[sent].astype(np.uint8), docs[sent], places[sent]], self.buckets, deal[sent]))
        own = grouped(docs[again], places[again])
        bucket = [b for b, _ in rows] + [i % self.buckets for i in range(len(own))]
        none = [None] * len(own)
        columns = [pa.array([x[k] for _, x in rows] + none, pa.binary()) for k in range(3)]
        columns.append(pa.array([x[3] for _, x in rows] + own.column(1).to_pylist(), pa.binary()))
        columns.append(pa.array([None] * len(rows) + own.column(0).to_pylist(), pa.int64()))
        batch = pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *columns], names=["bucket", "keys", "seen", "docs", "places", "row"])
        for a in range(0, len(batch), 2000):
            yield batch[a : a + 2000]


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(row, places) with the first words (int32, little-endian) of all windows of `window` words whose word sequence
    starts at least twice in docs(row, text, many), whose rows differ. In several rows each."""
    # Windows are dealt by their anchor, so that neighbours come back together: few rows for each document. Of a window
    # for each word, of some six bytes, a part is sent.
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = bucket_count(docs.sparkSession, size / 12)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets)
        for batch in batches:
            ids, many = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for a, _, data, offsets in blocks(batch, "text"):
                words = Words(data, offsets)
                _, anchor, gram_hash = anchors(words, words.hashes(), window, seed)
                anchor = np.unique(anchor)
                row = words.row[anchor]
                yield from sender.add(gram_hash[anchor], ids[a + row], anchor - words.first[row], gram_hash[anchor], many[a + row])
        yield from sender.flush()

    shared = flags(docs.mapInArrow(seeds, PACKED)).groupBy("row").agg(F.collect_list("places").alias("seeds"))
    seeded = docs.join(shared.hint("merge"), "row").select("row", "text", "many", "seeds")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets)
        for batch in batches:
            ids, many, lists = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3)
            for a, b, data, offsets in blocks(batch, "text"):
                words = Words(data, offsets)
                hashes = words.hashes()
                _, anchor, gram_hash = anchors(words, hashes, window, seed)
                shared_at = np.zeros(len(hashes), bool)
                for row in range(b - a):
                    for places in lists[a + row].as_py():
                        found = words.first[row] + np.frombuffer(places, np.int32)
                        shared_at[found[found < words.first[row + 1]]] = True
                at, window_hash = words.windows(hashes, window)
                keep = shared_at[anchor]
                row = words.row[at[keep]]
                yield from sender.add(window_hash[keep], ids[a + row], at[keep] - words.first[row], gram_hash[anchor[keep]], many[a + row])
        yield from sender.flush()

    return flags(seeded.mapInArrow(extend, PACKED))


def covered(n_words: int, places: list[bytes], window: int) -> np.ndarray:
    """Which of a text's words a window at one of the places covers."""
    edge = np.zeros(n_words + 1, np.int64)
    for own in places:
        at = np.frombuffer(own, np.int32)
        at = at[at + window <= n_words]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[:-1] > 0


def _cut(rows: Words, batch: pa.RecordBatch, a: int, b: int, spans: int, window: int) -> np.ndarray:
    """Which words of rows a to b of a batch are covered by the windows in its column `spans`."""
    n = np.diff(rows.first)
    gone = np.zeros(len(rows.starts), bool)
    for row in range(b - a):
        if places := batch.column(spans)[a + row].as_py():
            gone[rows.first[row] : rows.first[row + 1]] = covered(int(n[row]), places, window)
    return gone


def _kept_texts(words: Words, gone: np.ndarray, rows: int) -> list[bytes]:
    """The words left of every row, joined by one space."""
    starts, lengths, row_of = words.starts[~gone], (words.ends - words.starts)[~gone], words.row[~gone]
    spaced = np.append(words.data, np.uint8(0x20))
    index = ragged(starts, lengths + 1)
    index[np.cumsum(lengths + 1) - 1] = len(words.data)
    joined = spaced[index].tobytes()
    ends = np.cumsum(np.bincount(row_of, lengths + 1, rows).astype(np.int64))
    return [joined[x : max(x, y - 1)] for x, y in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]


def _with_spans(docs: DataFrame, window: int, seed: int) -> DataFrame:
    plain = docs.select(row_key().alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = repeated_spans(distinct_rows(plain), window, seed).groupBy("row").agg(F.collect_list("places").alias(SPANS))
    row = free_name(docs, "_row")
    keyed = docs.withColumn(row, row_key())
    return keyed.join(spans.withColumnRenamed("row", row).hint("merge"), row, "left").drop(row)


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """Removes every word covered by a window that also starts elsewhere, in the same text or another.

    Returns doc_id, n_words, n_removed, kept_sha256 and, with_text, kept_text (the words left, joined by one space).
    Windows are judged on the input. Null and empty texts have no words; texts shorter than a window lose none; very
    long texts are read whole; rows repeated with the same text are copies of each other and lose all their windows.
    Rows that share a doc_id, or have none, are told apart by their texts. An empty table gives no rows; other columns
    are not read. Windows and rows are compared by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                words = Words(data, offsets)
                gone = _cut(words, batch, a, b, 2, window)
                kept = _kept_texts(words, gone, b - a)
                columns = [batch.column(0)[a:b], pa.array(np.diff(words.first), pa.int64()), pa.array(np.bincount(words.row[gone], minlength=b - a), pa.int64())]
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept]))
                if with_text:
                    columns.append(pa.array([x.decode() for x in kept], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return _with_spans(docs, window, seed).select("doc_id", "text", SPANS).mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """docs with the words of repeated windows taken out of text (and n_chars set to what is left, where there is such
    a column); texts that lose nothing stay as they are, white space included. Columns and other values are kept."""
    schema = docs.schema
    place = schema.names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text"):
                words = Words(data, offsets)
                gone = _cut(words, batch, a, b, len(schema), window)
                kept = _kept_texts(words, gone, b - a)
                lost = np.bincount(words.row[gone], minlength=b - a) > 0
                own = batch[a:b]
                texts = [k.decode() if cut_down else t for k, t, cut_down in zip(kept, own.column(place).to_pylist(), lost.tolist(), strict=True)]
                columns = list(own.columns[:-1])
                columns[place] = pa.array(texts, columns[place].type)
                if "n_chars" in schema.names:
                    k = schema.names.index("n_chars")
                    sizes = [len(t or "") if cut_down else n for t, n, cut_down in zip(texts, columns[k].to_pylist(), lost.tolist(), strict=True)]
                    columns[k] = pa.array(sizes, columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(_with_spans(docs, window, seed).select(*[F.col(f"`{c}`") for c in schema.names], SPANS), cut, schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)


SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS key FROM (SELECT *, unnest(range(1, len(words) - 33)) AS i FROM texts)),
repeated AS (SELECT key FROM windows GROUP BY key HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows JOIN repeated USING (key)),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(l.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id) LEFT JOIN lost l USING (doc_id)
"""
