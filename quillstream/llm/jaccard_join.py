"""Exact Jaccard join of shingle sets by PartEnum signatures, and the components of its links.

Sets with 100 * intersection >= 75 * union differ in at most (|a| + |b|) / 7 shingles. The sizes are divided into bands,
and a band divides the shingle domain in two levels: n1 parts, each of SUBS sub-parts. Of every part a set enumerates
the subsets of SUBS - 1 sub-parts; a signature is the hash of (band, part, subset, the set's shingles there). A set emits
those whose shingles are not none, for its own band and for the next one where a linked set may lie in it.

One differing shingle in a part leaves the subset without its sub-part equal, a second one at most none. So of a set's
signatures a linked set lacks at most 2k (k + n1, where k > n1; k: the shingles that they may differ by), and each set
needs only that many plus one, the rarest first by (count, signature) over the corpus: the rarest that two linked sets
share is among those of both. Signatures that one set alone has are counted among them, so a set without near copies
keeps none, and those of boilerplate fall away. Small sets that have no more signatures than they may lack also emit
those without shingles.

Sets that share a kept signature are linked up without listing all pairs: in each round every signature picks pivots,
all others are compared with them in full, and sets of one component need no more comparing. Rounds go on, with twice
the pivots, until no signature spans two components that have not been compared. Copies are one set from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.components import components
from quillstream.llm.exact_dedup import one_of_each_key, row_key
from quillstream.llm.stage import bucket_count, free_name, sized, to_buckets, written
from quillstream.llm.textcore import Words, blocks, mix, ragged

SHINGLE = 5
BAND, SUBS = 80, 3  # sizes up to BAND * 2**level; sub-parts of a part
PART_SHARE = 0.6  # parts of a band for each shingle that its largest sets may differ by: above 0.5, so that one has at most one difference
FLUSH = 1 << 21
BITS = 1024
FEW = 2_000_000  # representatives whose ids may be broadcast (16 MB); beyond, the texts are shuffled
EMPTY = np.uint64(0x5BD1E9955BD1E995)


class Sets:
    """Distinct shingles of each row, sorted by (row, hash), with the size and a 64-bit identity of each row's set."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE):
        words = Words(data, offsets, lower=True)
        hashes = words.hashes()
        at, value = words.windows(hashes, shingle)
        row = words.row[at]
        n_words = np.diff(words.first)
        short = np.flatnonzero((n_words > 0) & (n_words < shingle))
        if len(short):
            whole = np.array([_sequence(hashes[words.first[r] : words.first[r + 1]]) for r in short.tolist()], np.uint64)
            row, value = np.r_[row, short], np.r_[value, whole]
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        if len(row):
            new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
            row, value = row[new], value[new]
        self.row, self.value = row, value
        self.rows = len(offsets) - 1
        self.size = np.bincount(row, minlength=self.rows)
        self.first = np.r_[0, np.cumsum(self.size)]
        self.identity = mix(_row_sums(mix(value + np.uint64(1)), row, self.rows) + self.size.astype(np.uint64)).view(np.int64)


def _sequence(hashes: np.ndarray) -> int:
    out = len(hashes)
    for h in hashes.tolist():
        out = (out * 0x9E3779B97F4A7C15 + h) & (1 << 64) - 1
    return out


def _row_sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    total = np.r_[np.uint64(0), np.cumsum(values, dtype=np.uint64)]
    edge = np.searchsorted(row, np.arange(rows + 1))
    return total[edge[1:]] - total[edge[:-1]]


def level_of(size: np.ndarray) -> np.ndarray:
    return np.maximum(0, np.ceil(np.log2(np.maximum(size, 1) / BAND))).astype(np.int64)


def parts_of(level: np.ndarray) -> np.ndarray:
    """n1 of a band."""
    return np.ceil(PART_SHARE * (2 * (BAND << np.minimum(level, 40)) // 7)).astype(np.int64)


def signatures(sets: Sets, rows: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some rows at a level each: (place among rows, signature) of every subset of sub-parts that has shingles, and
    how many signatures of each row may be dropped. The lowest bit of a signature is its level's."""
    size = sets.size[rows]
    index = ragged(sets.first[rows], size)
    place = np.repeat(np.arange(len(rows)), size)
    value = sets.value[index]
    n_parts = parts_of(level)
    if not len(index):
        return place, value, np.zeros(len(rows), np.int64)
    # Hashes are sorted, so a row's sub-parts come in order.
    fine = (((value >> np.uint64(32)) * (SUBS * n_parts)[place].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (fine[1:] != fine[:-1])])
    total = np.r_[np.uint64(0), np.cumsum(mix(value + np.uint64(7)), dtype=np.uint64)]
    content = total[np.r_[new[1:], len(index)]] - total[new]
    place, part, sub = place[new], fine[new] // SUBS, fine[new] % SUBS
    # A row of contents for each part that has shingles; a subset is named by the sub-part that it leaves out.
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])])
    nth = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(place))))
    contents, filled = np.zeros((len(first), SUBS), np.uint64), np.zeros((len(first), SUBS), np.int64)
    contents[nth, sub], filled[nth, sub] = content, 1
    contents = contents.sum(1, keepdims=True, dtype=np.uint64) - contents
    at, left_out = np.nonzero(filled.sum(1, keepdims=True) - filled)
    place, subset, content = place[first][at], part[first][at] * SUBS + left_out, contents[at, left_out]
    k = (size + np.minimum(BAND << np.minimum(level, 40), size * 4 // 3)) // 7
    drop = np.bincount(place, minlength=len(rows)) - (k + np.minimum(k, n_parts)) - 1
    for r in np.flatnonzero(drop < 0).tolist():
        missed = np.setdiff1d(np.arange(SUBS * n_parts[r]), subset[place == r])
        place, subset, content = np.r_[place, np.full(len(missed), r)], np.r_[subset, missed], np.r_[content, np.full(len(missed), EMPTY)]
    own_level = level[place].astype(np.uint64)
    key = mix(content + mix(subset.astype(np.uint64) * np.uint64(64) + own_level + np.uint64(99)))
    return place, (key & ~np.uint64(1)) | (own_level & np.uint64(1)), np.maximum(drop, 0)


def _levels(sets: Sets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, level): each row's own band, then the next one where a linked set may lie in it."""
    rows = np.flatnonzero(sets.size)
    own = level_of(sets.size[rows])
    yield rows, own
    above = level_of(sets.size[rows] * 4 // 3)
    yield rows[above > own], above[above > own]


def _blocks(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, Sets]]:
    for batch in batches:
        for a, b, data, offsets in blocks(batch, "text"):
            yield batch[a:b], Sets(data, offsets, shingle)


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_id (equal for equal sets, null for none), and per level how many signatures may be
    dropped: drop_0 at even levels, drop_1 at odd ones; then the columns of docs(doc_id, text, ..) beyond the second."""
    others = docs.schema[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, sets in _blocks(batches, shingle):
            drop = np.zeros((2, sets.rows), np.int64)
            for rows, level in _levels(sets):
                drop[level % 2, rows] = signatures(sets, rows, level)[2]
            columns = [own.column(0), pa.array(sets.size, pa.int64()), pa.array(sets.identity, mask=sets.size == 0), pa.array(drop[0]), pa.array(drop[1])]
            yield pa.RecordBatch.from_arrays(columns + own.columns[2:], names=["doc_id", "n_shingles", "set_id", "drop_0", "drop_1", *names])

    names = [f.name for f in others]
    return docs.mapInArrow(run, ", ".join(["doc_id long, n_shingles long, set_id long, drop_0 long, drop_1 long", *(f"{f.name} {f.dataType.simpleString()}" for f in others)]))


def shared_signatures(docs: DataFrame, buckets: int, shingle: int = SHINGLE) -> DataFrame:
    """(set_id, signature, n) of all signatures that at least two different sets have; n: how many do."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        sent: np.ndarray = np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            keys, sets = (np.concatenate(x) for x in zip(*parts, strict=True))
            rows = list(to_buckets(keys, [sets], buckets))
            columns = [pa.array([b for b, _ in rows], pa.int32())] + [pa.array([x[k] for _, x in rows], pa.binary()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "sets"])

        for _, sets in _blocks(batches, shingle):
            _, first = np.unique(sets.identity, return_index=True)
            fresh = np.zeros(sets.rows, bool)
            fresh[first] = True
            fresh &= ~np.isin(sets.identity, sent)  # copies met before in this task
            sent = np.r_[sent, sets.identity[fresh]][-100_000:]
            for rows, level in _levels(sets):
                rows, level = rows[fresh[rows]], level[fresh[rows]]
                place, key, _ = signatures(sets, rows, level)
                parts.append((key, sets.identity[rows][place]))
            if sum(len(k) for k, _ in parts) >= FLUSH:
                yield flush()
                parts.clear()
        if parts:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        sets = np.frombuffer(b"".join(table.column("sets").to_pylist()), np.int64)
        # Keys that occur once, most of all, go first; the few others are made distinct.
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        keys, sets = keys[order], sets[order]
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])][: len(keys)]
        keys, sets = keys[new], sets[new]
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        n = n[inverse] if len(keys) else np.zeros(0, np.int64)
        return pa.table({"set_id": sets[n > 1], "signature": keys[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

    packed = docs.mapInArrow(send, "bucket int, keys binary, sets binary")
    return packed.groupBy("bucket").applyInArrow(count, "set_id long, signature long, n long")


def representatives_shingles(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(set_id, n_shingles, shingles, bits) of each set of wanted(doc_id, set_id), once. Its shingles are taken from
    rows with that doc_id, or from those without one where it is null; such rows may repeat and may hold other sets.

    bits: the parity of the number of shingles that fall on each of BITS places. Where two sets' bits differ, so does
    at least one shingle for each, so their number bounds the sets' difference from below.
    """
    few = "broadcast" if wanted.count() <= FEW else "shuffle_hash"
    chosen = docs.join(wanted.select("doc_id").hint(few), "doc_id", "left_semi")
    if not wanted.where("doc_id is null").isEmpty():
        chosen = chosen.unionByName(docs.where("doc_id is null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _blocks(batches, shingle):
            lists = pa.LargeListArray.from_arrays(pa.array(sets.first, pa.int64()), pa.array(sets.value.view(np.int64))).cast(pa.list_(pa.int64()))
            at = sets.row * BITS + (sets.value % np.uint64(BITS)).astype(np.int64)
            odd = np.bincount(at, minlength=sets.rows * BITS).astype(np.uint8) & 1
            words = np.packbits(odd).view(np.int64)
            bits = pa.ListArray.from_arrays(pa.array(np.arange(sets.rows + 1) * (BITS // 64), pa.int32()), pa.array(words))
            yield pa.RecordBatch.from_arrays([pa.array(sets.identity), pa.array(sets.size, pa.int64()), lists, bits], names=["set_id", "n_shingles", "shingles", "bits"])

    found = chosen.mapInArrow(run, "set_id long, n_shingles long, shingles array<long>, bits array<long>")
    return found.join(wanted.select("set_id").hint(few), "set_id", "left_semi").dropDuplicates(["set_id"])


def linked(pairs: DataFrame, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """Those of pairs(u, v) whose sets have 100 * intersection >= percent * union; size: what the joins are
    sized by."""
    a = sets.select(F.col("set_id").alias("u"), F.col("n_shingles").alias("_n"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("set_id").alias("v"), F.col("n_shingles").alias("_m"), F.col("shingles").alias("_b"))
    both = sized(pairs.join(a.hint("merge"), "u"), size).join(b.hint("merge"), "v")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.where(100 * common >= percent * (F.col("_n") + F.col("_m") - common)).select("u", "v")


def _shared_sizes(sets: DataFrame) -> DataFrame:
    """(set_id, n, m): the size, and how many of the shingles another of the sets has as well."""
    each = sets.select("set_id", F.explode("shingles").alias("_s")).groupBy("_s").agg(F.count(F.lit(1)).alias("_n"), F.min("set_id").alias("set_id"))
    alone = each.where("_n = 1").groupBy("set_id").agg(F.count(F.lit(1)).alias("_alone"))
    sizes = sets.select("set_id", F.col("n_shingles").alias("n")).join(alone.hint("shuffle_hash"), "set_id", "left")
    return sizes.select("set_id", "n", (F.col("n") - F.coalesce("_alone", F.lit(0))).alias("m"))


def _open(rows: DataFrame, percent: int, size: int) -> tuple[DataFrame, int]:
    """The rows(signature, set_id, central, n, m, label) that may still be linked with one of another component, and
    their number; size: that of rows.

    Two sets have at most min(m, m') shingles in common, of which (100 + percent) * common >= percent * (n + n') must
    hold; so a set whose m is too small even for the smallest set of its signature is left out.
    """
    while True:
        of_one = rows.groupBy("signature").agg(F.min("label").alias("_a"), F.max("label").alias("_b"), F.min("n").alias("_least"), F.count(F.lit(1)).alias("_sets"))
        of_one = written(sized(of_one.where("_a <> _b").select("signature", "_least", "_sets"), size), "open")
        before = of_one.agg(F.sum("_sets")).first()[0] or 0
        if not before:
            return rows.limit(0), 0
        rows = rows.join(of_one.hint("merge"), "signature").where(f"{100 + percent} * m >= {percent} * (n + _least)").drop("_least", "_sets")
        rows = written(sized(rows, size), "open-rows")
        size = rows.count()
        # Another pass shuffles all rows, which only pays where many go.
        if size > 0.5 * before:
            return rows, size


def _labels(kept: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(set_id, label): the component of every set in kept(signature, set_id, central)."""
    size, n_sets, pivots = kept.count(), sets.count(), 1
    sizes = sized(_shared_sizes(sets), 10 * n_sets)
    rows = written(sized(kept.join(sizes.hint("shuffle_hash"), "set_id").withColumn("label", F.col("set_id")), size), "rows")
    labels = written(sets.select("set_id", F.col("set_id").alias("label")), "labels")
    while True:
        rows, size = _open(rows, percent, size)
        if not size:
            return labels
        if pivots > 1 and "bits" not in rows.columns:
            # What is left after the first round is compared by bits first.
            rows = written(sized(rows.join(sets.select("set_id", "bits").hint("shuffle_hash"), "set_id"), max(size, 2 * n_sets)), "rows")
        slot = F.pmod(F.hash("set_id"), F.lit(pivots))
        own = ["set_id", "label", "n", "m"] + ["bits"] * (pivots > 1)
        chosen = rows.groupBy("signature", slot.alias("_slot")).agg(F.max(F.struct("central", *own)).alias("p"))
        chosen = written(sized(chosen.select("signature", *[F.col(f"p.{c}").alias(f"p_{c}") for c in own]), size), "pivots")
        near = f"label <> p_label and {100 + percent} * least(m, p_m) >= {percent} * (n + p_n)"
        if pivots > 1:
            differ = " + ".join(f"bit_count(bits[{i}] ^ p_bits[{i}])" for i in range(BITS // 64))
            near += f" and {100 + percent} * ({differ}) <= {100 - percent} * (n + p_n)"
        pairs = rows.join(chosen.hint("merge"), "signature").where(near)
        pairs = written(sized(pairs.select(F.least("set_id", "p_set_id").alias("u"), F.greatest("set_id", "p_set_id").alias("v")).distinct(), size), "pairs")
        asked, n_pairs = sets, pairs.count()
        if 4 * n_pairs < n_sets and 2 * n_pairs <= FEW:
            # Sets are wide rows: only those of the pairs are shuffled, where that is less than all.
            ids = pairs.select(F.col("u").alias("set_id")).unionByName(pairs.select(F.col("v").alias("set_id"))).distinct()
            asked = sets.join(ids.hint("broadcast"), "set_id", "left_semi")
        # A joined table is sized by its larger side.
        wide = 10 * max(5 * n_pairs, n_sets if asked is sets else 2 * n_pairs)
        links = written(sized(linked(pairs, asked, percent, wide), wide), "links")
        done = chosen.select("signature", F.col("p_set_id").alias("set_id"))
        rows = sized(rows.join(done.hint("merge"), ["signature", "set_id"], "left_anti"), size)
        if n_links := links.count():
            # The links among components, and the components' own components.
            one, two = labels.select(F.col("set_id").alias("u"), F.col("label").alias("_u")), labels.select(F.col("set_id").alias("v"), F.col("label").alias("_v"))
            most = max(n_links, n_sets)
            across = sized(sized(links.join(one.hint("merge"), "u"), most).join(two.hint("merge"), "v"), most)
            found = components(across.select(F.col("_u").alias("u"), F.col("_v").alias("v")))
            found = written(sized(found, n_links), "found").select(F.col("node").alias("label"), F.col("component").alias("_to"))
            labels = sized(labels.join(found.hint("merge"), "label", "left"), most).select("set_id", F.coalesce("_to", "label").alias("label"))
            labels = written(labels, "labels")
            rows = sized(rows.drop("label").join(labels.hint("merge"), "set_id"), max(size, n_sets))
        rows = written(rows, "rows")
        pivots *= 32


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), set_id: a row for each of
    docs.

    Words are lower-cased in A-Z only. Texts with fewer words than a shingle are one shingle; null, empty and blank
    texts have none, are linked with nothing and have a null set_id. Copies are linked; repeated rows are copies.
    Rows without a doc_id are linked like others; a component of such rows alone has a null component_id. Very long
    texts are read whole. An empty table gives no rows; other columns are not read. percent may be 75 or more: the
    bands are laid out for that.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _linked_up(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", "set_id")


def _linked_up(docs: DataFrame, shingle: int = SHINGLE, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, set_id, component (one of the component's set_ids, null without shingles), component_id and
    the further columns of docs(doc_id, text, ..)."""
    if percent < 75:
        raise ValueError("the size bands hold for a similarity of 0.75 or more")
    own = written(shingle_sets(docs, shingle), "shingle-sets")
    docs = docs.select("doc_id", "text")
    classes = own.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least_id"), F.first("drop_0").alias("drop_0"), F.first("drop_1").alias("drop_1"))
    classes = written(classes, "classes")
    total = own.agg(F.sum("n_shingles")).first()[0] or 0
    shared = shared_signatures(docs, bucket_count(docs.sparkSession, 0.8 * total), shingle)
    drops = classes.select("set_id", "drop_0", "drop_1")
    flagged = shared.join(drops.hint("shuffle_hash"), "set_id").withColumn("_odd", F.expr("signature & 1"))
    of_set = Window.partitionBy("set_id", "_odd")
    flagged = flagged.withColumn("central", F.count(F.lit(1)).over(of_set) - F.expr("if(_odd = 0, drop_0, drop_1)"))
    flagged = flagged.where("central > 0").withColumn("_nth", F.row_number().over(of_set.orderBy("n", "signature")))
    kept = written(flagged.where("_nth <= central").select("signature", "set_id", "central"), "kept")
    wanted = written(classes.join(kept.select("set_id").distinct().hint("shuffle_hash"), "set_id", "left_semi").select(F.col("least_id").alias("doc_id"), "set_id"), "wanted")
    sets = written(representatives_shingles(docs, wanted, shingle), "sets")
    found = _labels(kept, sets, percent)
    roots = classes.select("set_id", "least_id").join(found.hint("shuffle_hash"), "set_id", "left")
    roots = written(roots.select("set_id", "least_id", F.coalesce("label", "set_id").alias("component")), "roots")
    least = roots.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = written(roots.join(written(least, "least").hint("merge"), "component").select("set_id", "component", "component_id"), "named")
    out = own.drop("drop_0", "drop_1").join(named.hint("merge"), "set_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group of docs: that with the smallest doc_id (one without only where no other has
    one), then the smallest digest. Rows without shingles all stay, but for repeated ones."""
    key = free_name(docs, "_key")
    docs = docs.withColumn(key, row_key(F.sha2(F.coalesce("text", F.lit("")), 256)))
    rows = _linked_up(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(key).alias("_key")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("row")
    kept = rows.groupBy("component", F.when(F.col("component").isNull(), F.col("_key")).alias("_alone")).agg(first).select("row._key")
    return one_of_each_key(docs, kept, key)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT *, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common >= 75 * (a.n + b.n - common)),
reached AS (SELECT doc_id, doc_id AS other FROM texts UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT t.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id FROM texts t JOIN reached r USING (doc_id) LEFT JOIN sizes s USING (doc_id) GROUP BY t.doc_id
"""
