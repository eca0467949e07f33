"""Stored tables in buckets of their key, with versions that are committed by a manifest.

    root/data/write=<id>/bucket=<b>/part-..     data files, never changed once written
    root/manifest/<version>.json                which writes make up each bucket in that version

A writer reads a version, writes files of the buckets it touches, and publishes the next manifest, which only one of the
writers that want this version can do. The others look at what was committed meanwhile: if it touched none of their
buckets, their files stand and only the manifest is made anew, else they do their work again on the new version. Readers
hold the file list of one version, so that no write changes what they read; a writer that fails before it commits leaves
files that no manifest names, and `vacuum` deletes them.

A key's bucket is the low bits of its hash. Buckets double as the table grows, so that one of them, which is the most
that is read or rewritten for a key, stays of one size. With sketches, a Bloom filter of its keys lies beside each write's
part of a bucket, under the same name, and tells which parts may hold a key without reading them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillstream.operators import ingest
from quillstream.sources import shared


class Conflict(Exception):
    """Another writer has committed the version that this one wanted."""


@dataclass(frozen=True)
class Manifest:
    """A version: for every bucket, the writes that hold its rows. commits: what streams have committed, by name."""

    version: int = 0
    buckets: int = 1
    writes: dict[int, list[str]] = field(default_factory=dict)
    rows: int = 0
    commits: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "writes": self.writes, "rows": self.rows, "commits": self.commits})

    @staticmethod
    def of(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["version"], raw["buckets"], {int(b): w for b, w in raw["writes"].items()}, raw["rows"], raw["commits"])

    def touched_since(self, old: Manifest) -> set[int]:
        """Buckets whose writes differ; all of them where their number does."""
        if self.buckets != old.buckets:
            return set(range(max(self.buckets, old.buckets)))
        return {b for b in self.writes.keys() | old.writes.keys() if self.writes.get(b) != old.writes.get(b)}


SKETCH = "bucket int, write string, bits binary"
BITS, PROBES = 16, 6  # for each key, at least: one key in two thousand is a false hit


def _positions(hashes: np.ndarray, size: int) -> Iterable[np.ndarray]:
    """Bits of each hash in a filter of `size` bits, a power of two, by double hashing of a remixed hash: the low bits
    have already been used to choose the bucket."""
    h = hashes.view(np.uint64)
    first = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    second = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    for k in range(PROBES):
        yield (((first + np.uint64(k) * second) >> np.uint64(20)) & np.uint64(size - 1)).astype(np.int64)


def bloom_filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(1 << max(6, (len(hashes) * BITS - 1).bit_length()), bool)
    for at in _positions(hashes, len(bits)):
        bits[at] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_bits: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(filter_bits, np.uint8)
    found = np.ones(len(hashes), bool)
    for at in _positions(hashes, 8 * len(bits)):
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return found


class KeyedTable:
    """A stored table of one row (or, by append, several) for each key. bucket_rows: mean rows of a bucket at which the
    number of buckets doubles; sketches: keep Bloom filters; parts: writes that a bucket may have before a further append
    merges them into one."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, key: str = "id", bucket_rows: int = 1_000_000, sketches: bool = False, parts: int = 8):
        self.spark, self.root, self.key, self.bucket_rows, self.sketches, self.parts = spark, root.rstrip("/"), key, bucket_rows, sketches, parts
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    # --- files -----------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        path, files = self._path("manifest")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The named or the newest version; an empty table before the first."""
        known = self.versions()
        version = known[-1] if version is None and known else version
        if not version:
            return Manifest()
        path, files = self._path(f"manifest/{version:012d}.json")
        source = files.open(path)
        try:
            return Manifest.of(self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def commit(self, manifest: Manifest) -> None:
        """Publishes a version, whole, or raises Conflict where that version is there already."""
        draft, files = self._path(f"manifest/.draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(manifest.text().encode()))
        out.close()
        target, _ = self._path(f"manifest/{manifest.version:012d}.json")
        try:
            if files.getScheme() == "file":
                # A local rename replaces its target; a link to what is there already fails.
                os.link(*(urlparse(p.toUri().toString()).path for p in (draft, target)))
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = none
                context.rename(draft, target, options)
        except FileExistsError:
            raise Conflict(manifest.version) from None
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                raise Conflict(manifest.version) from None
            raise
        finally:
            files.delete(draft, False)

    # --- reading ---------------------------------------------------------------------------------------------------

    def bucket_of(self, buckets: int, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(buckets)).cast("int")

    def files_of(self, manifest: Manifest, buckets: Iterable[int], folder: str = "data") -> list[str]:
        return [f"{self.root}/{folder}/write={w}/bucket={b}" for b in sorted(buckets) for w in manifest.writes.get(b, [])]

    def read(self, buckets: set[int] | None = None, version: int | None = None, manifest: Manifest | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets: the files of others are not listed."""
        held = manifest or self.manifest(version)
        return self._rows(self.files_of(held, held.writes if buckets is None else buckets))

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def may_hold(self, keys: DataFrame, manifest: Manifest) -> DataFrame:
        """(key, bucket, write): the parts of buckets whose filters do not rule a key out. Reads the filters of the keys'
        buckets alone."""
        own = keys.select(self.key).withColumn("_h", F.xxhash64(self.key)).withColumn("bucket", self.bucket_of(manifest.buckets))
        kind = self.schema[self.key].dataType.simpleString()
        buckets = {r[0] for r in own.select("bucket").distinct().collect()}  # at most one for each bucket
        paths = self.files_of(manifest, buckets, "sketch")
        if not paths:
            return self.spark.createDataFrame([], f"`{self.key}` {kind}, bucket int, write string")
        filters = self.spark.read.schema(SKETCH).parquet(*paths)
        name = self.key

        def probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
            hashes = keys.column("_h").to_numpy().astype(np.int64)
            hits = [np.flatnonzero(may_hold(bits, hashes)) for bits in filters.column("bits").to_pylist()]
            at = pa.array(np.concatenate([*hits, np.zeros(0, np.int64)]))
            writes = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
            return pa.table({name: keys.column(name).take(at), "bucket": keys.column("bucket").take(at), "write": filters.column("write").take(pa.array(writes, pa.int64()))})

        return own.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, f"`{name}` {kind}, bucket int, write string")

    def stored_keys(self, keys: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        """Those of the distinct keys (a stored table) that the version holds: exact, from the parts that may hold any."""
        held = manifest or self.manifest()
        maybe = shared.stored(self.may_hold(keys, held), "maybe")
        parts = [tuple(r) for r in maybe.select("bucket", "write").distinct().collect()]  # at most `parts` for each bucket
        rows = self._rows([f"{self.root}/data/write={w}/bucket={b}" for b, w in sorted(parts)])
        return maybe.select(self.key).distinct().join(rows.select(self.key).hint("merge"), self.key, "left_semi")

    # --- writing ---------------------------------------------------------------------------------------------------

    def write(self, rows: DataFrame, buckets: int) -> tuple[str, dict[int, int]]:
        """Data files of rows, dealt by bucket; their write and the rows of each bucket. Nobody reads them yet."""
        name = uuid.uuid4().hex
        target = f"{self.root}/data/write={name}"
        dealt = rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket_of(buckets))
        # A bucket with a hot key is written by several tasks, small buckets by one.
        dealt.hint("rebalance", "bucket").write.partitionBy("bucket").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
        path, files = self._path(f"data/write={name}")
        if not files.exists(path) or not any(s.getPath().getName().startswith("bucket=") for s in files.listStatus(path)):
            return name, {}
        key = f"`{self.key}` {self.schema[self.key].dataType.simpleString()}"
        made = self.spark.read.schema(f"bucket int, {key}").option("basePath", target).parquet(target)
        if self.sketches:

            def sketch(table: pa.Table) -> pa.Table:
                bits = bloom_filter(table.column("_h").to_numpy().astype(np.int64))
                return pa.table({"bucket": table.column("bucket")[:1], "write": [name], "bits": pa.array([bits], pa.binary())})

            filters = made.select("bucket", F.xxhash64(self.key).alias("_h")).distinct().groupBy("bucket").applyInArrow(sketch, SKETCH)
            # The bucket is in the files and in the names of their folders.
            filters.withColumn("_b", F.col("bucket")).write.partitionBy("_b").parquet(f"{self.root}/sketch/.write={name}")
            source, files = self._path(f"sketch/.write={name}")
            for own in files.listStatus(source):
                if (b := own.getPath().getName()).startswith("_b="):
                    files.mkdirs(self._path(f"sketch/write={name}")[0])
                    files.rename(own.getPath(), self._path(f"sketch/write={name}/bucket={b[3:]}")[0])
            files.delete(source, True)
        return name, {r["bucket"]: r["count"] for r in made.groupBy("bucket").count().collect()}  # at most a row a bucket

    def change(self, touched: Callable[[int], set[int]], merge: Callable[[DataFrame], DataFrame], attempts: int = 10) -> Manifest:
        """Rewrites the buckets that touched(number of buckets) names to merge(their rows), and commits.

        An attempt that finds another version committed keeps its files if that touched other buckets alone."""
        seen = None
        for _ in range(attempts):
            now = self.manifest()
            if seen is None or seen.buckets != base.buckets or now.touched_since(seen) & own:  # noqa: F821
                seen = base = now
                own = touched(base.buckets)
                old = self.read(own, manifest=base)
                n_old = old.count() if self.files_of(base, own) else 0
                name, counts = self.write(merge(old), base.buckets)
            writes = {b: w for b, w in now.writes.items() if b not in own} | {b: [name] for b in counts if b in own}
            following = Manifest(now.version + 1, now.buckets, writes, now.rows + sum(counts.values()) - n_old, now.commits)
            try:
                self.commit(following)
            except Conflict:
                continue
            return following if following.rows <= following.buckets * self.bucket_rows else self.grow()
        raise Conflict(f"{attempts} attempts on {self.root}")

    def append(self, make: Callable[[Manifest], DataFrame], commit: tuple[str, int] | None = None, attempts: int = 10) -> Manifest:
        """Adds the rows make(version) to their buckets as further parts; of what is stored, only buckets with many parts
        are rewritten.

        commit: (stream, batch), kept in the manifest: a batch that is there already, or an earlier one, is not added
        again. What make gives may depend on the version, so that an attempt is made anew after a conflict."""
        with shared.scratch_scope(self.spark):
            return self._append(make, commit, attempts)

    def _append(self, make: Callable[[Manifest], DataFrame], commit: tuple[str, int] | None, attempts: int) -> Manifest:
        for _ in range(attempts):
            now = self.manifest()
            if commit and now.commits.get(commit[0], -1) >= commit[1]:
                return now
            rows = shared.stored(make(now), "appended")
            more = rows.count()
            if now.version and now.rows + more > now.buckets * self.bucket_rows:
                now = self.grow(more)
                rows = shared.stored(make(now), "appended")
            buckets = now.buckets if now.version else self._buckets(more)
            full = {b for b in self.touched_by(rows)(buckets) if len(now.writes.get(b, ())) >= self.parts}
            name, counts = self.write(rows.unionByName(self.read(full, manifest=now)) if full else rows, buckets)
            writes = {b: list(w) for b, w in now.writes.items() if b not in full}
            for b in counts:
                writes.setdefault(b, []).append(name)
            commits = now.commits | ({commit[0]: commit[1]} if commit else {})
            following = Manifest(now.version + 1, buckets, writes, now.rows + more, commits)
            try:
                self.commit(following)
                return following
            except Conflict:
                continue
        raise Conflict(f"{attempts} attempts on {self.root}")

    def _buckets(self, rows: int, least: int = 1) -> int:
        while rows > least * self.bucket_rows:
            least *= 2
        return least

    def grow(self, more: int = 0, attempts: int = 10) -> Manifest:
        """Deals the table over more buckets, enough for `more` rows: a rewrite of it all for each time it has doubled."""
        for _ in range(attempts):
            now = self.manifest()
            buckets = self._buckets(now.rows + more, now.buckets)
            if buckets == now.buckets:
                return now
            name, counts = self.write(self.read(manifest=now), buckets)
            following = Manifest(now.version + 1, buckets, {b: [name] for b in counts}, now.rows, now.commits)
            try:
                self.commit(following)
                return following
            except Conflict:
                continue
        raise Conflict(f"{attempts} attempts on {self.root}")

    def touched_by(self, keys: DataFrame) -> Callable[[int], set[int]]:
        """The buckets of some keys, whatever the number of buckets."""
        return lambda buckets: {r[0] for r in keys.select(self.bucket_of(buckets).alias("b")).distinct().collect()}

    def upsert(self, rows: DataFrame) -> Manifest:
        """Rows replace all stored ones of their keys. rows is read more than once: a table, or written before."""
        return self.change(self.touched_by(rows), lambda old: old.join(rows.select(self.key).distinct(), self.key, "left_anti").unionByName(rows.select(*self.schema.fieldNames())))

    def patch(self, changes: DataFrame) -> Manifest:
        """Non-null values of changes(key, some columns), one row a key, are set in stored rows; new keys are not added."""
        return self.change(self.touched_by(changes), lambda old: ingest.patch(old, changes, self.key))

    def remove(self, keys: DataFrame) -> Manifest:
        return self.change(self.touched_by(keys), lambda old: old.join(keys.select(self.key).distinct(), self.key, "left_anti"))

    def replace(self, rows: DataFrame, attempts: int = 10) -> Manifest:
        """The whole table anew, in as many buckets as it is worth: readers of the version before keep that."""
        n = rows.count()
        buckets = self._buckets(n)
        name, counts = self.write(rows, buckets)
        for _ in range(attempts):
            now = self.manifest()
            following = Manifest(now.version + 1, buckets, {b: [name] for b in counts}, sum(counts.values()), now.commits)
            try:
                self.commit(following)
                return following
            except Conflict:
                continue
        raise Conflict(f"{attempts} attempts on {self.root}")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes all but the last `keep` versions and the writes that none of these names; for times without writers."""
        versions = self.versions()
        held = {w for v in versions[-keep:] for names in self.manifest(v).writes.values() for w in names}
        for v in versions[:-keep]:
            path, files = self._path(f"manifest/{v:012d}.json")
            files.delete(path, False)
        gone = []
        for folder in ("data", "sketch"):
            path, files = self._path(folder)
            for status in files.listStatus(path) if files.exists(path) else []:
                name = status.getPath().getName().lstrip(".").removeprefix("write=")
                if name not in held:
                    files.delete(status.getPath(), True)
                    gone.append(name)
        return sorted(set(gone))
