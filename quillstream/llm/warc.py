"""WARC archives of pages: writing, normalising whole-file gzip streams, and reading back by offset.

Every task streams its pages into archives of about ARCHIVE_BYTES, each a single gzip member under the shared folder. The normaliser inflates such a stream once, in chunks, rewrites every record as its own member, and writes a
sidecar index of offsets; readers then inflate single records. Every attempt of a task writes files of its own name, and
only those that the stored manifest lists count, so a task may run again at any time and nothing is ever moved or
overwritten (what a lost attempt has written is left over). Records with equal payloads of at least REVISIT_BYTES point to the one with the smallest page_id; groups are found by the tree of `tree_merge`.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm.exact_dedup import FAN, tree_merge
from quillstream.llm.stage import partitions, shared_folder, written

ARCHIVE_BYTES = 64 << 20
REVISIT_BYTES = 100
PARTS = 3  # groups of archives that are normalised one after the other
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
MANIFEST = "archive long, path string, records long"


def records_of(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes and, for revisits, refers_to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", F.sha2(payload, 256).alias("payload_digest"), F.length(payload).cast("long").alias("payload_bytes"))
    keys = written(rows.where(F.col("payload_bytes") >= REVISIT_BYTES).select("page_id", "payload_digest"), "payload-digests")
    runs = FAN ** max(1, len(f"{partitions(pages.sparkSession) - 1:o}"))
    least = tree_merge(keys, ["payload_digest"], "page_id", runs).where("page_id <> smallest_id")
    least = least.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("smallest_id").alias("refers_to")).distinct()
    same = (F.col("page_id") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    return rows.join(least.hint("merge"), same, "left").drop("_id", "_digest")


def _record_id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _File:
    """A file in the shared folder with a name of its own; `end` follows it."""

    def __init__(self, folder: str, name: str, end: str = ".warc.gz"):
        self.fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self._open(f"{root}/{name}-{uuid.uuid4().hex}{end}")

    def _open(self, path: str) -> None:
        self.path, self.at = path, 0
        self.out = self.fs.open_output_stream(path, compression=None)

    def beside(self, end: str) -> _File:
        """A file whose name is this one's and `end`."""
        other = object.__new__(_File)
        other.fs = self.fs
        other._open(self.path + end)
        return other

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def done(self) -> str:
        self.out.close()
        return self.path


def write_archives(records: DataFrame, folder: str, archive_bytes: int) -> DataFrame:
    """Writes records (as from records_of) to archives in the folder, each one gzip member of about archive_bytes before
    packing; returns the manifest: archive, path, records. A partition's rows go in a fixed order, and are not dealt
    anew: the join with the groups has left them spread by page."""
    columns = ["page_id", "url", F.col("html").cast("string").alias("html"), "payload_digest", "payload_bytes", "refers_to"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, file, packer, n, size = TaskContext.get().partitionId(), 0, None, None, 0, 0

        def finish() -> pa.RecordBatch:
            file.write(packer.flush())
            return pa.RecordBatch.from_arrays([pa.array([part * 100_000 + number], pa.int64()), pa.array([file.done()]), pa.array([n], pa.int64())], names=["archive", "path", "records"])

        for batch in batches:
            for start in range(0, len(batch), 200):
                for r in batch[start : start + 200].to_pylist():
                    if file and size >= archive_bytes:
                        yield finish()
                        file, number = None, number + 1
                    if not file:
                        file, packer, n, size = _File(folder, f"archive-{part:06d}-{number:05d}"), zlib.compressobj(6, wbits=31), 0, 0
                    raw = record(r["page_id"], r["url"], (r["html"] or "").encode(), r["payload_digest"], r["payload_bytes"], r["refers_to"])
                    file.write(packer.compress(raw))
                    n, size = n + 1, size + len(raw)
        if file:
            yield finish()

    return written(records.sortWithinPartitions("page_id", "url").select(*columns).mapInArrow(write, MANIFEST), "archives")


def inflated(stream) -> Iterator[bytes]:
    """Chunks of all members of a gzip file."""
    unpack = zlib.decompressobj(wbits=31)
    while data := stream.read(CHUNK):
        while data:
            if unpack.eof:
                unpack = zlib.decompressobj(wbits=31)
            out = unpack.decompress(data, CHUNK)
            if out:
                yield out
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
    if out := unpack.flush():
        yield out


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, whole record) of every record of a stream; a cut off last record is an error."""
    held = bytearray()

    def need(test) -> bool:
        while not test():
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        if not need(lambda: b"\r\n\r\n" in held):
            if bytes(held).strip():
                raise ValueError("the stream ends inside a record's header")
            return
        end = held.index(b"\r\n\r\n") + 4
        head = parse_head(bytes(held[:end]))
        whole = end + int(head["content-length"]) + 4
        if not need(lambda whole=whole: len(held) >= whole):
            raise ValueError("the stream ends inside a record")
        yield head, bytes(held[:whole])
        del held[:whole]


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}


def normalise(manifest: DataFrame, folder: str, parts: int = 1) -> DataFrame:
    """Rewrites each archive of a manifest with a gzip member for each record, next to an index (a JSON line of record
    id, type, offset and length for each); returns the manifest of the new files. The sources stay until that manifest
    is written, so that a task can run again; then they are deleted, in a job of their own. With several parts the
    archives are worked off in so many groups, each deleted before the next, so that only one group is there twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
                file, n = _File(folder, f"members-{r['archive']:011d}"), 0
                index = file.beside(".index")
                with fs.open_input_stream(r["path"], compression=None) as stream:
                    for head, raw in split_records(inflated(stream)):
                        packer = zlib.compressobj(6, wbits=31)
                        member = packer.compress(raw) + packer.flush()
                        index.write((json.dumps([head["warc-record-id"], head["warc-type"], file.at, len(member)]) + "\n").encode())
                        file.write(member)
                        n += 1
                path = file.done()
                index.done()
                yield pa.RecordBatch.from_arrays([pa.array([r["archive"]], pa.int64()), pa.array([path]), pa.array([n], pa.int64())], names=["archive", "path", "records"])

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
                if fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound:  # an attempt before may have deleted it
                    fs.delete_file(path)
            yield batch

    members = []
    for part in range(parts):
        own = manifest.where(F.pmod(F.xxhash64("archive"), F.lit(parts)) == part)
        files = own.repartition(max(1, partitions(manifest.sparkSession)), "archive")
        members.append(written(files.mapInArrow(run, MANIFEST), "members"))
        own.select("path").mapInArrow(delete, "path string").count()
    return functools.reduce(DataFrame.unionByName, members)


READ = "archive long, position long, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, html string"


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of normalised archives, each inflated by its own offset; the payload's digest is checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
                rows: list[tuple] = []

                def out(rows=rows) -> pa.RecordBatch:
                    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                    found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows.clear()
                    return found

                with fs.open_input_stream(f"{r['path']}.index", compression=None) as lines:
                    entries = [json.loads(x) for x in lines.read().decode().splitlines()]
                with fs.open_input_file(r["path"]) as file:
                    for _, kind, at, size in entries:
                        file.seek(at)
                        raw = zlib.decompress(file.read(size), wbits=31)
                        end = raw.index(b"\r\n\r\n") + 4
                        head = parse_head(raw[:end])
                        block = raw[end : end + int(head["content-length"])]
                        http, payload = block.split(b"\r\n\r\n", 1)
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest differs in {r['path']} at {at}")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        number = [re.search(r"<urn:page:(-?\d+)>", head.get(k, "")) for k in ("warc-record-id", "warc-refers-to")]
                        ids = [int(m[1]) if m else None for m in number]
                        rows.append((r["archive"], at, ids[0], head["warc-target-uri"], kind, digest, length, ids[1], payload.decode() if with_payload and kind == "response" else None))
                        if len(rows) >= 500:
                            yield out()
                if rows:
                    yield out()

    return manifest.repartition(max(1, partitions(manifest.sparkSession)), "archive").mapInArrow(run, READ)


def archived(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES, with_payload: bool = True) -> DataFrame:
    """Writes pages to archives, normalises them and reads them back.

    Null html is an empty payload; payloads under REVISIT_BYTES are always responses; very long pages are kept whole;
    rows that repeat page_id and html are all written, alike; a null page_id reads back as null. An empty table gives
    no archives and no rows; columns other than page_id, url and html are not read.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if re.match(r"[a-z0-9]+:/", folder) else f"file://{folder}"
    return read_archives(normalise(write_archives(records_of(pages), folder, archive_bytes), folder, PARTS), folder, with_payload)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return archived(pages, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, payload_bytes >= 100 AND page_id <> min(page_id) OVER w AS again, min(page_id) OVER w AS least
  FROM p WINDOW w AS (PARTITION BY payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN least END AS refers_to FROM m
"""
