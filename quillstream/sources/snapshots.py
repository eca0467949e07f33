"""Page snapshots: what was fetched of the web, as a Spark data source.

    write_pages(df, folder)                                 url, status, fetched_at, html
    read_pages(spark, folder, host=["a.example"])           and host, from the url

A task writes its pages as WARC response records, each a gzip member of its own, and beside the file an index of its
records (host, url, status, place), sorted as the file is. The commit adds a manifest that names the files of the job
with their first and last host; files that no manifest names, left by lost tasks, do not count. A reader leaves out files
whose hosts its filters rule out, looks those on host, url and status up in the index of the others, and reads from the
archive the records that are left alone. Files are read in parts of about PART_BYTES, each a task.

Filters are given to the reader by name and stand in the plan as pushed filters. Others are Spark's own work: a relation
of a Python source keeps the filters of one of its uses for all of them, so that one table filtered in two ways would
lose rows if the source took on whatever it is offered.

A fetch that failed has no status and no html; a status without html is a response without a body.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from quillstream.functions import urls

NAME = "page_snapshots"
SCHEMA = "url string, host string, status int, fetched_at timestamp, html string"
FILTERS = ("host", "url", "status")
PART_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
_INDEX = pa.schema([("host", pa.string()), ("url", pa.string()), ("status", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
_PAGES = pa.schema([("url", pa.string()), ("host", pa.string()), ("status", pa.int32()), ("fetched_at", pa.timestamp("us", "UTC")), ("html", pa.string())])


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if re.match(r"[a-z]\w+:", folder) else (pa.fs.LocalFileSystem(), folder)


def record(url: str, status: int | None, fetched_at: int | None, html: str | None) -> bytes:
    """One WARC record, as a gzip member. Times are microseconds, which a further header keeps whole."""
    body = b"" if html is None else html.encode()
    answer = b"" if status is None else f"HTTP/1.1 {status}\r\nContent-Type: text/html; charset=utf-8\r\n".encode() + (b"" if html is None else f"Content-Length: {len(body)}\r\n".encode()) + b"\r\n" + body
    head = ["WARC/1.0", f"WARC-Type: {'response' if status is not None else 'metadata'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Target-URI: " + json.dumps(url)[1:-1]]
    if fetched_at is not None:
        head += [f"WARC-Date: {(_EPOCH + datetime.timedelta(microseconds=fetched_at)).strftime('%Y-%m-%dT%H:%M:%SZ')}", f"Fetched-Micros: {fetched_at}"]
    head.append(f"Content-Length: {len(answer)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + answer + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> tuple[str, int | None, int | None, str | None]:
    """(url, status, fetched_at, html) of a record."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fetched = int(fields["Fetched-Micros"]) if "Fetched-Micros" in fields else None
    status = html = None
    if fields["WARC-Type"] == "response":
        answer, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
        lines = answer.decode().split("\r\n")
        status = int(lines[0].split(" ")[1])
        html = body.decode() if any(x.startswith("Content-Length:") for x in lines) else None
    return json.loads(f'"{fields["WARC-Target-URI"]}"'), status, fetched, html


@dataclass
class _Written(WriterCommitMessage):
    files: list[dict]


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        files, root = _open(self.folder)
        name, index, at = f"{self.job}-{uuid.uuid4().hex}", [], 0
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as out:
            for batch in iterator:
                fetched = batch.column("fetched_at").cast(pa.timestamp("us", "UTC")).cast(pa.int64())
                for url, host, status, when, html in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "status")), fetched.to_pylist(), batch.column("html").to_pylist(), strict=True):
                    member = record(url, status, when, html)
                    out.write(member)
                    index.append((host, url, status, at, len(member)))
                    at += len(member)
        if not index:
            files.delete_file(f"{root}/{name}.warc.gz")
            return _Written([])
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
        pq.write_table(table, files.open_output_stream(f"{root}/{name}.idx"), row_group_size=20_000)
        hosts = pc.min_max(table.column("host")).as_py()
        return _Written([{"name": name, "rows": len(table), "bytes": at, "first": hosts["min"], "last": hosts["max"]}])

    def commit(self, messages: list[_Written | None]) -> None:
        files, root = _open(self.folder)
        files.create_dir(root, recursive=True)
        before = [f.path for f in files.get_file_info(pa.fs.FileSelector(root)) if f.base_name.startswith("manifest-")] if self.overwrite else []
        draft = f"{root}/.{self.job}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        files.move(draft, f"{root}/manifest-{self.job}.json")
        for path in before:
            files.delete_file(path)

    def abort(self, messages: list[_Written | None]) -> None:
        """The files of the tasks that had ended; those of others no manifest names."""
        files, root = _open(self.folder)
        for m in messages:
            for f in m.files if m else []:
                for kind in ("warc.gz", "idx"):
                    files.delete_file(f"{root}/{f['name']}.{kind}")


@dataclass
class _Part(InputPartition):
    name: str
    first: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, folder: str, wanted: dict[str, set]):
        self.folder, self.wanted = folder, wanted

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) > 1 or values != self.wanted.get(f.attribute[0]):
                yield f

    def partitions(self) -> list[_Part]:
        files, root = _open(self.folder)
        parts = []
        for info in files.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)):
            if not info.base_name.startswith("manifest-"):
                continue
            with files.open_input_stream(info.path) as source:
                held = json.loads(source.read())
            for f in held:
                if "host" in self.wanted and not any(f["first"] is not None and f["first"] <= h <= f["last"] for h in self.wanted["host"] if h is not None):
                    continue
                n = -(-f["bytes"] // PART_BYTES)
                cuts = [f["rows"] * k // n for k in range(n + 1)]
                parts += [_Part(f["name"], a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        return parts or [_Part("", 0, 0)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.name:
            return
        files, root = _open(self.folder)
        index = pq.read_table(files.open_input_file(f"{root}/{part.name}.idx")).slice(part.first, part.end - part.first)
        for name, values in self.wanted.items():
            index = index.filter(pc.is_in(index.column(name), value_set=pa.array(sorted(v for v in values if v is not None), _INDEX.field(name).type)))
        rows: list[tuple] = []
        size = 0
        with files.open_input_file(f"{root}/{part.name}.warc.gz") as source:
            for host, at, length in zip(*(index.column(c).to_pylist() for c in ("host", "offset", "length")), strict=True):
                source.seek(at)
                url, status, fetched, html = parsed(source.read(length))
                rows.append((url, host, status, fetched, html))
                size += len(html or "")
                if size > BATCH_BYTES:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) if not pa.types.is_timestamp(t) else pa.array(c, pa.int64()).cast(t) for c, t in zip(zip(*rows, strict=True), _PAGES.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_PAGES)


class PageSnapshots(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], {n: set(json.loads(self.options[n])) for n in FILTERS if n in self.options})

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """page_snapshots as a format of the session, with filters pushed down to it."""
    spark.dataSource.register(PageSnapshots)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pages(pages: DataFrame, folder: str, mode: str = "append", files: int | None = None) -> None:
    """pages(url, status, fetched_at, html) as snapshots, ranged by host and url, so that a host is in few files."""
    register(pages.sparkSession)
    rows = pages.select("url", urls.host(F.col("url")).alias("host"), F.col("status").cast("int").alias("status"), F.col("fetched_at").cast("timestamp").alias("fetched_at"), "html")
    rows = rows.repartitionByRange(*([files] if files else []), "host", "url").sortWithinPartitions("host", "url")
    rows.write.format(NAME).mode(mode).save(folder)


def read_pages(spark: SparkSession, folder: str, **filters: list) -> DataFrame:
    """Snapshots of a folder; filters: values that host, url or status must be one of. Null is never one of them."""
    register(spark)
    source = spark.read.format(NAME)
    for name, values in filters.items():
        if name not in FILTERS:
            raise ValueError(f"{name} is none of {FILTERS}")
        source = source.option(name, json.dumps(sorted(values)))
    rows = source.load(folder)
    for name, values in filters.items():
        rows = rows.where(F.col(name).isin(*values) if values else F.lit(False))
    return rows
