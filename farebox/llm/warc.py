"""WARC archives as a PySpark Python data source.

Reading plans partitions from the committed files of a folder (whole files, by
size) and parses each record's headers first.  Predicates on header columns
are pushed down (with ``spark.sql.python.filterPushdown.enabled``): a record
that fails one is passed over without inflating or reading its payload, as is
every payload when the option ``payload`` is ``false``.  Each record is a gzip
member of its own, whose extra field holds the member's size, so passing over
it is a seek; members without that field, with one record or many, and plain
``.warc`` files work too.  No read goes beyond a record: a block of type
application/http without a blank line is payload as a whole, lines may end in
LF alone, and a record or gzip member that is cut short raises an error.

Writing goes through the data source's commit protocol: a task writes files
under names of its own, and only the files of successful tasks enter the
manifest that readers go by, so a retried or speculative task leaves no copy.
Files are read and written through Arrow's file systems, so a folder can be in
any shared store they know.

``write_pages`` writes one record per page.  Of the pages with equal payloads
of at least ``MIN_REVISIT_BYTES``, the one with the smallest id is a response,
the others are revisit records that refer to it.  Payloads are never shuffled:
pages equal to an earlier one are found by digest on narrow rows.

Defined results: a null html is an empty payload; a null url has no target
URI; a page with a null id is a response, as nothing could refer to it; rows
with equal ids and equal payloads are all responses or all revisits; control
characters in a url are percent-encoded; a payload of any length is written
and read whole; an empty table gives no records; other columns of the pages
play no part, whatever their names.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, materialise
from farebox.operators.joins import lookup_join

MIN_REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
GZIP_LEVEL = 3
BATCH_BYTES = 4 << 20
BATCH_RECORDS = 2000
HEADER_BYTES = 4096
HTTP_HEAD_BYTES = 1 << 20
MANIFEST = "_manifest.json"
ID_PREFIX = "urn:farebox:page:"

# Fixed values of the WARC and gzip formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_START = b"\x1f\x8b\x08"
GZIP_EXTRA = 4
SIZE_FIELD = b"fs"
LINE_END = re.compile(rb"\r?\n")
BLANK_LINE = re.compile(rb"\r?\n\r?\n")

SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("warc_date", T.StringType()),
    T.StructField("content_type", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("http_length", T.LongType()),
    T.StructField("payload", T.BinaryType())])
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
             "warc_date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest",
             "refers_to": "warc-refers-to"}
INPUT_SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload binary, payload_bytes long"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a path or URI, and the path in it; Spark's
    names of the S3 scheme are Arrow's ``s3``."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


# ---------------------------------------------------------------- records
def record_bytes(row: dict, date: str) -> bytes:
    """A WARC record: headers, HTTP headers and, for a response, the payload."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"] or b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
               ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}")]
    if row["target_uri"] is not None:
        safe = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["target_uri"])
        headers.append(("WARC-Target-URI", safe))
    if revisit:
        headers += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose extra field holds the member's size."""
    deflate = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    head = GZIP_START + bytes([GZIP_EXTRA]) + b"\x00\x00\x00\x00\x00\xff" + struct.pack("<H", 12)
    size = len(head) + 12 + len(body) + 8
    extra = SIZE_FIELD + struct.pack("<HQ", 8, size)
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(text: bytes) -> dict[str, str]:
    """Header lines by lower-case name, continuation lines joined."""
    out: dict[str, str] = {}
    name = None
    for line in LINE_END.split(text)[1:]:
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            key, _, value = line.partition(b":")
            name = key.strip().lower().decode("utf-8", "replace")
            out[name] = value.strip().decode("utf-8", "replace")
    return out


class _Source:
    """The bytes of one stream of records, a plain file or a gzip member, read as far as asked for."""

    def __init__(self) -> None:
        self.held = b""

    def more(self, n: int) -> bytes:
        raise NotImplementedError

    def fill(self) -> bool:
        """Hold some bytes more; False at the end."""
        got = self.more(HEADER_BYTES)
        self.held += got
        return bool(got)

    def next_record(self) -> bool:
        """Go to the next record, over the blank lines between records; False if there is none."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            if self.held:
                return True
            if not self.fill():
                return False

    def head(self) -> bytes:
        """A record's headers up to and with the blank line."""
        while (end := BLANK_LINE.search(self.held)) is None:
            if not self.fill():
                raise ValueError("a WARC record ends inside its headers")
        out, self.held = self.held[: end.end()], self.held[end.end():]
        return out

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes of the block."""
        parts, have = [self.held[:n]], min(n, len(self.held))
        self.held = self.held[have:]
        while have < n:
            got = self.more(n - have)
            if not got:
                raise ValueError("a WARC record ends before its Content-Length")
            parts.append(got)
            have += len(got)
        return b"".join(parts)

    def http_head(self, length: int) -> tuple[bytes | None, bytes]:
        """(HTTP headers, bytes read behind them) of a block of ``length``
        bytes; no headers if no blank line ends them in the block, or in its
        first ``HTTP_HEAD_BYTES``.  Never reads beyond the block."""
        read = b""
        while True:
            if (end := BLANK_LINE.search(read)) is not None:
                return read[: end.end()], read[end.end():]
            if len(read) >= min(length, HTTP_HEAD_BYTES):
                return None, read
            read += self.take(min(HEADER_BYTES, length - len(read)))

    def pass_over(self, n: int) -> None:
        while n:
            n -= len(self.take(min(n, 1 << 20)))

    def finish(self) -> None:
        """Leave the file at the end of this stream."""


class _Plain(_Source):
    def __init__(self, file) -> None:
        super().__init__()
        self.file = file

    def more(self, n: int) -> bytes:
        return self.file.read(n)

    def pass_over(self, n: int) -> None:
        beyond = n - len(self.held)
        if beyond > 0:
            self.file.seek(beyond - 1, io.SEEK_CUR)
            if not self.file.read(1):
                raise ValueError("a WARC record ends before its Content-Length")
        self.held = self.held[n:]


class _Member(_Source):
    """A gzip member; inflates only what is asked for."""

    def __init__(self, file, begin: int, size: int | None) -> None:
        super().__init__()
        self.file, self.begin, self.size = file, begin, size
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        self.passed = False

    def more(self, n: int) -> bytes:
        out = b""
        while not out and not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.file.read(16384)
            if not data:
                raise ValueError("a gzip member is cut short")
            out = self.inflate.decompress(data, n)
        return out

    def pass_over(self, n: int) -> None:
        if self.size is None:  # else a member of our own, which holds one record
            super().pass_over(n)
        else:
            self.passed = n > 0

    def next_record(self) -> bool:
        return not self.passed and super().next_record()

    def finish(self) -> None:
        if self.passed:
            self.file.seek(self.begin + self.size)
        else:  # all is inflated; after the deflate data come the checksum and the length
            self.file.seek(8 - len(self.inflate.unused_data), io.SEEK_CUR)


def _open_source(file) -> _Source | None:
    """The records at the file's place: a gzip member, or the rest of a plain file; None at its end."""
    begin = file.tell()
    start = file.read(10)
    if not start:
        return None
    if not start.startswith(GZIP_START):
        file.seek(begin)
        return _Plain(file)
    flags, size = start[3], None
    if flags & GZIP_EXTRA:
        extra = file.read(struct.unpack("<H", file.read(2))[0])
        while len(extra) >= 4:
            n = struct.unpack("<H", extra[2:4])[0]
            if extra[:2] == SIZE_FIELD and n == 8:
                size = struct.unpack("<Q", extra[4:12])[0]
            extra = extra[4 + n:]
    for flag in (8, 16):  # file name, comment
        if flags & flag:
            while file.read(1) not in (b"\x00", b""):
                pass
    if flags & 2:
        file.read(2)
    return _Member(file, begin, size)


def read_records(file, wanted, with_payload: bool) -> Iterator[tuple]:
    """``SCHEMA`` rows of the records of an open file that ``wanted`` (a
    function of the header columns) lets through."""
    while (source := _open_source(file)) is not None:
        while source.next_record():
            headers = parse_headers(source.head())
            size = headers.get("content-length", "")
            if not size.isdigit():
                raise ValueError(f"a WARC record has no Content-Length but {size!r}")
            left = int(size)
            columns = {c: headers.get(h) for c, h in HEADER_OF.items()}
            for c in ("record_id", "refers_to", "target_uri"):
                if columns[c] and columns[c].startswith("<"):
                    columns[c] = columns[c][1:-1]
            if columns["payload_digest"]:
                columns["payload_digest"] = columns["payload_digest"].rpartition(":")[2]
            if not wanted(columns):
                source.pass_over(left)
                continue
            http_length = payload = None
            read = b""
            if (columns["content_type"] or "").startswith("application/http"):
                http, read = source.http_head(left)
                left -= len(http or b"") + len(read)
                value = parse_headers(http or b"").get("content-length", "")
                http_length = int(value) if value.isdigit() else None
            if with_payload and columns["record_type"] != "revisit":
                payload = read + source.take(left)
            else:
                source.pass_over(left)
            yield (*columns.values(), http_length, payload)
        source.finish()


# ---------------------------------------------------------------- data source
def _test(f: ds.Filter):
    """A pushed predicate as a function of a column value, or None."""
    value = getattr(f, "value", None)
    kinds = {
        ds.EqualTo: lambda x: x == value, ds.GreaterThan: lambda x: x > value, ds.LessThan: lambda x: x < value,
        ds.GreaterThanOrEqual: lambda x: x >= value, ds.LessThanOrEqual: lambda x: x <= value,
        ds.In: lambda x: x in value, ds.StringStartsWith: lambda x: x.startswith(value),
        ds.StringEndsWith: lambda x: x.endswith(value), ds.StringContains: lambda x: value in x,
        ds.IsNotNull: lambda x: True,
    }
    return kinds.get(type(f))


@dataclass
class WarcFiles(ds.InputPartition):
    paths: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else None
            if name in HEADER_OF and _test(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[WarcFiles]:
        files, root = file_system(self.path)
        info = files.get_file_info(root)
        if info.type == fs.FileType.File:
            found = [(info.path, info.size)]
        elif info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        else:
            there = files.get_file_info(fs.FileSelector(root, recursive=True))
            sizes = {i.path: i.size for i in there if i.type == fs.FileType.File}
            if f"{root}/{MANIFEST}" in sizes:
                with files.open_input_stream(f"{root}/{MANIFEST}") as f:
                    found = [(f"{root}/{n}", sizes[f"{root}/{n}"]) for n in json.loads(f.read())]
            else:
                found = [(p, n) for p, n in sizes.items() if p.endswith((".warc", ".warc.gz"))]
        parts, held = [], self.partition_bytes
        for path, size in sorted(found, key=lambda x: (-x[1], x[0])):
            if held + size > self.partition_bytes:
                parts.append(WarcFiles([]))
                held = 0
            parts[-1].paths.append(path)
            held += size
        return parts or [WarcFiles([])]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(self.path)
        tests = [(f.attribute[0], _test(f)) for f in self.filters]

        def wanted(columns: dict) -> bool:
            return all(columns[c] is not None and test(columns[c]) for c, test in tests)

        kinds = [pa.string()] * 7 + [pa.int64(), pa.binary()]
        rows, held = [], 0
        for path in partition.paths:
            with files.open_input_file(path) as raw:
                for row in read_records(io.BufferedReader(raw, 1 << 20), wanted, self.with_payload):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=SCHEMA.names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=SCHEMA.names)


@dataclass
class WarcWritten(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WarcWritten:
        files, root = file_system(self.path)
        files.create_dir(root, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = files.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    member = gzip_member(record_bytes(row, self.date))
                    out.write(member)
                    size += len(member)
                    if size >= self.file_bytes:
                        out.close()
                        out = None
        if out is not None:
            out.close()
        return WarcWritten(names)

    def commit(self, messages: list[WarcWritten | None]) -> None:
        """The manifest names the files of the tasks that succeeded."""
        files, root = file_system(self.path)
        files.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m for n in m.names)
        if not self.overwrite and files.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with files.open_input_stream(f"{root}/{MANIFEST}") as f:
                names += json.loads(f.read())
        with files.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list[WarcWritten | None]) -> None:
        files, root = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            files.delete_file(f"{root}/{name}")


class WarcDataSource(ds.DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with its filter push-down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


# ---------------------------------------------------------------- pages
def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows for the writer: a response or a revisit per page."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = bounded(pages).select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("target_uri"),
                        payload.alias("payload"))
    base = base.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": F.sha2(F.col("payload"), 256)})
    # Equal payloads, found without moving a payload: digests and ids only.
    narrow = base.where((F.col("payload_bytes") >= min_bytes) & F.col("_id").isNotNull()).select("payload_digest", "_id")
    first = narrow.groupBy("payload_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where(
        "_first != _last").select("payload_digest", "_first")
    repeats = narrow.join(first.hint("merge"), "payload_digest").where("_id != _first").select(
        F.col("_id").alias("_repeat"), F.col("payload_digest").alias("_digest"), "_first").distinct()
    repeats = materialise(repeats, "warc-repeats")
    marked = lookup_join(base, repeats, (F.col("_id") == F.col("_repeat")) & (F.col("payload_digest") == F.col("_digest")),
                         "left")
    name = lambda c: F.concat(F.lit(ID_PREFIX), F.col(c).cast("string"))
    return marked.select(
        F.when(F.col("_first").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.coalesce(name("_id"), F.lit(ID_PREFIX)).alias("record_id"), "target_uri", "payload_digest",
        name("_first").alias("refers_to"),
        F.when(F.col("_first").isNull(), F.col("payload")).alias("payload"), "payload_bytes")


def write_pages(pages: DataFrame, path: str, **columns: str) -> str:
    """One WARC record per page below ``path``."""
    register(pages.sparkSession)
    page_records(pages, **columns).write.format("warc").mode("overwrite").save(path)
    return path


def page_digests(records: DataFrame, id_col: str = "page_id", id_type: str = "long") -> DataFrame:
    """One row per record: id, size and SHA-256 of the full payload, type,
    refers_to.  A response's come from the payload that was read, a revisit's
    from its headers."""
    number = lambda c: F.nullif(F.substring(F.col(c), len(ID_PREFIX) + 1, 1 << 30), F.lit("")).cast(id_type)
    whole = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias(id_col),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
