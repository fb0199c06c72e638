"""WARC archives as a PySpark data source, and pages archived with revisit records for repeated payloads.

Reading. ``spark.read.format("warc")`` plans whole files: small ones are packed into partitions of about ``partition_bytes``.
The columns of the schema that is asked for, and the predicates that Spark pushes down, decide what is read of a
record: its WARC header block is parsed first, then, if a column needs it, the HTTP header block, and the predicates are tried.
The payload is decoded only if the record passes and the payload is asked for; else it is skipped. In
uncompressed files, and in compressed ones whose members tell their length (below), skipping is a seek.

Writing. ``df.write.format("warc")`` makes one or more files in each task, each with a warcinfo record in front; files are rolled at
``file_bytes``. With ``compression`` ``gzip`` every record is a gzip member of its own that carries its compressed and uncompressed
length in the extra field ``sl``. Tasks write under ``_temporary``; the commit moves the files of the attempts that
succeeded and drops the rest, so lost or repeated tasks leave nothing behind.

Archiving. ``archive`` writes one record per page. Of pages with equal payloads (SHA-256) of at least ``least`` bytes the one with the
smallest key is a response; the others are revisits, which hold its HTTP header, the digest and a reference but no payload.
Repeated payloads are found by an aggregate of digests; they are broadcast up to ``BROADCAST`` of them, else joined by a shuffle.

Defined cases: a null payload is empty; a null key counts as the largest, and is null again when read; rows that repeat the smallest
key of their payload are responses, all of them; a null url is left out, control characters in urls are percent-encoded; a payload may hold anything,
also the text of WARC records; an empty table makes files without records, an empty folder reads as no rows; other columns are not
read. A file that is cut off or no WARC file raises with its name and the place, and so does a payload that its digest does not fit.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from transferlens.llm.common import ship, staged
from transferlens.session import shared_folder

LEAST = 100
BROADCAST = 200_000
PARTITION_BYTES = 32 << 20
FILE_BYTES = 256 << 20
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000
CHUNK = 64 << 10
FIRST = 2 << 10
LIMIT = 1 << 20
PAGE = "urn:page:"

# Fixed values of the format.
VERSION = b"WARC/1.1"
HTTP = "application/http"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLANK = b"\r\n\r\n"

# What a record's own header block tells, what the HTTP header block adds, and the payload.
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("record_id", "record_type", "target_uri", "warc_date", "refers_to", "payload_digest", "content_type")]
    + [T.StructField("content_length", T.LongType()), T.StructField("http_status", T.IntegerType()), T.StructField("http_content_type", T.StringType()),
       T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()), T.StructField("file", T.StringType()),
       T.StructField("offset", T.LongType())])
NAMED = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date", "refers_to": "warc-refers-to",
         "payload_digest": "warc-payload-digest", "content_type": "content-type"}
IN_HTTP = {"http_status", "http_content_type", "payload_bytes"}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as every executor sees it, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def test_of(condition: Filter) -> tuple[str, Callable] | None:
    """The column of a pushed predicate and a test of its value; None for predicates that Spark keeps."""
    if isinstance(condition, Not):
        inner = test_of(condition.child)
        # NOT of an unknown stays unknown, so a null passes neither.
        return inner and not isinstance(condition.child, (IsNull, IsNotNull, EqualNullSafe)) and (inner[0], lambda v: v is not None and not inner[1](v)) or None
    if len(condition.attribute) != 1 or condition.attribute[0] == "payload":
        return None
    name, value = condition.attribute[0], getattr(condition, "value", None)
    tests = {
        EqualTo: lambda v: v is not None and v == value, EqualNullSafe: lambda v: v == value, In: lambda v: v is not None and v in value,
        IsNull: lambda v: v is None, IsNotNull: lambda v: v is not None,
        GreaterThan: lambda v: v is not None and v > value, GreaterThanOrEqual: lambda v: v is not None and v >= value,
        LessThan: lambda v: v is not None and v < value, LessThanOrEqual: lambda v: v is not None and v <= value,
        StringStartsWith: lambda v: v is not None and v.startswith(value), StringEndsWith: lambda v: v is not None and v.endswith(value),
        StringContains: lambda v: v is not None and value in v,
    }
    # An IN list that holds a null, and comparisons with null, are left to Spark.
    if type(condition) not in tests or (value is None and type(condition) not in (IsNull, IsNotNull, EqualNullSafe)):
        return None
    return None if isinstance(condition, In) and None in value else (name, tests[type(condition)])


class Plain:
    """The bytes of an uncompressed file, record after record."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.start, self.held = stream, size, 0, b""

    def next(self) -> bool:
        """Whether another record starts; blank lines before it are passed over."""
        while True:
            self.stream.seek(self.start)
            self.held = self.stream.read(FIRST)
            left = self.held.lstrip(b"\r\n")
            self.start += len(self.held) - len(left)
            if left or not self.held:
                self.held = left
                return bool(left)

    def upto(self, n: int) -> bytes:
        """The first ``n`` bytes from the start of the record, or what there is."""
        if len(self.held) < n:
            self.held += self.stream.read(n - len(self.held))
        return self.held[:n]

    def skip(self, n: int) -> None:
        if self.start + n > self.size:
            raise EOFError
        self.start, self.held = self.start + n, b""


class Members(Plain):
    """The same of a file of gzip members, which hold one record each if they tell their length, else one or more; only as much as is
    asked for is inflated."""

    def __init__(self, stream, size: int):
        super().__init__(stream, size)
        self.raw, self.length, self.member, self.inside = b"", None, None, False

    def _open(self) -> bool:
        self.stream.seek(self.start)
        self.raw = self.stream.read(FIRST)
        if not self.raw:
            return False
        if self.raw[:2] != b"\x1f\x8b":
            raise ValueError("no gzip member")
        self.length = member_length(self.raw)
        self.member, self.read = zlib.decompressobj(31), self.start + len(self.raw)
        return True

    def _more(self, most: int) -> bytes:
        """Up to ``most`` more inflated bytes; none at the end of the member."""
        while not self.member.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise EOFError
                self.read += len(self.raw)
            out = self.member.decompress(self.raw, most)
            self.raw = self.member.unconsumed_tail
            if out:
                return out
        return b""

    def next(self) -> bool:
        while self.inside or self._open():
            self.inside = True
            self.held = self.held.lstrip(b"\r\n")
            while not self.held and (more := self._more(FIRST)):
                self.held = more.lstrip(b"\r\n")
            if self.held:
                return True
            self._leave()
        return False

    def _leave(self) -> None:
        if self.length and not self.member.eof:
            self.start += self.length
        else:
            while self._more(CHUNK):
                pass
            self.start = self.read - len(self.member.unused_data)
        if self.start > self.size:
            raise EOFError
        self.held, self.inside = b"", False

    def upto(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and (more := self._more(n - have)):
            parts.append(more)
            have += len(more)
        self.held = b"".join(parts)
        return self.held[:n]

    def skip(self, n: int) -> None:
        if self.length:
            self._leave()
            return
        left, self.held = n - len(self.held), self.held[n:]
        while left > 0:
            more = self._more(min(left, CHUNK))
            if not more:
                raise EOFError
            left -= len(more)


def member_length(head: bytes) -> int | None:
    """The compressed length that a gzip member's extra field ``sl`` tells."""
    if len(head) < 12 or not head[3] & 4:
        return None
    extra = head[12 : 12 + int.from_bytes(head[10:12], "little")]
    while len(extra) >= 4:
        size = int.from_bytes(extra[2:4], "little")
        if extra[:2] == b"sl" and size == 8:
            return int.from_bytes(extra[4:8], "little") or None
        extra = extra[4 + size :]
    return None


def header(source: Plain, start: int = 0) -> tuple[bytes, int]:
    """The header block from ``start`` on and where it ends, after the blank line."""
    n = start + FIRST
    while True:
        block = source.upto(n)
        end = block.find(BLANK, start)
        if end >= 0:
            return block[start:end], end + len(BLANK)
        if len(block) < n:
            raise EOFError
        if n - start > LIMIT:
            raise ValueError(f"a header block of more than {LIMIT} bytes")
        n *= 2


def fields(block: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields of a header block, names in lower case; of a repeated field the first one counts."""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    found, name = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        found.setdefault(name, value.strip())
    return first, found


def http_part(source: Plain, at: int, length: int) -> tuple[dict, int]:
    """Columns from the HTTP header block of a record whose block starts at ``at``, and where its payload starts."""
    block, end = header(source, at)
    if end > at + length:
        raise ValueError("an HTTP header block that is longer than its record")
    first, found = fields(block)
    status = first.split(" ")[1] if first.startswith("HTTP/") and " " in first else ""
    told = found.get("content-length", "")
    return {"http_status": int(status) if status.isdigit() else None, "http_content_type": found.get("content-type"),
            "told": int(told) if told.isdigit() else None}, end


def records(stream, size: int, file: str, wanted: set[str], tests: list[tuple[str, Callable]]) -> Iterator[dict]:
    """The records of a file that pass the tests, with the wanted columns."""
    zipped = stream.read(2) == b"\x1f\x8b"
    source = Members(stream, size) if zipped else Plain(stream, size)
    early = [t for t in tests if t[0] not in IN_HTTP]
    late = [t for t in tests if t[0] in IN_HTTP]
    open_http = bool(late) or bool(wanted & (IN_HTTP | {"payload"}))
    try:
        while source.next():
            block, at = header(source)
            first, found = fields(block)
            if not first.startswith("WARC/"):
                raise ValueError(f"no WARC record but {first[:40]!r}")
            length = int(found["content-length"])
            row = {column: found.get(name) for column, name in NAMED.items()} | {"content_length": length, "file": file, "offset": source.start}
            row = {c: v.strip("<>") if v and c in ("record_id", "refers_to") else v for c, v in row.items()}
            if all(test(row[c]) for c, test in early):
                start, revisit = at, row["record_type"] == "revisit"
                if open_http:
                    row |= {"http_status": None, "http_content_type": None, "payload_bytes": None if revisit else length}
                    if length and (row["content_type"] or "").split(";")[0].strip().lower() == HTTP:
                        more, start = http_part(source, at, length)
                        told = more.pop("told")
                        row |= more | {"payload_bytes": told if revisit else at + length - start}
                if all(test(row[c]) for c, test in late):
                    if "payload" in wanted:
                        row["payload"] = None if revisit else source.upto(at + length)[start:]
                        if not revisit and len(row["payload"]) < at + length - start:
                            raise EOFError
                    yield row
            source.skip(at + length)
    except EOFError:
        raise ValueError(f"{file} is cut off in the record at {source.start}") from None
    except (ValueError, KeyError, zlib.error) as error:
        raise ValueError(f"{file} at {source.start}: {error}") from error


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema, self.tests = options["path"], schema, []
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        unknown = [f.name for f in schema if f.name not in SCHEMA.names or SCHEMA[f.name].dataType != f.dataType]
        if unknown:
            raise ValueError(f"no such columns in a WARC file: {', '.join(unknown)}")

    def pushFilters(self, filters: list[Filter]):
        for condition in filters:
            test = test_of(condition)
            if test is None:
                yield condition
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        system, path = file_system(self.path)
        found = system.get_file_info([path])[0]
        if found.type == fs.FileType.Directory:
            infos = system.get_file_info(fs.FileSelector(path, recursive=True))
            infos = [i for i in infos if not any(p[:1] in "_." for p in os.path.relpath(i.path, path).split("/"))]
        else:
            infos = [found]
        files = sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and i.path.endswith((".warc", ".warc.gz")))
        parts, size = [], 0
        for file in files:
            if not parts or size + file[1] > self.partition_bytes:
                parts.append([])
                size = 0
            parts[-1].append(file)
            size += file[1]
        return [InputPartition(p) for p in parts] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted, schema = set(self.schema.names), to_arrow_schema(self.schema)
        system, _ = file_system(self.path)
        held, size = [], 0
        for file, length in partition.value:
            with system.open_input_file(file) as stream:
                for row in records(stream, length, file, wanted, self.tests):
                    held.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                        yield as_batch(held, schema)
                        held, size = [], 0
        if held:
            yield as_batch(held, schema)


def as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def field(name: str, value) -> bytes:
    """A header line; control characters, which would end it, are percent-encoded."""
    text = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))
    return f"{name}: {text}\r\n".encode()


def record(row: dict) -> bytes:
    """The bytes of a record. A response or revisit gets an HTTP header block with the payload's length."""
    kind, payload = row["record_type"], row.get("payload") or b""
    revisit = kind == "revisit"
    told = row.get("payload_bytes")
    told = len(payload) if told is None else told
    block = b"" if revisit else payload
    content = row.get("content_type")
    if kind in ("response", "revisit"):
        content = f"{HTTP}; msgtype=response"
        status, media = row.get("http_status") or 200, row.get("http_content_type") or "text/html; charset=utf-8"
        block = f"HTTP/1.1 {status} OK\r\n".encode() + field("Content-Type", media) + field("Content-Length", told) + b"\r\n" + block
    lines = [VERSION + b"\r\n", field("WARC-Type", kind), field("WARC-Record-ID", f"<{row['record_id']}>"), field("WARC-Date", row.get("warc_date") or now())]
    if row.get("target_uri") is not None:
        lines.append(field("WARC-Target-URI", row["target_uri"]))
    if row.get("payload_digest"):
        lines.append(field("WARC-Payload-Digest", row["payload_digest"]))
    if row.get("refers_to"):
        lines.append(field("WARC-Refers-To", f"<{row['refers_to']}>"))
    if revisit:
        lines.append(field("WARC-Profile", SAME_PAYLOAD))
    lines += [field("Content-Type", content or "application/octet-stream"), field("Content-Length", len(block)), b"\r\n"]
    return b"".join([*lines, block, BLANK])


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def member(data: bytes, level: int) -> bytes:
    """A gzip member that tells its lengths, where four bytes hold them."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    told = size if size < 1 << 32 else 0
    extra = b"sl" + struct.pack("<HII", 8, told, len(data) & 0xFFFFFFFF)
    return struct.pack("<4BIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        missing = {"record_id", "record_type"} - set(schema.names)
        if missing:
            raise ValueError(f"a WARC record needs {', '.join(sorted(missing))}")
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.level = {"gzip": int(options.get("level", 1)), "none": None}[options.get("compression", "gzip")]
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def _temporary(self, path: str) -> str:
        return f"{path.rstrip('/')}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, path = file_system(self.path)
        folder, context = self._temporary(path), TaskContext.get()
        system.create_dir(folder, recursive=True)
        files, stream, size = [], None, 0

        def put(row: dict) -> int:
            data = record(row)
            data = data if self.level is None else member(data, self.level)
            stream.write(data)
            return len(data)

        try:
            for batch in iterator:
                for at in range(batch.num_rows):
                    if stream is None or size >= self.file_bytes:
                        if stream is not None:
                            stream.close()
                        name = f"part-{context.partitionId():05}-{len(files):03}-{self.job[:8]}-{context.taskAttemptId()}.warc" + (".gz" if self.level is not None else "")
                        files.append(name)
                        # Compressed or not, the bytes are written as they are.
                        stream = system.open_output_stream(f"{folder}/{name}", compression=None)
                        info = f"software: transferlens\r\nformat: {VERSION.decode()}\r\n".encode()
                        size = put({"record_type": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid4()}", "content_type": "application/warc-fields", "payload": info})
                    size += put({name: batch.column(name)[at].as_py() for name in batch.schema.names})
        finally:
            if stream is not None:
                stream.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        path, folder = path.rstrip("/"), self._temporary(path)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if info.type == fs.FileType.File and info.path.endswith((".warc", ".warc.gz")):
                    system.delete_file(info.path)
        system.create_dir(path, recursive=True)
        for message in messages:
            for name in message.files if message else []:
                system.move(f"{folder}/{name}", f"{path}/{name}")
        self._drop(system, folder)

    def abort(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        self._drop(system, self._temporary(path))

    def _drop(self, system: fs.FileSystem, folder: str) -> None:
        if system.get_file_info([folder])[0].type == fs.FileType.Directory:
            system.delete_dir(folder)
        parent = os.path.dirname(folder)
        if system.get_file_info([parent])[0].type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(parent)):
            system.delete_dir(parent)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``format("warc")`` known to the session and lets Spark push predicates into it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, *columns: str, **options) -> DataFrame:
    """The records of a file or folder; only the columns asked for (all, if none are named) are parsed."""
    register(spark)
    schema = T.StructType([SCHEMA[c] for c in columns]) if columns else SCHEMA
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def archive(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html", url: str = "url", least: int = LEAST, **options) -> None:
    """Writes one record per page: a response, or a revisit of the response with an equal payload."""
    register(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("target_uri"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("long")})
    repeated = rows.filter(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    # Written out, so that both sides of a join are shuffled and a hot payload can be split.
    repeated = staged(repeated.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "repeated_payloads")
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST else repeated
    rows = rows.join(repeated, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first")))

    def page(column: str) -> Column:
        return F.concat(F.lit(PAGE), F.coalesce(F.col(column).cast("string"), F.lit("")))

    rows = rows.select(
        page("key").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, page("first")).alias("refers_to"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"))
    rows.write.format("warc").mode("append").options(**options).save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: key, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, which are held against their digests; of revisits only the headers are read.
    """
    def key(column: str) -> Column:
        return F.try_to_number(F.substring(F.col(column), len(PAGE) + 1, 20), F.lit("S9999999999999999999")).cast("long")

    digest = F.substring_index("payload_digest", ":", -1)
    whole = read_warc(spark, path, "record_id", "record_type", "payload_digest", "payload").filter("record_type = 'response'")
    found = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("the payload does not fit the digest of "), "record_id")).cast("string")
    whole = whole.select(key("record_id").alias("key"), F.length("payload").cast("long").alias("payload_bytes"),
                         F.when(found == digest, found).otherwise(wrong).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = read_warc(spark, path, "record_id", "record_type", "payload_digest", "payload_bytes", "refers_to").filter("record_type = 'revisit'")
    again = again.select(key("record_id").alias("key"), "payload_bytes", digest.alias("payload_digest"), "record_type", key("refers_to").alias("refers_to"))
    return whole.union(again)


def archived(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url", least: int = LEAST) -> DataFrame:
    """Writes the archive to the shared folder and reads the pages back from it."""
    path = shared_folder(pages.sparkSession, "warc")
    archive(pages, path, key, payload, url, least)
    return read_pages(pages.sparkSession, path)
