"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: every task writes gzip archives of about ``rollBytes`` under names of its own attempt, a member for each record, whose
gzip extra field "SL" records the member's length; when the job commits, the driver writes the list of committed files, so
files of lost or repeated attempts are never read.

Reading: the driver plans file partitions: ranges of whole archives of about ``splitBytes``. Predicates on ``warc_type`` and on
the header columns are pushed down. Of each record the headers are inflated first, a few hundred bytes; where the record fails
a predicate, or its payload is not wanted (``payload`` option false), the reader goes on at the next member by the recorded
length and inflates no more of it. Archives of other writers have no lengths; their members are inflated through.

Paths are opened through Arrow's file systems, so they may be local, shared or remote (``file://``, ``hdfs://``, ``s3://``).

Defined cases: a null payload is written as the empty payload; an empty table makes an archive folder with an empty list;
null header values leave the header out and are read back as null; records are independent, so repeated ones stay, and rows
that repeat a page id and its payload have the same smallest id: all of them are responses. Header names are matched in any
case, text that is no UTF-8 is read with replacement marks, a number that is none is null. An archive is read up to its first
damaged place: a record that ends before its stated length is left out, with what follows it in that file. Only the three
named columns of a table are read, whatever the names of others.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from . import textkit as tk

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date string, page_id long, payload_digest string, refers_to long, payload_bytes long, payload binary"
_ARROW = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
_HEADERS = {"record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "page_id": "X-Page-ID", "payload_digest": "WARC-Payload-Digest", "refers_to": "X-Refers-To-Page", "payload_bytes": "X-Payload-Bytes"}
_NUMBERS = ("page_id", "refers_to", "payload_bytes")
_LIST = "_committed.json"
_READ = 1 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(values: dict) -> bytes:
    """One record; a revisit carries no payload, only its size and digest."""
    payload = values["payload"] or b""
    body = b"" if values["warc_type"] == "revisit" else payload
    values = {**values, "payload_bytes": len(payload), "payload_digest": f"sha1:{values.get('payload_digest') or payload_digest(payload)}"}
    lines = ["WARC/1.1", *(f"{h}: {_clean(values[c])}" for c, h in _HEADERS.items() if values.get(c) is not None)]
    if values["warc_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _clean(value) -> str:
    """A header value on one line."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


#: A gzip header with a modification time of zero and an extra field of 12 bytes: subfield SL, 8 bytes long.
_GZIP = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + (12).to_bytes(2, "little") + b"SL" + (8).to_bytes(2, "little")


def _member(raw: bytes, level: int) -> bytes:
    """A gzip member that records its own length."""
    pack = zlib.compressobj(level, wbits=-15)
    body = pack.compress(raw) + pack.flush()
    return _GZIP + (len(_GZIP) + 16 + len(body)).to_bytes(8, "little") + body + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")


def _length(head: bytes) -> int | None:
    """The recorded length of the member that starts here, null for members of other writers."""
    return int.from_bytes(head[len(_GZIP) : len(_GZIP) + 8], "little") if head.startswith(_GZIP) and len(head) >= len(_GZIP) + 8 else None


@dataclass
class _Commit(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, roll: int, level: int):
        self.path, self.roll, self.level = path, roll, level

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, top = _open(self.path)
        store.create_dir(top, recursive=True)
        files, out, size, name = [], None, 0, ""
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for values in batch.slice(start, 256).to_pylist():
                    if out is None:
                        name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    member = _member(_record(values), self.level)
                    out.write(member)
                    size += len(member)
                    if size >= self.roll:
                        out.close()
                        files.append((name, size))
                        out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Commit(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, top = _open(self.path)
        store.create_dir(top, recursive=True)
        with store.open_output_stream(f"{top}/{_LIST}") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, top = _open(self.path)
        for name, _ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{top}/{name}")


@dataclass
class _Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, split: int, payload: bool):
        self.path, self.split, self.payload, self.filters = path, split, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take the predicates on one header column; Spark keeps the others."""
        for f in filters:
            if isinstance(f, EqualTo | In | IsNotNull | StringStartsWith) and len(f.attribute) == 1 and f.attribute[0] in _HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, top = _open(self.path)
        if store.get_file_info(f"{top}/{_LIST}").type == fs.FileType.File:
            with store.open_input_stream(f"{top}/{_LIST}") as f:
                files = [tuple(x) for x in json.loads(f.read())]
        else:
            found = store.get_file_info(fs.FileSelector(top))
            files = sorted((x.base_name, x.size) for x in found if x.base_name.endswith((".warc.gz", ".warc")))
        out: list[InputPartition] = []
        names, size = [], 0
        for name, own in files:
            if names and size + own > self.split:
                out.append(_Files(names))
                names, size = [], 0
            names, size = [*names, name], size + own
        return [*out, _Files(names)] if names or not out else out

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, top = _open(self.path)
        rows: list[dict] = []
        held = 0
        for name in partition.names:
            with store.open_input_file(f"{top}/{name}") as file:
                for row in _records(file, name.endswith(".gz"), self._wanted, self.payload):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 4096 or held >= 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _wanted(self, row: dict) -> bool:
        for f in self.filters:
            value = row[f.attribute[0]]
            if value is None:
                return False
            if isinstance(f, EqualTo) and value != f.value or isinstance(f, In) and value not in f.value or isinstance(f, StringStartsWith) and not value.startswith(f.value):
                return False
        return True


class _Window:
    """Any range of a file through one buffer; ranges that lie beyond it are sought, not read through."""

    def __init__(self, file):
        self.file, self.start, self.held = file, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            self.file.seek(at)
            self.start, self.held = at, self.file.read(max(n, _READ))
        return self.held[at - self.start : at - self.start + n]


class _Source:
    """Bytes of a file from some place on, inflated member by member as far as they are asked for."""

    def __init__(self, file, packed: bool):
        self.file, self.packed = file, packed
        self.raw, self.clear = b"", b""
        self.member = None

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.file.read(_READ)
                if not self.raw:
                    return False
            if not self.packed:
                self.clear, self.raw = self.clear + self.raw, b""
                return True
            if self.member is None:
                self.member = zlib.decompressobj(wbits=31)
            try:
                got = self.member.decompress(self.raw, 1 << 18)
            except zlib.error:
                return False
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = None
            if got:
                self.clear += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.clear.find(mark)
        while at < 0:
            if not self.more():
                return None
            at = self.clear.find(mark)
        out, self.clear = self.clear[:at], self.clear[at + len(mark) :]
        return out

    def take(self, n: int, keep: bool) -> bytes | None:
        """The next n bytes, null where fewer are left; without keep they are dropped piece by piece."""
        parts = []
        while n:
            if not self.clear and not self.more():
                return None
            piece, self.clear = self.clear[:n], self.clear[n:]
            n -= len(piece)
            if keep:
                parts.append(piece)
        return b"".join(parts)


def _parsed(head: bytes) -> tuple[dict, int]:
    """A record's columns and the length of its body, from its headers."""
    lines = head.strip(b"\r\n").decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:])
    named = {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}
    number = lambda x: int(x) if x is not None and x.isascii() and x.isdigit() else None
    row: dict = {c: named.get(h.lower()) for c, h in _HEADERS.items()}
    row |= {c: number(row[c]) for c in _NUMBERS}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    return row, number(named.get("content-length")) or 0


def _records(file, packed: bool, wanted, payload: bool, seen: dict | None = None) -> Iterator[dict]:
    """The wanted records of one archive. seen counts inflated bytes."""
    window, at = _Window(file), 0
    seen = seen if seen is not None else {}
    has_body = lambda row: payload and row["warc_type"] != "revisit"
    while packed and (length := _length(window.get(at, len(_GZIP) + 8))) is not None:
        inflate, clear, fed = zlib.decompressobj(wbits=31), b"", 0
        try:
            while b"\r\n\r\n" not in clear and not inflate.eof:
                piece = inflate.unconsumed_tail or window.get(at + fed, min(512, length - fed))
                fed += 0 if inflate.unconsumed_tail else len(piece)
                if not piece:
                    return
                clear += inflate.decompress(piece, 1024)
            head, found, body = clear.partition(b"\r\n\r\n")
            if not found:
                return
            row, size = _parsed(head)
            keep = wanted(row)
            if keep and has_body(row):
                body += inflate.decompress(inflate.unconsumed_tail + window.get(at + fed, length - fed))
                if len(body) < size or not inflate.eof:
                    return
        except zlib.error:
            return
        seen["inflated"] = seen.get("inflated", 0) + len(head) + len(body)
        if keep:
            yield {**row, "payload": body[:size] if has_body(row) else None}
        at += length
    file.seek(at)
    source = _Source(file, packed)
    while (head := source.until(b"\r\n\r\n")) is not None:
        row, size = _parsed(head)
        keep = wanted(row)
        body = source.take(size, keep and has_body(row))
        if body is None:
            return
        source.take(4, False)
        if keep:
            yield {**row, "payload": body if has_body(row) else None}


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        o = self.options
        return WarcReader(o["path"], int(o.get("splitbytes", o.get("splitBytes", 64 << 20))), o.get("payload", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        o = self.options
        return WarcWriter(o["path"], int(o.get("rollbytes", o.get("rollBytes", 64 << 20))), int(o.get("level", 6)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """WARC records of pages. Of pages with the same payload of at least min_bytes, the smallest id is the response and the
    others revisit it. Payloads are grouped by length and two digests before any payload moves, with partial minima."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    key = ["payload_bytes", "sha", "sha_2"]
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("target_uri"), payload.alias("payload"))
    own = own.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha1("payload")), "sha_2": F.xxhash64("payload")})
    first = own.where(F.col("payload_bytes") >= min_bytes).groupBy(*key).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = own.join(first, key, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        "page_id",
        F.lit(None).cast("string").alias("payload_digest"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "payload_bytes",
        "payload",
    )


def write(pages: DataFrame, path: str, **options) -> None:
    register(pages.sparkSession)
    records(pages, **options).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


@F.arrow_udf(StringType())
def digest_of(payloads: pa.Array) -> pa.Array:
    return pa.array([None if p is None else payload_digest(p) for p in payloads.to_pylist()], pa.string())


def digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive folder. Responses are read with their payloads, whose size and digest are counted on
    what was decoded; revisits, which carry none, by a pushed predicate and from their headers."""
    full = read(spark, path).where("warc_type = 'response'")
    full = full.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest_of("payload").alias("payload_digest"), F.col("warc_type").alias("record_type"), "refers_to")
    bare = read(spark, path, payload=False).where("warc_type = 'revisit'")
    return full.unionByName(bare.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to"))
