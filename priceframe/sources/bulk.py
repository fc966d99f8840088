"""Bulk price files as rows: big CSV files with some lines before the header, split at record ends.

A file's header is known only when it is read, and a quoted cell may hold line ends, so a split cannot tell by itself whether it
begins inside quotes. One pass counts the quotes of every split; a running sum over a file's splits gives the state at each
beginning. The second pass finds the record ends in a split from its quotes' parity, reads on to the end of the last record
that begins there, and parses each record once, for the columns asked for. Records that name none of some texts are not parsed.
Gzip files are one split each, read in windows.

Files are listed by Spark and opened through Arrow's file systems (``file://``, ``hdfs://``, ``s3://``). A missing column is
null, a cell that a short record lacks is blank; a file that ends before its header has no rows; bytes that are no UTF-8 are
replaced; headers are stripped, and of equal ones the last counts.
"""

from __future__ import annotations

import csv
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT_BYTES = 64 << 20
_WINDOW = 8 << 20
_LF, _QUOTE = 0x0A, 0x22


def _open(path: str):
    store, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path)) if ":/" in path else (fs.LocalFileSystem(), path)
    return store.open_input_file(where)


def _chunks(path: str, start: int) -> Iterator[bytes]:
    """The file's bytes from start on; gzip files, of several members too, from their beginning."""
    with _open(path) as file:
        if not path.endswith(".gz"):
            file.seek(start)
            while data := file.read(_WINDOW):
                yield data
            return
        unzip = zlib.decompressobj(31)
        while data := file.read(_WINDOW // 4):
            while data:
                yield unzip.decompress(data)
                data = unzip.unused_data
                if unzip.eof:
                    unzip = zlib.decompressobj(31)


def _records(path: str, start: int, end: int | None, inside: bool) -> Iterator[tuple[int, bytes]]:
    """Records that begin from start to before end, with their places; inside: whether start lies in quotes. The bytes before
    the first record end are another split's."""
    rest, at, skip = b"", start, start > 0
    if skip:  # the byte before tells whether a record begins right at start
        with _open(path) as file:
            file.seek(start - 1)
            skip = not (file.read(1) == b"\n" and not inside)
    odd = int(inside)
    for data in _chunks(path, start):
        block = np.frombuffer(data, np.uint8)
        parity = (np.cumsum(block == _QUOTE) + odd) & 1
        odd = int(parity[-1]) if len(block) else odd
        begin = 0
        for stop in (np.flatnonzero((block == _LF) & (parity == 0)) + 1).tolist():
            record = rest + data[begin:stop]
            if not skip:
                if end is not None and at >= end:
                    return
                yield at, record
            skip = False
            at, rest, begin = at + len(record), b"", stop
        rest += data[begin:]
    if rest and not skip and (end is None or at < end):
        yield at, rest


def _cells(record: bytes) -> list[str]:
    text = record.decode("utf-8", "replace").rstrip("\r\n")
    return next(csv.reader([text]), []) if "\r" not in text else next(csv.reader(io.StringIO(text, newline="")), [])


def parse_line(text: Column) -> Column:
    """The cells of a CSV line as an array, however many there are; no cells for null."""

    def cells(lines: pa.Array) -> pa.Array:
        return pa.array([_cells((x or "").encode()) for x in lines.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(cells, "array<string>")(text)


def splits(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, start, end (null: to its end) and inside of every split."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), "length").where("length > 0")
    packed = F.col("file").endswith(".gz")
    step = F.when(packed, F.col("length")).otherwise(F.lit(split_bytes))
    parts = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)).alias("start"))
    parts = parts.select("file", "start", F.when(~packed, F.least(F.col("start") + split_bytes, "length")).alias("end"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for path, start, end in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                left, n = (end or 0) - start, 0
                if end is not None:
                    with _open(path) as file:
                        file.seek(start)
                        while left > 0 and (data := file.read(min(left, _WINDOW))):
                            n += data.count(b'"')
                            left -= len(data)
                quotes.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], ["file", "start", "end", "quotes"])

    n = max(1, parts.count())
    counted = parts.repartition(n, "file", "start").mapInArrow(count, "file string, start long, end long, quotes long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", "end", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")).repartition(n, "file", "start")


def read(spark: SparkSession, path: str, columns: list[str], naming: list[str] | None = None, preamble: int = 5, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row for each record below the header of the files under path: file, at (the record's first byte) and the columns. With
    naming, only records that hold one of its texts."""
    wanted = re.compile(b"|".join(re.escape(x.encode()) for x in naming)) if naming else None
    kinds = pa.schema([("file", pa.string()), ("at", pa.int64()), *[(c, pa.string()) for c in columns]])

    def rows(path: str, start: int, end: int | None, inside: bool) -> Iterator[tuple]:
        head = None
        for k, (at, record) in enumerate(_records(path, 0, None, False)):
            if k == preamble:
                head = at, {name.strip(): n for n, name in enumerate(_cells(record))}
                break
        if head is None:
            return
        places = [head[1].get(c) for c in columns]
        for at, record in _records(path, start, end, inside):
            if at <= head[0] or not record.strip() or (wanted and not wanted.search(record)):
                continue
            cells = _cells(record)
            yield path, at, *[None if n is None else cells[n] if n < len(cells) else "" for n in places]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                held: list[tuple] = []
                for row in rows(*split):
                    held.append(row)
                    if len(held) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds.types, strict=True)], schema=kinds)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds.types, strict=True)], schema=kinds)

    schema = "file string, at long, " + ", ".join(f"`{c}` string" for c in columns)
    return splits(spark, path, split_bytes).select("file", "start", "end", "inside").mapInArrow(parse, schema)
