"""Finding which hashes occur more than once in a corpus, with packed messages instead of a row for each hash.

Documents are dealt into chunks of about ``chunk_bytes`` by a hash of their content. A chunk sorts the hashes it has, drops
its own repeats (so a passage that many documents share costs one entry a chunk), and sends each bucket of hash space one
message. A bucket answers every chunk with those of the chunk's hashes that repeat anywhere. The chunk, whose rows come from
the same exchange, then knows its positions again by computing the hashes once more.

32 bits of a hash travel beside the bucket, so an answer may name a hash that does not repeat; callers verify.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

MESSAGE = "bucket int, chunk int, payload binary"
ANSWER = "chunk int, bucket int, payload binary"
_ANSWER = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
_MESSAGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary())])


@dataclass(frozen=True)
class Deal:
    """documents with the column ``chunk``, how many chunks and buckets there are, and the column's name."""

    docs: DataFrame
    chunks: int
    buckets: int
    chunk: str


def deal(docs: DataFrame, keys: list[str], text_col: str, chunk_bytes: int = 8 << 20, bucket_bytes: int = 256 << 20) -> Deal:
    spark = docs.sparkSession
    tk.small_batches(spark)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks, buckets = max(least, -(-total // chunk_bytes)), max(least, -(-total // bucket_bytes))
    name = tk.fresh("chunk", docs.columns)
    return Deal(docs.withColumn(name, F.pmod(F.xxhash64(*keys, text_col), F.lit(chunks)).cast("int")), chunks, buckets, name)


def _pack(tags: np.ndarray, *flags: np.ndarray) -> bytes:
    """Ascending 32-bit values as differences, by byte plane, and flags as bits."""
    steps = np.diff(tags, prepend=tags[:1] * 0).astype("<u4")
    raw = steps.view(np.uint8).reshape(-1, 4).T.tobytes() + b"".join(np.packbits(f).tobytes() for f in flags)
    return len(tags).to_bytes(4, "little") + len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(payload: bytes, flags: int = 0) -> tuple[np.ndarray, ...]:
    n, size = int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little")
    raw = np.frombuffer(pa.decompress(payload[8:], size, "zstd", asbytes=True), np.uint8)
    tags = np.cumsum(np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel(), dtype=np.uint32)
    width = -(-n // 8)
    return tags, *(np.unpackbits(raw[4 * n + k * width : 4 * n + (k + 1) * width], count=n).astype(bool) for k in range(flags))


def _split(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | tag of each hash."""
    return ((hashes >> tk.U64(32)) % tk.U64(buckets) << tk.U64(32)) | (hashes & tk.U64(0xFFFFFFFF))


def cuts(buckets: np.ndarray) -> tuple[list[int], list[slice]]:
    """The buckets that occur in an ascending list, and where: work grows with the hashes a chunk has, not with all buckets."""
    own, first = np.unique(buckets, return_index=True)
    return own.tolist(), [slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(buckets)], strict=True)] if len(own) else []


def messages(chunk: int, hashes: np.ndarray, anchor: np.ndarray, buckets: int) -> pa.Table:
    """A message for each bucket: the distinct hashes, whether the chunk has them twice, and whether one is an anchor."""
    keys = (_split(hashes, buckets) << tk.U64(1)) | (~anchor).astype(tk.U64)
    keys.sort()
    key = keys >> tk.U64(1)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    twice = np.diff(np.append(first, len(key))) > 1
    has_anchor = (keys[first] & tk.U64(1)) == 0
    key = key[first]
    tags = (key & tk.U64(0xFFFFFFFF)).astype(np.uint32)
    own, cut = cuts(key >> tk.U64(32))
    return pa.table([pa.array(own, pa.int32()), pa.array([chunk] * len(own), pa.int32()), pa.array([_pack(tags[c], twice[c], has_anchor[c]) for c in cut], pa.binary())], schema=_MESSAGE)


def answer(table: pa.Table) -> pa.Table:
    """For one bucket: each chunk's hashes that occur at two places at least, one of them an anchor."""
    parts = [_unpack(p, 2) for p in table.column("payload").to_pylist()]
    keys = np.concatenate([(tags.astype(tk.U64) << tk.U64(2)) | (twice.astype(tk.U64) << tk.U64(1)) | has.astype(tk.U64) for tags, twice, has in parts])
    keys.sort()
    tag = keys >> tk.U64(2)
    first = np.flatnonzero(np.concatenate(([True], tag[1:] != tag[:-1])))
    flags = np.bitwise_or.reduceat(keys & tk.U64(3), first)
    often = (np.diff(np.append(first, len(keys))) > 1) | (flags >= 2)
    hot = tag[first[often & ((flags & tk.U64(1)) == 1)]].astype(np.uint32)
    out: list[tuple[int, bytes]] = []
    for chunk, (tags, _, _) in zip(table.column("chunk").to_pylist(), parts, strict=True):
        if len(own := tags[_member(tags, hot)]):
            out.append((chunk, _pack(own)))
    bucket = table.column("bucket")[0].as_py()
    return pa.table([pa.array([c for c, _ in out], pa.int32()), pa.array([bucket] * len(out), pa.int32()), pa.array([p for _, p in out], pa.binary())], schema=_ANSWER)


def _member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def repeated(hashes: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """Flags of the hashes that a chunk's answers name."""
    if not answers.num_rows:
        return np.zeros(len(hashes), bool)
    hot = np.concatenate([(tk.U64(b) << tk.U64(32)) | _unpack(p)[0].astype(tk.U64) for b, p in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True)])
    hot.sort()
    return _member(_split(hashes, buckets), hot)


def chunk_of(left: pa.Table, right: pa.Table, name: str) -> int:
    return (left.column(name) if left.num_rows else right.column("chunk"))[0].as_py()


def find_repeats(dealt: Deal, hashes_of) -> DataFrame:
    """Answers (chunk, bucket, payload); hashes_of(table) gives a chunk's hashes and anchor flags."""
    name, buckets = dealt.chunk, dealt.buckets

    def send(table: pa.Table) -> pa.Table:
        return messages(table.column(name)[0].as_py(), *hashes_of(table), buckets)

    return dealt.docs.groupBy(name).applyInArrow(send, MESSAGE).groupBy("bucket").applyInArrow(answer, ANSWER)
