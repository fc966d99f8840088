"""Vectorised helpers over Arrow string arrays, used inside tasks.

Texts stay UTF-8 bytes in one numpy buffer with document offsets. Words are byte ranges; windows of words or bytes get
polynomial hashes from prefix sums, so every window of a batch costs a few machine operations and no Python loop.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from priceframe.sources import shared

U64 = np.uint64
#: Bytes of text handled at once; keeps the numpy temporaries of a task small whatever the batch.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and a Python worker.
BATCH_BYTES = 8 << 20

_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of columns has, so helper columns never clash with the caller's."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{shared.checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give DataFrame.checkpoint() its folder, and Arrow small batches."""
    small_batches(spark)
    shared.checkpoint_dir(spark)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, so that workers of one executor fit beside each other."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets between them (one more than texts); null is empty."""
    array = as_array(column)
    if array.null_count:
        array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges (first, last + 1) of documents with about limit bytes each; a longer document stands alone."""
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            step = np.full(size, base, U64)
            step[0] = 1
            _powers[key] = np.cumprod(step, dtype=U64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser with two multiplications)."""
    h = h + U64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    h ^= h >> U64(31)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(29)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(32)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64))
_OTHER_VALUES = mix(np.arange(1, 257, dtype=U64), 77)
#: Bytes up to which a word's polynomial is its hash. Modulo 2**64 structured texts of some hundred bytes and more can have
#: equal polynomials whatever the base; longer words are hashed by XXH3.
_LONG_WORD = 64


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i; with them range_hash gives the hash of any range."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start], salt)


def byte_sums(buf: np.ndarray, other: bool = False) -> np.ndarray:
    return prefix_sums((_OTHER_VALUES if other else _BYTE_VALUES)[buf])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False) -> np.ndarray:
    """Hashes of words (byte ranges); the other ones are independent of the first."""
    out = range_hash(byte_sums(buf, other), starts, ends)
    for k in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(buf[starts[k] : ends[k]].tobytes(), seed=11 if other else 7)
    return out


def clean_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space behind each, and their new starts and ends: words i to j are the bytes from start i to end j."""
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    n = np.arange(int(size.sum()))
    before = np.cumsum(size) - size
    out[n + np.repeat(at - before, size)] = buf[n + np.repeat(starts - before, size)]
    return out, at, at + size


def words(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes (is_word: 256 flags), and each document's first word index."""
    n = len(buf)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = is_word[buf]
    first = np.zeros(n + 1, bool)
    first[off] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    return starts, ends, np.searchsorted(starts, off)


def rolling(values: np.ndarray, ptr: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start indexes of all windows of k values within one document (ptr: documents' bounds) and the windows' hashes."""
    n = len(values)
    if n < k:
        return np.empty(0, np.int64), np.empty(0, U64)
    doc_end = np.repeat(ptr[1:], np.diff(ptr))
    start = np.flatnonzero(np.arange(n) + k <= doc_end)
    return start, range_hash(prefix_sums(values), start, start + k, salt)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Flags of the n positions that lie in a range of k from one of starts."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + k, -1)
    return np.cumsum(change[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, set on the given inclusive byte ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words of [^\x20\x09-\x0D]+, and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z (so A-Z never occurs).
NOT_SPACE = ~table((0x09, 0x0D), (0x20, 0x20))
ALNUM = ~table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
