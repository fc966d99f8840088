"""Substring dedup over words: fixed-block anchors, rolling probes, extension of hits to maximal exact repeats.

A repeat is a run of ``window`` words that also starts somewhere else in the corpus. Every document is cut into
non-overlapping reference blocks of ``(window + 1) // 2`` words; any window holds a whole block of its document, so if it
repeats, the block's words occur at the other place too and a rolling window of block length finds them there. Blocks and
probes meet in packed buckets of hash space (see anchors). Around every hit the windows that hold it are compared by a 64-bit
polynomial over their words' hashes and 64 bits of BLAKE2b over the words themselves, joined by spaces; windows that occur twice
are marked and their union is the maximal repeat. The polynomial alone removes nothing.

Defined cases: null or empty texts have no words; documents shorter than the window lose nothing; a repeat within one
document counts, overlapping ones too; repeated rows are copies of each other and lose what they share; words are compared
byte by byte, unchanged. Other columns are passed through, and helper columns take names the table does not have.
"""

from __future__ import annotations

import hashlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from . import anchors
from . import textkit as tk

#: Two hashes of a window.
PAIR = np.dtype([("one", "<u8"), ("two", "<u8")])


class _Words:
    """Words of a chunk's texts: hashes of the words and the documents' bounds."""

    def __init__(self, texts: pa.ChunkedArray):
        self.buf, self.off = tk.utf8(texts)
        starts, ends, values, ptr = [], [], [], [np.zeros(1, np.int64)]
        for a, b in tk.slices(self.off):
            buf = self.buf[self.off[a] : self.off[b]]
            s, e, p = tk.words(buf, self.off[a : b + 1] - self.off[a], tk.NOT_SPACE)
            values.append(tk.word_hashes(buf, s, e))
            starts.append(s + self.off[a])
            ends.append(e + self.off[a])
            ptr.append(p[1:] + ptr[-1][-1])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.starts, self.ends, self.values, self.ptr = join(starts, np.int64), join(ends, np.int64), join(values, tk.U64), np.concatenate(ptr)

    def probes(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all rolling windows of block words, their hashes, and which are the documents' own blocks."""
        at, hashes = tk.rolling(self.values, self.ptr, block)
        first = np.repeat(self.ptr[:-1], np.diff(self.ptr))
        return at, hashes, (at - first[at]) % block == 0

    def digests(self, at: np.ndarray, window: int) -> np.ndarray:
        """64 bits of a digest of the words of each window, joined by spaces."""
        text, starts, ends = tk.clean_words(self.buf, self.starts, self.ends)
        view = memoryview(text)
        own = (blake2b(view[a:b], digest_size=8).digest() for a, b in zip(starts[at].tolist(), ends[at + window - 1].tolist(), strict=True))
        return np.frombuffer(b"".join(own), tk.U64)


def _near(hits: np.ndarray, starts: np.ndarray, window: int, block: int, n: int) -> np.ndarray:
    """Those window starts whose window holds a hit block."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.maximum(hits - (window - block), 0), 1)
    np.add.at(change, hits + 1, -1)
    return starts[np.cumsum(change[:-1])[starts] > 0]


def _mark(docs: DataFrame, id_cols: list[str], text_col: str, window: int, chunk_bytes: int, finish, schema: str | StructType) -> DataFrame:
    """finish(table, words, flags of removed words) makes the rows of each chunk."""
    block = (window + 1) // 2
    dealt = anchors.deal(docs, id_cols, text_col, chunk_bytes)
    name, buckets = dealt.chunk, dealt.buckets

    def hashes_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _Words(table.column(text_col)).probes(block)[1:]

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Hashes of the windows around hits: 64 bits that choose the bucket, and 64 of a digest of the words."""
        chunk = anchors.chunk_of(table, answers, name)
        if not answers.num_rows or not table.num_rows:
            return _windows_table(chunk, np.empty(0, tk.U64), np.empty(0, tk.U64), buckets)
        words = _Words(table.column(text_col))
        at, hashes, _ = words.probes(block)
        hits = at[anchors.repeated(hashes, answers, buckets)]
        starts = _near(hits, tk.rolling(words.values, words.ptr, window)[0], window, block, len(words.values))
        one = tk.range_hash(tk.prefix_sums(words.values), starts, starts + window, 1)
        return _windows_table(chunk, one, words.digests(starts, window), buckets)

    def apply(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = _Words(table.column(text_col))
        flags = np.zeros(len(words.values), bool)
        if answers.num_rows and table.num_rows:
            hot = np.sort(np.concatenate([np.frombuffer(p, PAIR) for p in answers.column("payload").to_pylist()]))
            at, hashes = tk.rolling(words.values, words.ptr, window, 1)
            maybe = anchors._member(hashes, hot["one"])
            own = np.empty(int(maybe.sum()), PAIR)
            own["one"], own["two"] = hashes[maybe], words.digests(at[maybe], window)
            flags = tk.covered(at[maybe][np.isin(own, hot)], window, len(flags))
        return finish(table, words, flags)

    hits = anchors.find_repeats(dealt, hashes_of)
    windows = dealt.docs.groupBy(name).cogroup(hits.groupBy("chunk")).applyInArrow(extend, anchors.MESSAGE)
    repeats = windows.groupBy("bucket").applyInArrow(_repeated_windows, anchors.ANSWER)
    return dealt.docs.groupBy(name).cogroup(repeats.groupBy("chunk")).applyInArrow(apply, schema)


def _windows_table(chunk: int, one: np.ndarray, two: np.ndarray, buckets: int) -> pa.Table:
    """A message for each bucket: distinct pairs of hashes and a flag of those that the chunk has twice."""
    order = np.lexsort((two, one, one % tk.U64(buckets)))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))) if len(one) else np.empty(0, np.int64)
    twice = np.diff(np.append(first, len(one))) > 1
    one, two = one[first], two[first]
    own, cut = anchors.cuts(one % tk.U64(buckets))
    payloads = [one[c].tobytes() + two[c].tobytes() + twice[c].tobytes() for c in cut]
    return pa.table([pa.array(own, pa.int32()), pa.array([chunk] * len(own), pa.int32()), pa.array(payloads, pa.binary())], schema=anchors._MESSAGE)


def _repeated_windows(table: pa.Table) -> pa.Table:
    parts = []
    for k, payload in enumerate(table.column("payload").to_pylist()):
        n = len(payload) // 17
        parts.append((np.frombuffer(payload, "<u8", n), np.frombuffer(payload, "<u8", n, 8 * n), np.frombuffer(payload, bool, n, 16 * n), np.full(n, k)))
    one, two, twice, of = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    size = np.diff(np.append(first, len(a)))
    often = np.repeat(np.logical_or.reduceat(twice[order], first) | (size > 1), size)
    kept = order[often]
    kept = kept[np.argsort(of[kept], kind="stable")]
    bounds = np.searchsorted(of[kept], np.arange(len(parts) + 1))
    chunks, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
    pairs = np.empty(len(kept), PAIR)
    pairs["one"], pairs["two"] = one[kept], two[kept]
    out = [(c, pairs[bounds[k] : bounds[k + 1]].tobytes()) for k, c in enumerate(chunks) if bounds[k] < bounds[k + 1]]
    return pa.table([pa.array([c for c, _ in out], pa.int32()), pa.array([bucket] * len(out), pa.int32()), pa.array([p for _, p in out], pa.binary())], schema=anchors._ANSWER)


def _kept(words: _Words, flags: np.ndarray, d: int) -> bytes:
    """The kept words of a document, joined by a space."""
    a, b = words.ptr[d], words.ptr[d + 1]
    own = words.buf[words.off[d] : words.off[d + 1]].tobytes()
    parts = own.split()
    if flags[a:b].any():
        parts = [parts[k] for k in np.flatnonzero(~flags[a:b]).tolist()]
    return b" ".join(parts)


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35, chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256."""
    kind = dict(docs.dtypes)[id_col]

    def finish(table: pa.Table, words: _Words, flags: np.ndarray) -> pa.Table:
        removed = np.diff(np.concatenate(([0], np.cumsum(flags)))[words.ptr])
        shas = [hashlib.sha256(_kept(words, flags, d)).hexdigest() for d in range(table.num_rows)]
        return pa.table({id_col: table.column(id_col), "n_words": pa.array(np.diff(words.ptr), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())})

    docs = docs.select(id_col, text_col)
    return _mark(docs, [id_col], text_col, window, chunk_bytes, finish, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35, chunk_bytes: int = 8 << 20) -> DataFrame:
    """docs with repeats removed from the texts: the kept words joined by a space; untouched texts stay as they are."""
    columns = docs.columns

    def finish(table: pa.Table, words: _Words, flags: np.ndarray) -> pa.Table:
        touched = np.diff(np.concatenate(([0], np.cumsum(flags)))[words.ptr]) > 0
        old = table.column(text_col).to_pylist()
        new = [_kept(words, flags, d).decode() if touched[d] else old[d] for d in range(table.num_rows)]
        at = table.schema.get_field_index(text_col)
        return table.set_column(at, text_col, pa.array(new, pa.string())).select(columns)

    return _mark(docs, [id_col], text_col, window, chunk_bytes, finish, docs.schema)
