"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned over every document window.

Normalised: A-Z lower-cased, words are runs of digits, a-z and non-ASCII characters. A window is ``n`` consecutive words of
an item; an item of fewer words, but not none, is one window. A document word inside an occurrence of a window is hit.

The benchmark is read in slices of at most ``slice_bytes`` of text, whose size is measured before anything is broadcast; one
slice is the usual case. More slices are scanned one after the other, each adding its hits to the documents' bitmaps, and
lineage is cut in between, so no task holds more than one slice.

Defined cases: null or empty texts have no words and no hits; items without words have no windows; repeated items all
count; an item whose id is null marks words and counts as an item, named by the empty string; repeated documents are each
judged alone; no column but the text is looked at, and helper columns take names that the table does not have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

REPORT = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start: int, end: int>>"
_STATE = "cover binary, item_ids array<string>"


class WindowIndex:
    """Hashes of all windows of some items, by window length, with the words to verify a hit and the items' ids."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.n = n
        self.by_length: dict[int, tuple[np.ndarray, list[dict[bytes, list[str]]]]] = {}
        found: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for item, text in items:
            buf = tk.LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = tk.words(buf, np.array([0, len(buf)]), tk.ALNUM)
            if not len(starts):
                continue
            size = min(n, len(starts))
            values = tk.range_hash(tk.byte_sums(buf), starts, ends)
            at, hashes = tk.rolling(values, np.array([0, len(values)]), size)
            for i, h in zip(at.tolist(), hashes.tolist(), strict=True):
                own = found.setdefault(size, {}).setdefault(h, {}).setdefault(_join(buf, starts, ends, i, size), [])
                if item not in own:
                    own.append(item)
        for size, entries in found.items():
            keys = sorted(entries)
            self.by_length[size] = np.array(keys, tk.U64), [entries[k] for k in keys]

    def scan(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, list[str]]], np.ndarray]:
        """Word starts, ends and document bounds, the verified hits (word index, length, ids), and the flags of hit words."""
        low = tk.LOWER[buf]
        starts, ends, ptr = tk.words(low, off, tk.ALNUM)
        values = tk.range_hash(tk.byte_sums(low), starts, ends)
        hits, flags = [], np.zeros(len(starts), bool)
        for size, (keys, entries) in self.by_length.items():
            at, hashes = tk.rolling(values, ptr, size)
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            like = np.flatnonzero(keys[place] == hashes)
            true = []
            for i, k in zip(at[like].tolist(), place[like].tolist(), strict=True):
                if ids := entries[k].get(_join(low, starts, ends, i, size)):
                    true.append(i)
                    hits.append((i, size, ids))
            if true:
                flags |= tk.covered(np.array(true), size, len(starts))
        return starts, ends, ptr, hits, flags


def _join(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, size: int) -> bytes:
    """The words from i on, joined by a space."""
    raw, a = buf[starts[i] : ends[i + size - 1]].tobytes(), starts[i]
    return b" ".join(raw[s - a : e - a] for s, e in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True))


def _slices(benchmark: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> Iterator[list[tuple[str, str]]]:
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // slice_bytes)) if total > slice_bytes else 1
    for part in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        yield [(r.item, r.text) for r in own.collect()]


def _scan_udf(index, report: bool):
    """One pass over texts with one slice: state in, state out, or the report after the last slice."""

    def scan(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        idx: WindowIndex = index.value
        for batch in batches:
            text, covers, names = (batch[0], batch[1].field(0).to_pylist(), batch[1].field(1).to_pylist()) if len(batch) > 1 else (batch[0], None, None)
            buf, off = tk.utf8(text)
            out: list[dict] = []
            for a, b in tk.slices(off):
                part = off[a : b + 1] - off[a]
                starts, ends, ptr, hits, flags = idx.scan(buf[off[a] : off[b]], part)
                ids: list[set[str]] = [set() for _ in range(b - a)]
                of = np.searchsorted(ptr, [h[0] for h in hits], "right") - 1
                for d, h in zip(of.tolist(), hits, strict=True):
                    ids[d].update(h[2])
                for d in range(b - a):
                    own = flags[ptr[d] : ptr[d + 1]]
                    if covers is not None:
                        if covers[a + d]:
                            own = own | np.unpackbits(np.frombuffer(covers[a + d], np.uint8), count=len(own)).astype(bool)
                        ids[d].update(names[a + d] or ())
                    if not report:
                        out.append({"cover": np.packbits(own).tobytes() if own.any() else None, "item_ids": sorted(ids[d])})
                        continue
                    first, last = tk.runs(own)
                    spans = []
                    if len(first):
                        raw = buf[off[a] : off[b]]
                        heads = np.cumsum(np.concatenate(([0], (raw[part[d] : part[d + 1]] & 0xC0) != 0x80)))
                        at = heads[starts[ptr[d] + first] - part[d]], heads[ends[ptr[d] + last - 1] - part[d]]
                        spans = [{"start": x, "end": y} for x, y in zip(at[0].tolist(), at[1].tolist(), strict=True)]
                    out.append({"n_words": len(own), "n_hit": int(own.sum()), "item_ids": sorted(ids[d]), "spans": spans})
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]) if report else pa.struct([("cover", pa.binary()), ("item_ids", pa.list_(pa.string()))])
            yield pa.array(out, kind)

    if report:
        return scan, T._parse_datatype_string(REPORT)
    return scan, T._parse_datatype_string(_STATE)


def _as_udf(fn, kind, first: bool):
    """Spark reads the calling convention off the annotations: one array, or a tuple of arrays, at a time."""
    if first:
        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return fn((b,) for b in batches)

        return F.arrow_udf(one, kind)

    def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return fn(batches)

    return F.arrow_udf(many, kind)


def find(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 13, slice_bytes: int = 32 << 20, into: str = "found") -> DataFrame:
    """docs with a struct column ``into``: n_words, n_hit, item_ids (sorted strings) and hit spans in code points."""
    spark = docs.sparkSession
    tk.small_batches(spark)
    parts = list(_slices(benchmark, item_col, item_text_col, slice_bytes))
    state = tk.fresh("state", [*docs.columns, into])
    for k, items in enumerate(parts):
        last = k == len(parts) - 1
        fn, kind = _scan_udf(spark.sparkContext.broadcast(WindowIndex(items, n)), last)
        args = [F.col(text_col)] + ([F.col(state)] if k else [])
        docs = docs.withColumn(into if last else state, _as_udf(fn, kind, not k)(*args))
        if not last:
            tk.ensure_checkpoint_dir(spark)
            docs = docs.checkpoint()
    return docs.drop(state)


def contaminated(found: str = "found", per: int = 20):
    """The contamination rule: hit at all, and at least one word in ``per`` hit."""
    return (F.col(f"{found}.n_hit") > 0) & (per * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def digest(found: DataFrame, id_col: str = "doc_id", col: str = "found") -> DataFrame:
    """One row per document of ``find``'s result: counts, the items' digest and the verdict."""
    return found.select(
        id_col,
        F.col(f"{col}.n_words").alias("n_words"),
        F.col(f"{col}.n_hit").alias("n_hit"),
        F.size(f"{col}.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(f"{col}.item_ids"), ","), 256).alias("items_sha256"),
        contaminated(col).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated ones, same columns."""
    into = tk.fresh("found", docs.columns)
    return find(docs, benchmark, into=into, **options).where(~contaminated(into)).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with the hit spans cut out of every text, same columns; the characters between words stay."""
    into = tk.fresh("found", docs.columns)
    found = find(docs, benchmark, text_col=text_col, into=into, **options)
    spans, text = F.col(f"{into}.spans"), F.col(text_col)
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a)), "")
    return found.withColumn(text_col, F.when(F.size(spans) > 0, kept).otherwise(text)).select(*docs.columns)

