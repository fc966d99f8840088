"""Best-two-fit packing of tokenized documents into sequences of bounded length.

Texts become ids (a document's ids and an end id), ids longer than a sequence are cut, and the pieces are packed: a sequence is
filled greedily, the largest piece that fits its gap first; if a gap is left, its smallest piece is taken out when two unpacked
pieces fit the widened gap more tightly, and the tightest two take its place. Sizes are small whole numbers, so the pieces wait
in one stack for each size, and a set of sizes as a bit string finds the largest that fits in one step.

Pieces are dealt into groups of about ``group`` pieces by a key made with them, and each group is packed by itself: no task
grows with the corpus, and a group's border costs about one sequence. Pieces are written once to the shared folder, so a
lost executor repeats the packing of its groups, not the tokenizing, and gets the same sequences.

A worker encodes each distinct part of its texts once and remembers a bounded number of them: parts end where the tokenizer's
pattern ends a match whatever stands around, so the ids are those of the whole text (a test compares them).

Defined cases: null and empty texts are the end id alone; rows with a null id and repeated rows are documents of their own; no
documents, no rows; a very long text gives many pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceframe.sources.shared import written

from . import textkit as tk

LENGTH, END_ID, GROUP = 2048, 0, 32768
#: Bytes of text whose distinct parts are encoded together, and parts whose ids a worker remembers.
_SLICE, _KNOWN = 8 << 20, 1 << 20
#: Parts also end between an ASCII letter and another ASCII character, where the tokenizer's pattern ends a match in any case;
#: not behind an apostrophe, which may start a contraction, and not at a bar, which belongs to the special tokens.
_LETTER = tk.table((0x41, 0x5A), (0x61, 0x7A))
_SIGN = tk.table((0x00, 0x7F)) & ~_LETTER & ~tk.table((0x7C, 0x7C), (0x09, 0x0D), (0x20, 0x20))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def gather(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow array of texts."""
    off = np.concatenate(([0], np.cumsum(ends - starts)))
    at = np.arange(off[-1]) + np.repeat(starts - off[:-1], ends - starts)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf[at]))])


class _Codes:
    """Ids of the parts a worker has met, at most about _KNOWN parts; more than that, and it starts anew."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.bounds = array("I"), array("q", [0])

    def of(self, parts: list[str]) -> np.ndarray:
        if len(self.index) > _KNOWN:
            self.clear()
        known = np.fromiter(map(self.index.get, parts, repeat(-1)), np.int64, len(parts))
        absent = np.flatnonzero(known < 0)
        if len(absent):
            new = [parts[k] for k in absent.tolist()]
            ids = [coded.ids for coded in _tokenizer(self.path).encode_batch_fast(new, add_special_tokens=False)]
            known[absent] = np.arange(len(self.index), len(self.index) + len(new))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.bounds.extend(accumulate(map(len, ids), initial=self.bounds.pop()))
            self.flat.extend(chain.from_iterable(ids))
        return known


_codes = lru_cache(maxsize=2)(_Codes)


def _parts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of parts that are encoded alike alone and in the text, and each document's first part."""
    starts, ends, _ = tk.words(buf, off, tk.NOT_SPACE)
    before, after = buf[:-1], buf[1:]
    cut = np.flatnonzero((_LETTER[before] & _SIGN[after]) | (_SIGN[before] & (before != ord("'")) & _LETTER[after])) + 1
    inside = tk.NOT_SPACE[buf[cut - 1]] & ~np.isin(cut, off)
    cut = cut[inside]
    starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, off)


def encode(texts: pa.Array, path: str, end_id: int = END_ID):
    """For each slice of texts: the first text's index, all ids with the end ids, and the bounds of each text's ids."""
    buf, off = tk.utf8(texts)
    codes = _codes(path)
    for a, b in tk.slices(off, _SLICE):
        own = buf[off[a] : off[b]]
        starts, ends, ptr = _parts(own, off[a : b + 1] - off[a])
        # parts of ASCII letters alone are met in one case only
        other = np.concatenate(([0], np.cumsum(~_LETTER[own], dtype=np.int64)))
        plain = other[ends] == other[starts]
        change = np.zeros(len(own) + 1, np.int8)
        change[starts[plain]] += 1
        change[ends[plain]] -= 1
        own = np.where(np.cumsum(change[:-1], dtype=np.int8).view(bool), tk.LOWER[own], own)
        parts = gather(own, starts, ends).dictionary_encode()
        which = codes.of(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        bounds = np.array(codes.bounds, np.int64)
        flat = np.append(np.frombuffer(codes.flat, np.uint32), np.uint32(end_id))
        # behind each text's parts stands the end id, kept as the last of flat
        first = np.insert(bounds[which], ptr[1:], len(flat) - 1)
        size = np.insert(bounds[which + 1] - bounds[which], ptr[1:], 1)
        total = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.arange(total[-1]) + np.repeat(first - total[:-1], size)]
        yield a, ids, total[ptr + np.arange(len(ptr))]


def pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, key (to deal by) and, if asked for, ids of every piece."""
    tk.small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, all_ids, bounds in encode(tk.as_array(batch.column(1)), path, end_id):
                rows: list[tuple] = []
                for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True), a):
                    rows += [(d, k, k * length, own := all_ids[at : min(at + length, hi)], zlib.crc32(own.astype("<u4"))) for k, at in enumerate(range(lo, hi, length))]
                crc = np.array([r[4] for r in rows], np.int64)
                key = tk.mix(np.arange(seen, seen + len(rows), dtype=tk.U64) + tk.mix(crc.astype(tk.U64) + (tk.U64(task) << tk.U64(32)), 7))
                seen += len(rows)
                out = [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(r[3]) for r in rows], pa.int64()), pa.array(crc), pa.array((key >> tk.U64(1)).astype(np.int64)),
                ]
                names = [id_col, "piece", "start", "length", "ids_crc32", "key"]
                if ids:
                    out.append(pa.array([r[3] for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, key long" + (", ids array<int>" if ids else "")
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into sizes (1 to capacity each), packed best-two-fit; packed greedily only, where that takes fewer."""
    return min((_fill(sizes, capacity, swap) for swap in (True, False)), key=len)


def _fill(sizes: list[int], capacity: int, swap: bool) -> list[list[int]]:
    stacks: dict[int, list[int]] = {}
    for k, s in enumerate(sizes):
        stacks.setdefault(s, []).append(k)
    there = sum(1 << s for s in stacks)

    def take(size: int) -> int:
        nonlocal there
        k = stacks[size].pop()
        if not stacks[size]:
            there ^= 1 << size
        return k

    def give(size: int, k: int) -> None:
        nonlocal there
        stacks[size].append(k)
        there |= 1 << size

    def largest(most: int) -> int:
        """The largest waiting size up to most, or 0."""
        return (there & ((2 << most) - 1)).bit_length() - 1 if most > 0 and there & ((2 << most) - 1) else 0

    def tightest(gap: int, more: int) -> tuple[int, int] | None:
        """The two waiting sizes with the largest sum up to gap and above more; the larger one first."""
        best, x = None, largest(gap - 1)
        while x and 2 * x > more:
            y = largest(min(gap - x, x))
            if y == x and len(stacks[x]) < 2:
                y = largest(x - 1)
            if y and x + y > more:
                best, more = (x, y), x + y
                if more == gap:
                    break
            x = largest(x - 1)
        return best

    bins = []
    while there:
        own: list[int] = []
        gap = capacity
        while size := largest(gap):
            own.append(take(size))
            gap -= size
        if swap and gap and len(own) > 1 and there:
            small = sizes[own[-1]]
            if two := tightest(gap + small, small):
                out = own.pop()
                own += [take(x) for x in two]
                give(small, out)
        bins.append(own)
    return bins


def pack(parts: DataFrame, *, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """pieces() with sequence_id and offset instead of the key; parts is best a table, since it is read twice."""
    groups = max(1, -(-parts.count() // group))
    columns = [c for c in parts.columns if c != "key"]
    # a group's rows are put in one order first, so that a repeated task packs alike

    def fill(table: pa.Table) -> pa.Table:
        number = table.column("group")[0].as_py()
        table = table.sort_by([("length", "descending"), ("key", "ascending")])
        size = table.column("length").to_numpy()
        sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        for k, own in enumerate(two_fit(size.tolist(), length)):
            sequence[own] = (number << 32) + k
            offset[own] = np.cumsum(size[own]) - size[own]
        return table.select(columns).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{n}` {t}" for n, t in parts.dtypes if n != "key") + ", sequence_id long, offset long"
    return parts.withColumn("group", F.pmod("key", F.lit(groups))).groupBy("group").applyInArrow(fill, schema)


def place(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, group: int = GROUP, ids: bool = False) -> DataFrame:
    """Where every piece goes: id_col, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(written(pieces(docs, path, id_col=id_col, text_col=text_col, length=length, end_id=end_id, ids=ids), "pieces"), length=length, group=group)


def sequences(docs: DataFrame, path: str, **options) -> DataFrame:
    """The packed sequences: sequence_id, ids, and lengths of the pieces in it."""
    placed = place(docs, path, ids=True, **options)
    own = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    rows = placed.groupBy("sequence_id").agg(own.alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
