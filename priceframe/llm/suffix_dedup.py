"""Suffix-array dedup over bytes: run-length Burrows-Wheeler indexes over the places where long repeats can be.

A repeat is a string of ``window`` bytes (400) that also starts somewhere else in the corpus. One index over a whole corpus
cannot be built in bounded tasks, so the corpus is first cut along its content:

1. Of the grams of ``gram`` bytes in each window, the one with the smallest hash (the leftmost of equal ones) is the window's
   anchor. Equal windows have equal anchors, and the windows of an anchor are neighbours, so an anchor with its windows is one
   segment, and every window belongs to exactly one. Segments are found once, by document, before the documents are dealt into
   chunks, and go with them. Anchors that occur once in the corpus are dropped (see anchors).
2. An anchor with ``hot`` (64) or more different segments, such as boilerplate shorter than a window, is hot. Chunks send the 64
   smallest digests of each repeated anchor, so that is known without gathering an anchor's segments.
3. Segments of the other anchors go to buckets by the anchor's hash, each distinct one once from a chunk, so copies cost nothing
   more, and no anchor has more than 64 of them. A bucket lays its segments end to end in slices of about a megabyte and builds
   the run-length Burrows-Wheeler index of each, with the text positions at both ends of every run and their neighbours. Matching
   statistics are streamed from these samples: within a run a match is one shorter than that of the position before it, so only
   sampled positions are measured. Windows whose match is ``window`` or longer,
   and those of segments that come from several places, are repeats.
4. The windows of hot anchors, each distinct one once from a chunk, are counted by two 64-bit hashes, the first of which chooses the
   bucket, so that no bucket depends on an anchor.
5. Chunks get the marked ranges by the segments' digests (64 bits beside the bucket) and the hot windows' hashes, and remove
   their bytes.

Defined cases: null is the empty text; documents shorter than the window lose nothing; matches never cross documents, and
repeats within one document, overlapping too, count; repeated rows are copies of each other. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from . import anchors
from . import textkit as tk
from .substring_dedup import PAIR, _repeated_windows, _windows_table

_PLACE_BITS = 30
#: Bytes of segments in one index.
_INDEX_BYTES = 1 << 20
#: Different segments from which on an anchor's windows are counted one by one.
_HOT = 64
#: Instead of a bucket, where an answer lists a chunk's hot anchors.
_HOT_LIST = -(1 << 31)


class _Segments:
    """Segments of one slice of documents: first window start, end of the last window, the anchor's hash, and a digest."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, window: int, gram: int):
        n, width = len(buf), window - gram + 1
        self.first = self.end = np.empty(0, np.int64)
        self.anchor = self.digest = np.empty(0, tk.U64)
        size = np.diff(off)
        if n < window or size.max(initial=0) < window:
            return
        sums = tk.byte_sums(buf)
        hashes = tk.mix((sums[gram:] - sums[:-gram]) * tk.powers(len(sums))[1][: n - gram + 1])  # range_hash of every gram
        mask = tk.U64((1 << _PLACE_BITS) - 1)
        least = _sliding_min((hashes & ~mask) | np.arange(len(hashes), dtype=tk.U64), width)
        starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
        least = least[starts]
        new = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        self.first = starts[new]
        self.end = starts[np.append(new[1:], len(starts)) - 1] + window
        self.anchor = hashes[(least[new] & mask).astype(np.int64)]
        self.digest = tk.range_hash(sums, self.first, self.end, 9)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of width values, from minima running forwards and backwards through blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, ~tk.U64(0), tk.U64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


#: A segment beside its document: where it begins there, its anchor's hash, its digest.
_SEGMENT = np.dtype([("first", "<u4"), ("anchor", "<u8"), ("digest", "<u8")])
#: Bytes of text whose segments are found at once; the temporaries of that many stay in a core's cache.
_SLICE = 1 << 17


def _segments_of(texts: pa.Array, window: int, gram: int) -> pa.Array:
    """Each document's segments, packed."""
    buf, off = tk.utf8(texts)
    found, sizes = [np.empty(0, _SEGMENT)], np.zeros(len(off), np.int64)
    for a, b in tk.slices(off, _SLICE):
        own = off[a : b + 1] - off[a]
        s = _Segments(buf[off[a] : off[b]], own, window, gram)
        of = np.searchsorted(own, s.first, "right") - 1
        sizes[a + 1 : b + 1] = np.bincount(of, minlength=b - a)
        rows = np.empty(len(s.first), _SEGMENT)
        rows["first"], rows["anchor"], rows["digest"] = s.first - own[of], s.anchor, s.digest
        found.append(rows)
    bounds = (np.cumsum(sizes) * _SEGMENT.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.concatenate(found).tobytes())])


class _Chunk:
    """The segments that a chunk's documents brought along, by their places in the chunk's bytes; see _Segments."""

    def __init__(self, table: pa.Table, name: str, window: int, off: np.ndarray | None = None):
        packed, bounds = tk.utf8(table.column(name))
        rows = np.frombuffer(packed.tobytes(), _SEGMENT)
        self.anchor, self.digest = rows["anchor"].astype(tk.U64), rows["digest"].astype(tk.U64)
        if off is not None:
            times = np.diff(bounds) // _SEGMENT.itemsize
            of = np.repeat(np.arange(len(times)), times)
            self.first = rows["first"].astype(np.int64) + off[of]
            self.end = off[of + 1]
            same = np.flatnonzero(of[1:] == of[:-1])
            self.end[same] = self.first[same + 1] - 1 + window

    def hot_windows(self, buf: np.ndarray, off: np.ndarray, many: np.ndarray, window: int):
        """By slices that have any: bytes, place in the chunk, and where in them the windows of the hot anchors start."""
        hot = np.flatnonzero(anchors._member(self.anchor, many))
        first, last = self.first[hot], self.end[hot] - window + 1
        for a, b in tk.slices(off, _SLICE) if len(hot) else ():
            low, high = np.searchsorted(first, off[a]), np.searchsorted(first, off[b])
            if low < high:
                starts = np.concatenate([np.arange(x, y) for x, y in zip(first[low:high].tolist(), last[low:high].tolist(), strict=True)])
                yield buf[off[a] : off[b]], int(off[a]), starts - off[a]


_ITEM_BITS = 21


def _sorted(first: np.ndarray, second: np.ndarray, items: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """items by first, then second, and where a new pair begins. Up to 2**21 items sort as single words with their keys."""
    if n < 1 << _ITEM_BITS:
        bits = tk.U64(_ITEM_BITS)
        keys = (((first.astype(tk.U64) << bits) | second.astype(tk.U64)) << bits) | items.astype(tk.U64)
        keys.sort()
        items = (keys & tk.U64((1 << _ITEM_BITS) - 1)).astype(np.int64)
        keys >>= bits
    else:
        keys = (first.astype(tk.U64) << tk.U64(32)) | second.astype(tk.U64)
        by = np.argsort(keys, kind="stable")
        items, keys = items[by], keys[by]
    return items, np.concatenate(([True], keys[1:] != keys[:-1]))


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first depth symbols (of 9 bits) at least, by prefix doubling; and the packed first 7 symbols.

    A symbol 0 ends a segment: nothing behind it is compared, and of suffixes equal up to theirs the leftmost comes first, as if
    each 0 were a symbol of its own. So no ties are left within segments shorter than depth. Streamed samples need that: suffixes
    left in any order, though equal for depth symbols, need not lie as their predecessors do, and a match could get lost."""
    n = len(symbols)
    wide = np.concatenate([symbols, np.zeros(7, symbols.dtype)]).astype(tk.U64)
    packed, four, inside = np.zeros(n, tk.U64), np.zeros(n, tk.U64), np.ones(n, bool)
    for j in range(7):
        packed = (packed << tk.U64(9)) | wide[j : j + n]
        if j < 4:
            inside &= wide[j : j + n] > 0
            four = (four << tk.U64(9)) | wide[j : j + n] * inside
    order, new = _sorted(four >> tk.U64(18), four & tk.U64(0x3FFFF), np.arange(n), n)
    new |= ~inside[order]
    rank = np.zeros(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    done = 4
    slots = np.arange(n)
    while done < depth:
        slots = slots[~(new[slots] & np.append(new, True)[slots + 1])]
        if not len(slots):
            break
        own = order[slots]
        after = own + done
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        own, changed = _sorted(rank[own], second, own, n)
        order[slots] = own
        new[slots] = changed
        rank[own] = slots[np.maximum.accumulate(np.where(changed, np.arange(len(slots)), 0))]
        done *= 2
    return order, packed


class RunIndex:
    """The run-length Burrows-Wheeler transform of a text, with the text positions sampled at both ends of every run and at
    the heads of its segments, and for each sample its neighbour in suffix order. The suffix order itself is not kept."""

    def __init__(self, symbols: np.ndarray, heads: np.ndarray, depth: int):
        n = len(symbols)
        order, self.packed = suffix_order(symbols, depth)
        before = np.where(order > 0, symbols[order - 1].astype(np.int32), -1)
        starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        stops = np.append(starts[1:], n) - 1
        self.symbols, self.run_heads, self.run_lengths = symbols, before[starts], stops - starts + 1
        is_head = np.zeros(n, bool)
        is_head[heads] = True
        placed = is_head[order]
        self.above, self.below = (self._sample(order, self._with(placed, ends), side) for ends, side in ((starts, -1), (stops, 1)))

    @staticmethod
    def _with(flags: np.ndarray, more: np.ndarray) -> np.ndarray:
        flags = flags.copy()
        flags[more] = True
        return np.flatnonzero(flags)

    @staticmethod
    def _sample(order: np.ndarray, ranks: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Text positions of the ranks and of their neighbours on one side, -1 where there is none."""
        other = ranks + side
        return order[ranks], np.where((other >= 0) & (other < len(order)), order[np.clip(other, 0, len(order) - 1)], -1)

    def statistics(self, most: int) -> np.ndarray:
        """For each text position the longest match with another suffix, exact where it is below most: samples are measured,
        and streamed on in text order, one less a step, until the next sample."""
        n = len(self.symbols)
        best = np.zeros(n, np.int64)
        for at, other in (self.above, self.below):
            known = other >= 0
            held, sampled = np.zeros(n, np.int64), np.zeros(n, bool)
            held[at[known]] = _match(self.symbols, self.packed, at[known], other[known], most)
            sampled[at] = True
            places = np.flatnonzero(sampled)
            last = np.cumsum(sampled) - 1
            best = np.maximum(best, np.where(last >= 0, held[places][last] - (np.arange(n) - places[last]), 0))
        return best


def _match(symbols: np.ndarray, packed: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of suffix pairs, compared 7 symbols at a time."""
    n = len(symbols)
    length = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + length[live], b[live] + length[live]
        ok = (np.maximum(x, y) <= n - 7) & (length[live] < most)
        ok[ok] = packed[x[ok]] == packed[y[ok]]
        live = live[ok]
        length[live] += 7
    more = np.ones(len(a), bool)
    for _ in range(7):
        x, y = a + length, b + length
        more &= np.maximum(x, y) < n
        more[more] = symbols[x[more]] == symbols[y[more]]
        length += more
    return length


def _pack(chunk: int, found: dict[int, list], buckets: int) -> pa.Table:
    """A message for each bucket: anchors, digests, whether the chunk has the segment twice, lengths, and the bytes."""
    rows = []
    for bucket, segments in sorted(found.items()):
        head = np.array([(s[0], s[1], s[2], len(s[3])) for s in segments], "<u8")
        raw = head.tobytes() + b"".join(s[3] for s in segments)
        rows.append((bucket, len(segments).to_bytes(4, "little") + len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)))
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=anchors._MESSAGE)


def _unpack(payload: bytes):
    n, size = int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little")
    raw = pa.decompress(payload[8:], size, "zstd", asbytes=True)
    head = np.frombuffer(raw, "<u8", 4 * n).reshape(n, 4)
    at = 32 * n
    for anchor, digest, twice, length in head.tolist():
        yield anchor, digest, twice, raw[at : at + length]
        at += length


def _index(table: pa.Table, window: int) -> pa.Table:
    """For one bucket: each chunk's segments that hold repeats, by digest, with the ranges of repeated window starts."""
    if table.column("bucket")[0].as_py() < 0:
        return _repeated_windows(table)
    distinct: dict[tuple[int, bytes], list] = {}
    for chunk, payload in zip(table.column("chunk").to_pylist(), table.column("payload").to_pylist(), strict=True):
        for anchor, digest, twice, raw in _unpack(payload):
            entry = distinct.setdefault((anchor, raw), [digest, 0, []])
            entry[1] += 1 + twice
            entry[2].append(chunk)
    answers: dict[int, list[tuple[int, int, int]]] = {}
    keys = sorted(distinct, key=lambda k: k[0])
    each = Counter(k[0] for k in keys)
    # Equal windows have their anchor at the same place in them, so no window repeats within one segment, and an anchor's only
    # segment is repeated as a whole or not at all.
    for k in [k for k in keys if each[k[0]] == 1]:
        digest, times, chunks = distinct[k]
        if times > 1:
            for chunk in dict.fromkeys(chunks):
                answers.setdefault(chunk, []).append((digest, 0, len(k[1]) - window + 1))
    keys = [k for k in keys if each[k[0]] > 1]
    start = 0
    while start < len(keys):
        stop, size = start, 0
        while stop < len(keys) and (size < _INDEX_BYTES or keys[stop][0] == keys[stop - 1][0]):
            size += len(keys[stop][1])
            stop += 1
        own = keys[start:stop]
        lengths = np.array([len(k[1]) for k in own])
        heads = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        symbols = np.frombuffer(b"\0".join(k[1] for k in own) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
        symbols[heads + lengths] = 0
        long = RunIndex(symbols, heads, int(lengths.max()) + 1).statistics(int(lengths.max()) + 1)
        for k, head, length in zip(own, heads.tolist(), lengths.tolist(), strict=True):
            digest, times, chunks = distinct[k]
            starts = length - window + 1
            marked = np.ones(starts, bool) if times > 1 else long[head : head + starts] >= window
            for a, b in zip(*(x.tolist() for x in tk.runs(marked)), strict=True):
                for chunk in dict.fromkeys(chunks):
                    answers.setdefault(chunk, []).append((digest, a, b))
        start = stop
    out = sorted(answers)
    bucket = table.column("bucket")[0].as_py()
    return pa.table([pa.array(out, pa.int32()), pa.array([bucket] * len(out), pa.int32()), pa.array([np.array(answers[c], "<u8").tobytes() for c in out], pa.binary())], schema=anchors._ANSWER)


def _numbers(answers: pa.Table) -> np.ndarray:
    return np.concatenate([np.empty(0, "<u8"), *(np.frombuffer(p, "<u8") for p in answers.column("payload").to_pylist())])


def _hot_list(answers: pa.Table) -> np.ndarray:
    return np.sort(_numbers(answers.filter(pa.compute.equal(answers.column("bucket"), _HOT_LIST))))


def _smallest(pairs: np.ndarray, most: int) -> np.ndarray:
    """Of distinct (anchor, digest), the ``most`` smallest digests of each anchor."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    if not len(pairs):
        return pairs
    pairs = pairs[np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] != pairs[:-1, 0])))
    size = np.diff(np.append(first, len(pairs)))
    return pairs[np.arange(len(pairs)) - np.repeat(first, size) < most]


def _pairs_table(chunk: int, pairs: np.ndarray, buckets: int, schema: pa.Schema) -> pa.Table:
    """A message for each bucket, by the anchor."""
    at = pairs[:, 0] % tk.U64(buckets)
    order = np.argsort(at, kind="stable")
    own, first = np.unique(at[order], return_index=True)
    cut = zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True) if len(order) else []
    payloads = [pairs[order[a:b]].astype("<u8").tobytes() for a, b in cut]
    return pa.table([pa.array(own.tolist(), pa.int32()), pa.array([chunk] * len(own), pa.int32()), pa.array(payloads, pa.binary())], schema=schema)


def _mark(docs: DataFrame, id_cols: list[str], text_col: str, window: int, gram: int, hot: int, bucket_bytes: int, chunk_bytes: int, finish, schema: str | StructType) -> DataFrame:
    """finish(table, bytes, bounds, flags of removed bytes) makes the rows of each chunk."""
    dealt = anchors.deal(docs, id_cols, text_col, chunk_bytes, bucket_bytes)
    name, buckets, along = dealt.chunk, dealt.buckets, tk.fresh("segments", dealt.docs.columns)

    def bring(batches):
        """Segments are found once, before the exchange, and go with their documents."""
        for batch in batches:
            own = _segments_of(batch.column(text_col), window, gram)
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, along])

    dealt = replace(dealt, docs=dealt.docs.mapInArrow(bring, StructType([*dealt.docs.schema, StructField(along, BinaryType())])))

    def hashes_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        hashes = _Chunk(table, along, window).anchor
        return hashes, np.ones(len(hashes), bool)

    def sketch(table: pa.Table, answers: pa.Table) -> pa.Table:
        """The smallest digests of each repeated anchor, to the anchor's bucket."""
        chunk = anchors.chunk_of(table, answers, name)
        if not answers.num_rows or not table.num_rows:
            return _pairs_table(chunk, np.empty((0, 2), tk.U64), buckets, anchors._MESSAGE)
        s = _Chunk(table, along, window)
        own = np.column_stack([s.anchor, s.digest])[anchors.repeated(s.anchor, answers, buckets)]
        return _pairs_table(chunk, _smallest(own, hot), buckets, anchors._MESSAGE)

    def find_hot(table: pa.Table) -> pa.Table:
        """To each chunk of a bucket: those of its anchors that have too many different segments."""
        chunks = table.column("chunk").to_pylist()
        parts = [np.frombuffer(p, "<u8").reshape(-1, 2) for p in table.column("payload").to_pylist()]
        anchor, times = np.unique(_smallest(np.concatenate(parts), hot)[:, 0], return_counts=True)
        many = anchor[times >= hot]
        out = [(c, np.unique(own[anchors._member(own[:, 0], many)][:, 0])) for c, own in zip(chunks, parts, strict=True)]
        out = [(c, own.astype("<u8").tobytes()) for c, own in out if len(own)]
        return pa.table([pa.array([c for c, _ in out], pa.int32()), pa.array([_HOT_LIST] * len(out), pa.int32()), pa.array([p for _, p in out], pa.binary())], schema=anchors._ANSWER)

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Segments of the other anchors to the anchors' buckets; windows of the hot ones to the windows' buckets, below zero."""
        chunk = anchors.chunk_of(table, answers, name)
        found: dict[int, dict] = {}
        one, two = [np.empty(0, tk.U64)], [np.empty(0, tk.U64)]
        if answers.num_rows and table.num_rows:
            often = answers.filter(pa.compute.greater_equal(answers.column("bucket"), 0))
            many = _hot_list(answers)
            buf, off = tk.utf8(table.column(text_col))
            s = _Chunk(table, along, window, off)
            for own, _, starts in s.hot_windows(buf, off, many, window):
                one.append(tk.range_hash(tk.byte_sums(own), starts, starts + window, 21))
                two.append(tk.range_hash(tk.byte_sums(own, other=True), starts, starts + window, 23))
            raw = memoryview(np.ascontiguousarray(buf))
            known = np.flatnonzero(~anchors._member(s.anchor, many) & anchors.repeated(s.anchor, often, buckets))
            for anchor, digest, first, end in zip(*(x[known].tolist() for x in (s.anchor, s.digest, s.first, s.end)), strict=True):
                own = found.setdefault(anchor % buckets, {})
                if (anchor, digest) in own:
                    own[anchor, digest][2] = 1
                else:
                    own[anchor, digest] = [anchor, digest, 0, raw[first:end]]
        windows = _windows_table(chunk, np.concatenate(one), np.concatenate(two), buckets)
        below = pa.compute.subtract(pa.scalar(-1, pa.int32()), windows.column("bucket"))
        return pa.concat_tables([_pack(chunk, {b: list(own.values()) for b, own in found.items()}, buckets), windows.set_column(0, anchors._MESSAGE.field("bucket"), below)])

    def apply(table: pa.Table, answers: pa.Table) -> pa.Table:
        buf, off = tk.utf8(table.column(text_col))
        flags = np.zeros(len(buf), bool)
        if answers.num_rows and table.num_rows:
            marked = _numbers(answers.filter(pa.compute.greater_equal(answers.column("bucket"), 0))).reshape(-1, 3)
            marked = marked[np.argsort(marked[:, 0], kind="stable")]
            below = answers.filter(pa.compute.and_(pa.compute.less(answers.column("bucket"), 0), pa.compute.not_equal(answers.column("bucket"), _HOT_LIST)))
            windows = np.sort(np.concatenate([np.empty(0, PAIR), *(np.frombuffer(p, PAIR) for p in below.column("payload").to_pylist())]))
            s = _Chunk(table, along, window, off)
            low, high = np.searchsorted(marked[:, 0], s.digest, "left"), np.searchsorted(marked[:, 0], s.digest, "right")
            change = np.zeros(len(buf) + 1, np.int32)
            which = np.flatnonzero(high > low)
            times = (high - low)[which]
            rows = np.repeat(low[which], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            first = np.repeat(s.first[which], times)
            np.add.at(change, first + marked[rows, 1].astype(np.int64), 1)
            np.add.at(change, first + marked[rows, 2].astype(np.int64) + window - 1, -1)
            # equal windows have equal anchors, so only the hot anchors' windows can be among these
            for own, at, starts in s.hot_windows(buf, off, _hot_list(answers), window) if len(windows) else ():
                hashes = tk.range_hash(tk.byte_sums(own), starts, starts + window, 21)
                maybe = anchors._member(hashes, windows["one"])
                starts, pairs = starts[maybe], np.empty(int(maybe.sum()), PAIR)
                pairs["one"], pairs["two"] = hashes[maybe], tk.range_hash(tk.byte_sums(own, other=True), starts, starts + window, 23)
                starts = starts[np.isin(pairs, windows)] + at
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
            flags = np.cumsum(change[:-1]) > 0
        return finish(table, buf, off, flags)

    repeats = anchors.find_repeats(dealt, hashes_of)
    sketches = dealt.docs.groupBy(name).cogroup(repeats.groupBy("chunk")).applyInArrow(sketch, anchors.MESSAGE)
    listed = sketches.groupBy("bucket").applyInArrow(find_hot, anchors.ANSWER)
    known = repeats.unionByName(listed)
    segments = dealt.docs.groupBy(name).cogroup(known.groupBy("chunk")).applyInArrow(send, anchors.MESSAGE)
    marks = segments.groupBy("bucket").applyInArrow(lambda t: _index(t, window), anchors.ANSWER).unionByName(listed)
    return dealt.docs.groupBy(name).cogroup(marks.groupBy("chunk")).applyInArrow(apply, schema)


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 400, gram: int = 64, hot: int = _HOT, bucket_bytes: int = 8 << 20, chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    kind = dict(docs.dtypes)[id_col]

    def finish(table: pa.Table, buf: np.ndarray, off: np.ndarray, flags: np.ndarray) -> pa.Table:
        removed = np.diff(np.concatenate(([0], np.cumsum(flags)))[off])
        begins = np.concatenate(([False], ~flags[:-1])) if len(flags) else flags
        begins[off[:-1][off[:-1] < len(flags)]] = True
        spans = np.diff(np.concatenate(([0], np.cumsum(flags & begins)))[off])
        shas = []
        for d in range(table.num_rows):
            own = buf[off[d] : off[d + 1]]
            shas.append(hashlib.sha256(own[~flags[off[d] : off[d + 1]]] if removed[d] else own).hexdigest())
        return pa.table({id_col: table.column(id_col), "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())})

    return _mark(docs.select(id_col, text_col), [id_col], text_col, window, gram, hot, bucket_bytes, chunk_bytes, finish, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 400, gram: int = 64, hot: int = _HOT, bucket_bytes: int = 8 << 20, chunk_bytes: int = 8 << 20) -> DataFrame:
    """docs with the repeats' bytes removed from the texts, same columns. A cut within a character drops what is left of it."""
    columns = docs.columns

    def finish(table: pa.Table, buf: np.ndarray, off: np.ndarray, flags: np.ndarray) -> pa.Table:
        old, new = table.column(text_col).to_pylist(), []
        for d in range(table.num_rows):
            own = flags[off[d] : off[d + 1]]
            new.append(buf[off[d] : off[d + 1]][~own].tobytes().decode("utf-8", "ignore") if own.any() else old[d])
        at = table.schema.get_field_index(text_col)
        return table.set_column(at, text_col, pa.array(new, pa.string())).select(columns)

    return _mark(docs, [id_col], text_col, window, gram, hot, bucket_bytes, chunk_bytes, finish, docs.schema)
