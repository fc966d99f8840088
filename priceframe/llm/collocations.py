"""Phrase collocations by SON partitioning: shards mined at lowered support, their union counted exactly.

1. Documents are dealt into shards of about ``chunk_bytes`` (see anchors). A shard counts all its words and reports those that
   reach its local support: the global support times its share of all bytes, rounded up. Shares add up to one, so a word that is
   frequent at all is reported by some shard.
2. The union is taken in packed buckets of hash space, by cells of it. Reports carry their counts, cut off at the support, so a
   cell stays a candidate only if the counts reported, plus what the other shards may hold unreported, reach the support. With 30
   shards and more the local support is one, nothing is unreported, and the union keeps little else than frequent words.
3. The same again for pairs of candidate words, then for longer phrases whose pairs are all candidates: no other is frequent.
4. Shards look up the candidates in their texts and count them exactly: within a shard two independent 64-bit hashes tell them
   apart, across shards their words do. Cells only choose candidates; what shares one with a frequent phrase is dropped here.
5. Scores, cuts and covered phrases are joins over the frequent phrases; the single words that many phrases begin or end with
   are salted. The best of each language are ranked in two steps, so no task gets all phrases of a language.

A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. Defined cases: null and empty texts have
no words; a null language is ``und``; repeated rows count each; a language without frequent phrases has no row; no documents,
no rows; a very long text makes a shard larger, since texts are not cut; other columns are ignored.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from priceframe.sources.shared import written

from . import anchors
from . import textkit as tk
from .packing import gather

SUPPORT, LONGEST, TOP, COVER, SCALE = 30, 4, 2000, 80, 2_000_000
_BREAK = tk.table((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_WORD = ~(_BREAK | tk.table((0x09, 0x09), (0x20, 0x20)))
#: Keys that a single word is dealt over, and parts that a language's phrases are ranked in first.
_SALTS = 16
#: Bits of a cell of a bucket's hash space: cells are about as many as the phrases that a bucket of 32 MB of text has.
_CELL_BITS = 24
_COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int8()), ("n", pa.int64()), ("phrase", pa.string())])


class _Shard:
    """Words of a shard's texts: their texts, each with a space behind it, first and last bytes there, which end a piece, hashes,
    languages."""

    def __init__(self, table: pa.Table, texts: bool = False):
        buf, off = tk.utf8(table.column("text"))
        langs = tk.as_array(table.column("lang")).dictionary_encode()
        self.langs, of = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        self.salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs], tk.U64)
        kinds = {"last": bool, "values": tk.U64, "lang": np.int32, "clean": np.uint8, "starts": np.int64, "ends": np.int64, "others": tk.U64}
        parts: dict[str, list[np.ndarray]] = {k: [np.empty(0, kind)] for k, kind in kinds.items()}
        size = 0
        for a, b in tk.slices(off):
            low = tk.LOWER[buf[off[a] : off[b]]]
            starts, ends, ptr = tk.words(low, off[a : b + 1] - off[a], _WORD)
            piece = np.cumsum(_BREAK[low], dtype=np.int32)[starts]
            last = np.ones(len(starts), bool)
            last[:-1] = piece[1:] != piece[:-1]
            last[ptr[1:-1][ptr[1:-1] > 0] - 1] = True
            own = {"last": last, "values": tk.word_hashes(low, starts, ends), "lang": np.repeat(of[a:b], np.diff(ptr)).astype(np.int32)}
            if texts:
                clean, first, end = tk.clean_words(low, starts, ends)
                own |= {"clean": clean, "starts": first + size, "ends": end + size, "others": tk.word_hashes(low, starts, ends, other=True)}
                size += len(clean)
            for k, v in own.items():
                parts[k].append(v)
        self.last, self.values, self.lang, self.clean, self.starts, self.ends, self.others = (np.concatenate(parts[k]) for k in kinds)
        self.sums, self.other_sums = tk.prefix_sums(self.values), tk.prefix_sums(self.others)

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the phrases of k words that start at some words; they depend on the language."""
        return tk.mix(tk.range_hash(self.sums, at, at + k, k) ^ self.salt[self.lang[at]])

    def all(self, k: int) -> np.ndarray:
        """Where phrases of k words start."""
        at = np.arange(len(self.last))
        for n in range(k - 1):
            at = at[~self.last[at + n]]
        return at

    def shared(self, begin: np.ndarray, size: np.ndarray, same: np.ndarray) -> np.ndarray:
        """How many words each phrase, by its first word and size, has in common with the one before, where the flags allow it."""
        out = np.zeros(len(begin), np.int64)
        for j in range(int(size.max(initial=0))):
            at = np.minimum(begin + j, len(self.values) - 1)
            same = same & (size[1:] > j) & (size[:-1] > j)
            same &= (self.values[at[1:]] == self.values[at[:-1]]) & (self.others[at[1:]] == self.others[at[:-1]])
            out[1:] += same
        return out

    def longer(self, named: np.ndarray, size: int, k: int) -> np.ndarray:
        """Where phrases of k words start whose parts of ``size`` words (1 or 2) all start at named words."""
        flags = np.zeros(len(self.last) + k, bool)
        flags[named] = True
        at = named
        for n in range(1, k - size + 1):
            at = at[flags[at + n]]
            at = at[~self.last[at + n - 1]]
        return at


def _cells(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | cell of each hash."""
    return ((hashes >> tk.U64(32)) % tk.U64(buckets) << tk.U64(32)) | (hashes & tk.U64((1 << _CELL_BITS) - 1))


def _named(hashes: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """Flags of the hashes whose cells the answers name."""
    if not answers.num_rows:
        return np.zeros(len(hashes), bool)
    hot = np.concatenate([(tk.U64(b) << tk.U64(32)) | anchors._unpack(p)[0].astype(tk.U64) for b, p in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True)])
    hot.sort()
    cells = _cells(hashes, buckets)
    order = np.argsort(cells)  # ascending keys walk the table once, in cache
    out = np.empty(len(cells), bool)
    out[order] = anchors._member(cells[order], hot)
    return out


def _local_support(table: pa.Table, total: int, support: int) -> int:
    return max(1, -(-support * len(tk.utf8(table.column("text"))[0]) // max(total, 1)))


def _report(table: pa.Table, answers: pa.Table | None, name: str, total: int, support: int, sizes: range, buckets: int) -> pa.Table:
    """A shard's message to each bucket: cells of its phrases of some sizes, counts above the local support, and that support.
    The answers name the candidates of the size before."""
    if not table.num_rows:
        return anchors._MESSAGE.empty_table()
    chunk, least, shard = table.column(name)[0].as_py(), _local_support(table, total, support), _Shard(table)
    if answers is None:
        keys = _cells(shard.hashes(shard.all(1), 1), buckets)
    else:
        size = sizes.start - 1
        named = shard.all(size)
        named = named[_named(shard.hashes(named, size), answers, buckets)]
        keys = np.concatenate([_cells(shard.hashes(shard.longer(named, size, k), k), buckets) for k in sizes])
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    count = np.minimum(np.diff(np.append(first, len(keys))), support)
    keys, count = keys[first[count >= least]], count[count >= least] - (least - 1)
    own, cut = anchors.cuts(keys >> tk.U64(32))
    tags = (keys & tk.U64(0xFFFFFFFF)).astype(np.uint32)
    messages = {b: _pack(tags[c], count[c], support, least) for b, c in zip(own, cut, strict=True)}
    if least > 1:
        messages |= {b: _pack(tags[:0], count[:0], support, least) for b in range(buckets) if b not in messages}
    return pa.table([pa.array(list(messages), pa.int32()), pa.array([chunk] * len(messages), pa.int32()), pa.array(list(messages.values()), pa.binary())], schema=anchors._MESSAGE)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Numbers by byte plane, compressed."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return pa.Codec("zstd", compression_level=7).compress(raw, asbytes=True)


def _from_planes(packed: bytes, n: int, width: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, n * width, "zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw.reshape(width, n).T
    return out.view("<u8").ravel().astype(np.int64)


def _width(support: int) -> int:
    return -(-support.bit_length() // 8)


def _pack(tags: np.ndarray, count: np.ndarray, support: int, least: int) -> bytes:
    own = anchors._pack(tags)
    return least.to_bytes(4, "little") + len(own).to_bytes(4, "little") + own + _planes(count, _width(support))


def _union(table: pa.Table, support: int) -> pa.Table:
    """The bucket's candidates, for every shard those it may hold: what it reported, or all if it may hold some unreported."""
    width, bucket = support.bit_length(), table.column("bucket")[0].as_py()
    tags, counts, least = [], [], []
    for payload in table.column("payload").to_pylist():
        cut = 8 + int.from_bytes(payload[4:8], "little")
        own = anchors._unpack(payload[8:cut])[0]
        tags.append(own)
        counts.append(_from_planes(payload[cut:], len(own), _width(support)))
        least.append(int.from_bytes(payload[:4], "little"))
    keys = (np.concatenate(tags).astype(tk.U64) << tk.U64(width)) | np.concatenate(counts).astype(tk.U64)
    keys.sort()
    tag = keys >> tk.U64(width)
    first = np.flatnonzero(np.concatenate(([True], tag[1:] != tag[:-1]))) if len(tag) else np.empty(0, np.int64)
    unreported = sum(x - 1 for x in least)
    most = np.add.reduceat((keys & tk.U64((1 << width) - 1)).astype(np.int64), first) + unreported if len(first) else first
    hot = tag[first[most >= support]].astype(np.uint32)
    whole = anchors._pack(hot)
    out = []
    for chunk, own, x in zip(table.column("chunk").to_pylist(), tags, least, strict=True):
        mine = hot if x > 1 else own[anchors._member(own, hot)]
        if len(mine):
            out.append((chunk, whole if x > 1 else anchors._pack(mine)))
    return pa.table([pa.array([c for c, _ in out], pa.int32()), pa.array([bucket] * len(out), pa.int32()), pa.array([p for _, p in out], pa.binary())], schema=anchors._ANSWER)


def _count(table: pa.Table, answers: pa.Table, name: str, longest: int, buckets: int) -> pa.Table:
    """A shard's message to each bucket: its candidates by language, size and words, and how often it has them; and how many
    words it has of each language, as phrases of none."""
    if not table.num_rows:
        return anchors._MESSAGE.empty_table()
    chunk, shard = table.column(name)[0].as_py(), _Shard(table, texts=True)
    words = np.bincount(shard.lang, minlength=len(shard.langs))
    lang, size, n, phrase = [np.flatnonzero(words).astype(np.int32)], [np.zeros(np.count_nonzero(words), np.int8)], [words[words > 0]], [pa.array([""] * np.count_nonzero(words), pa.large_string())]
    own, begin = [np.zeros(np.count_nonzero(words), np.int64)], [np.zeros(np.count_nonzero(words), np.int64)]
    for k in range(1, longest + 1):
        at = shard.all(k)
        h = shard.hashes(at, k)
        named = _named(h, answers, buckets)
        at, h = at[named], h[named]
        other = tk.range_hash(shard.other_sums, at, at + k, k)
        order = np.argsort(h, kind="stable")
        if np.any((h[order][1:] == h[order][:-1]) & (other[order][1:] != other[order][:-1])):
            order = np.lexsort((other, h))
        at, h, other = at[order], h[order], other[order]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (other[1:] != other[:-1])))) if len(h) else np.empty(0, np.int64)
        lang.append(shard.lang[at[first]])
        size.append(np.full(len(first), k, np.int8))
        n.append(np.diff(np.append(first, len(h))))
        phrase.append(gather(shard.clean, shard.starts[at[first]], shard.ends[at[first] + k - 1]))
        own.append(_home(shard.hashes(at[first], 1), shard.values[at[first] + 1] if k > 1 else None, buckets))
        begin.append(at[first])
    to, lang, size, n, begin = (np.concatenate(x) for x in (own, lang, size, n, begin))
    rows = pa.table([pa.array(to), pa.array(shard.langs).take(pa.array(lang)), pa.concat_arrays(phrase)], names=["to", "lang", "phrase"])
    order = pa.compute.sort_indices(rows, [(c, "ascending") for c in ("to", "lang", "phrase")]).to_numpy()
    to, lang, size, n, begin = (x[order] for x in (to, lang, size, n, begin))
    share = shard.shared(begin, size, (to[1:] == to[:-1]) & (lang[1:] == lang[:-1]))
    new = size > share  # all but the languages' numbers of words
    text = np.zeros((2, len(size)), np.int64)
    text[:, new] = shard.starts[(begin + share)[new]], shard.ends[(begin + size - 1)[new]] + 1
    buckets_here, cut = anchors.cuts(to)
    payloads = [_stream([shard.langs[x] for x in lang[c].tolist()], size[c], share[c], n[c], gather(shard.clean, *text[:, c])) for c in cut]
    return pa.table([pa.array(buckets_here, pa.int32()), pa.array([chunk] * len(cut), pa.int32()), pa.array(payloads, pa.binary())], schema=anchors._MESSAGE)


def _home(word: np.ndarray, second: np.ndarray | None, buckets: int) -> np.ndarray:
    """The bucket that adds a phrase's counts up: that of its first word, so that phrases with one beginning are sent together;
    those of a frequent first word are dealt over an eighth of the buckets by their second."""
    spread = tk.U64(0) if second is None else second % tk.U64(max(1, buckets // 8))
    return ((word % tk.U64(buckets) + spread) % tk.U64(buckets)).astype(np.int64)


def _stream(langs: list[str], size: np.ndarray, share: np.ndarray, n: np.ndarray, text: pa.Array) -> bytes:
    """Sorted phrases, compressed: of each how many words it shares with the one before, how many more it has, its count; and
    apart from these the words it has more, each with a space behind it."""
    runs = [(x, len(list(own))) for x, own in groupby(langs)]
    raw = tk.utf8(text)[0].tobytes()
    numbers = [_planes(x, width) for x, width in ((share, 1), (size - share, 1), (n, 8))]
    head = json.dumps([runs, len(raw), [len(x) for x in numbers]]).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(numbers) + pa.Codec("zstd", compression_level=7).compress(raw, asbytes=True)


def _unstream(payload: bytes) -> pa.Table:
    at = 4 + int.from_bytes(payload[:4], "little")
    langs, size_of_text, sizes = json.loads(payload[4:at])
    rows, numbers = sum(times for _, times in langs), []
    for size, width in zip(sizes, (1, 1, 8), strict=True):
        numbers.append(_from_planes(payload[at : at + size], rows, width))
        at += size
    share, more, n = numbers
    buf = np.frombuffer(pa.decompress(payload[at:], size_of_text, "zstd", asbytes=True), np.uint8)
    ends = np.flatnonzero(buf == 0x20)
    starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)[: len(ends)]
    k, first = share + more, np.cumsum(more) - more
    # the j-th word of a phrase is that of the last phrase, itself included, which brought its own j-th word
    which, row = np.full((rows, int(k.max(initial=0))), -1), np.arange(rows)
    for j in range(which.shape[1]):
        last = np.maximum.accumulate(np.where((share <= j) & (j < k), row, 0))
        which[:, j] = np.where(j < k, first[last] + j - share[last], -1)
    which = which[which >= 0]
    # a space behind each word but a phrase's last
    inner = np.ones(len(which), np.int64)
    inner[(np.cumsum(k) - 1)[k > 0]] = 0
    words = gather(buf, starts[which], ends[which] + inner)
    off = np.frombuffer(words.buffers()[1], np.int64)[np.concatenate(([0], np.cumsum(k)))]
    phrase = pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(off.astype(np.int32)), words.buffers()[2]])
    lang = pa.array([x for x, _ in langs], pa.string()).take(pa.array(np.repeat(np.arange(len(langs)), [times for _, times in langs])))
    return pa.table([lang, pa.array(k, pa.int8()), pa.array(n), phrase], schema=_COUNTED)


def _add(table: pa.Table) -> pa.Table:
    """A bucket's counts, summed up over the shards."""
    rows = pa.concat_tables([_unstream(p) for p in table.column("payload").to_pylist()])
    out = rows.group_by(["lang", "phrase", "k"]).aggregate([("n", "sum")])
    return pa.table([out.column("lang"), out.column("phrase"), out.column("k").cast(pa.int32()), out.column("n_sum")], names=["lang", "phrase", "k", "n"])


def counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, longest: int = LONGEST, chunk_bytes: int = 8 << 20, bucket_bytes: int = 32 << 20) -> DataFrame:
    """lang, phrase, k (words), n: all phrases of 1 to longest words that occur support times at least (and some that do not),
    with their exact numbers of occurrences; and each language's number of words, with k = 0."""
    tk.ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    dealt = anchors.deal(rows, ["id"], "text", chunk_bytes)
    # few buckets for few bytes, whatever the partitions: there is a message for each shard and bucket
    name, buckets = dealt.chunk, max(1, -(-total // bucket_bytes))
    shards = dealt.docs.groupBy(name)
    union = lambda reports: reports.groupBy("bucket").applyInArrow(lambda t: _union(t, support), anchors.ANSWER)
    report = lambda sizes: lambda t, a: _report(t, a, name, total, support, sizes, buckets)
    first = report(range(1, 2))
    found = [union(shards.applyInArrow(lambda t: first(t, None), anchors.MESSAGE))]
    for sizes in filter(len, (range(2, min(2, longest) + 1), range(3, longest + 1))):
        found.append(union(shards.cogroup(found[-1].groupBy("chunk")).applyInArrow(report(sizes), anchors.MESSAGE)))
    every = reduce(DataFrame.unionByName, found)
    own = shards.cogroup(every.groupBy("chunk")).applyInArrow(lambda t, a: _count(t, a, name, longest, buckets), anchors.MESSAGE)
    return own.groupBy("bucket").applyInArrow(_add, "lang string, phrase string, k int, n long")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _salt(part: str, of: str) -> Column:
    """A single word's rows are dealt by the other part, a longer part's are not."""
    return F.when(F.instr(part, " ") == 0, F.pmod(F.xxhash64(of), F.lit(_SALTS))).otherwise(0).cast("int")


def score(counted: DataFrame, *, support: int = SUPPORT, longest: int = LONGEST, cover: int = COVER, scale: int = SCALE) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases that no longer one covers; counted is best a table."""
    frequent = counted.where((F.col("n") >= support) & (F.col("k") > 0))
    candidates = frequent.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    inner = F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> array_join(slice(w, i, s), ' '))))")
    longer = candidates.where("k > 2").withColumn("w", F.split("phrase", " ")).select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    bare = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _exact("longer") < cover * _exact("a")))
    # a cut is carried as its two parts, which make the phrase
    cuts = bare.withColumn("w", F.split("phrase", " ")).select("lang", "k", "a", "w", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select("lang", "a", "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("head"), F.expr("array_join(slice(w, cut + 1, k - cut), ' ')").alias("tail"))
    salts = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    known = frequent.where(f"k < {longest}").select("lang", F.col("phrase").alias("part"), F.explode(salts).alias("salt"), "n")
    for part, other, count in (("head", "tail", "l"), ("tail", "head", "r")):
        cuts = cuts.withColumn("salt", _salt(part, other)).join(known.select("lang", F.col("part").alias(part), "salt", F.col("n").alias(count)), ["lang", part, "salt"]).drop("salt")
    exact = cuts.select("lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "a", "cut", "l", "r", F.expr(f"(cast(a as decimal(19,0)) * {scale}) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))").alias("score"))
    kept = exact.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    return kept.join(counted.where("k = 0").select("lang", "n"), "lang").select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")


def top(scored: DataFrame, *, most: int = TOP) -> DataFrame:
    """The first phrases of each language with their rank: those of each of some parts of a language first, then of them."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    first = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= most).drop("place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, *, support: int = SUPPORT, most: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    return top(score(written(counts(docs, support=support, **options), "phrases"), support=support), most=most)
