"""MinHash near-dedup: universal hash minima in bands, signature verification, exact confirmation, connected components.

A document's set is its distinct shingles of ``words`` words, A-Z lower-cased. Documents are linked when the sets' similarity
(intersection over union) is at least ``share`` hundredths.

1. Documents with equal sets (a 128-bit digest, half of it from other hashes of the words) form a class; its smallest id stands for it. Only classes go on.
2. ``bands`` bands of ``rows`` minima give bucket keys. A pair at the threshold misses all of 45 bands of 5 with a chance of
   5e-6. Each bucket's smallest class is its leader (a partial minimum, no bucket is gathered).
3. Every member is compared with its leaders only: first by signatures, then by the full sets. That makes links, and tells how
   far a member is from its leader.
4. Buckets whose members are then in one component are done. In the others, similarity's triangle inequality leaves few pairs:
   members not linked to the leader, among each other; and, if some member is between half similar and linked, those against
   the linked ones. Large buckets are cut into blocks, a part for each pair of blocks; tasks get parts by their measured size.
   Inside a part, pairs that signatures do not rule out by six standard deviations are confirmed on full sets; only links that
   connect something leave. Which members count as half similar to a leader is ruled out at four deviations.

Defined cases: null texts and texts without words have the empty set and are linked with nothing; with fewer words than a
shingle has, the whole sequence is the one shingle; a row with a null id is linked with nothing, has a null component and is
kept; rows that repeat an id are judged by their own sets, and repeated rows are the same document and share its fate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .components import components

BANDS, ROWS, WORDS, SHARE, SEED = 45, 5, 5, 75, 11
_FACTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
#: Six standard deviations of the estimate from all minima, below the threshold; and four below one half.
_VIABLE, _HALF = 0.57, 0.37
#: A block's rows and shingles at most, about.
_BLOCK, _BLOCK_SHINGLES = 2000, 1_000_000
#: Rows and shingles of the parts that one task gets at once, and decoded shingles that it holds, about.
_GROUP, _GROUP_SHINGLES, _HELD = 4000, 2_000_000, 4_000_000


def _hashers(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return draw.integers(0, 2**63, count, dtype=np.int64).astype(tk.U64) * tk.U64(2) + tk.U64(1), draw.integers(0, 2**63, count, dtype=np.int64).astype(tk.U64)


def shingles(buf: np.ndarray, off: np.ndarray, words: int = WORDS, other: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles, in document order, and their bounds; the other hashes are independent ones."""
    low = tk.LOWER[buf]
    starts, ends, ptr = tk.words(low, off, tk.NOT_SPACE)
    values = tk.word_hashes(low, starts, ends, other)
    at, hashes = tk.rolling(values, ptr, words, words)
    count = np.diff(ptr)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        sums = tk.prefix_sums(values)
        whole = np.array([tk.range_hash(sums, ptr[d : d + 1], ptr[d + 1 : d + 2], int(count[d]))[0] for d in short.tolist()], tk.U64)
        at, hashes = np.concatenate([at, ptr[short]]), np.concatenate([hashes, whole])
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
    doc = np.searchsorted(ptr, at, "right") - 1
    keys = tk.mix(hashes ^ tk.mix(doc.astype(tk.U64), 3))
    order = np.argsort(keys, kind="stable")
    first = np.zeros(len(keys), bool)
    if len(keys):
        ranked = keys[order]
        first[order[np.concatenate(([True], ranked[1:] != ranked[:-1]))]] = True
    return hashes[first], np.searchsorted(doc[first], np.arange(len(off)))


def _minima(hashes: np.ndarray, ptr: np.ndarray, count: int) -> np.ndarray:
    """Low 16 bits of the minima of ``count`` universal hash functions, a row for each document that has shingles."""
    up, plus = _hashers(count)
    out = np.empty((len(ptr) - 1, count), np.uint16)
    full = np.flatnonzero(np.diff(ptr) > 0)
    if len(full):
        for k in range(count):
            out[full, k] = np.minimum.reduceat((hashes * up[k] + plus[k]) >> tk.U64(32), ptr[full])
    return out


def _facts(texts: pa.Array, bands: int, rows: int, words: int) -> pa.Array:
    buf, off = tk.utf8(texts)
    ns, h1, h2, keys = [], [], [], []
    for a, b in tk.slices(off):
        hashes, ptr = shingles(buf[off[a] : off[b]], off[a : b + 1] - off[a], words)
        n = np.diff(ptr)
        total = lambda h, p, salt: np.diff(np.concatenate(([tk.U64(0)], np.cumsum(tk.mix(h, salt), dtype=tk.U64)))[p])
        minima = _minima(hashes, ptr, bands * rows).astype(tk.U64).reshape(-1, bands, rows)
        key = np.broadcast_to(np.arange(bands, dtype=tk.U64), minima.shape[:2])
        for r in range(rows):
            key = tk.mix(key * tk.U64(0x10001) + minima[:, :, r], r + 1)
        ns.append(n)
        h1.append(total(hashes, ptr, 5))
        h2.append(total(*shingles(buf[off[a] : off[b]], off[a : b + 1] - off[a], words, other=True), 6))
        keys.append(key)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    flat = join([k.ravel() for k in keys], tk.U64).view(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), pa.array(flat))
    return pa.StructArray.from_arrays([pa.array(join(ns, np.int64), pa.int64()), pa.array(join(h1, tk.U64).view(np.int64)), pa.array(join(h2, tk.U64).view(np.int64)), lists], ["n", "h1", "h2", "bands"])


def _pack(texts: pa.Array, count: int, words: int) -> pa.Array:
    """Signatures, and the texts compressed; they travel to every bucket that has to look at them."""
    buf, off = tk.utf8(texts)
    pack = zstandard.ZstdCompressor(level=3)
    out = []
    for a, b in tk.slices(off):
        out += [row.tobytes() for row in _minima(*shingles(buf[off[a] : off[b]], off[a : b + 1] - off[a], words), count)]
    packed = [pack.compress(buf[off[k] : off[k + 1]].tobytes()) for k in range(len(texts))]
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.array(packed, pa.binary())], ["sig", "packed"])


def _unpack(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    raw = [unpack.decompress(x) for x in packed]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)


def _confirm(sig_a: pa.Array, packed_a: pa.Array, sig_b: pa.Array, packed_b: pa.Array, share: int, words: int) -> pa.Array:
    """0: linked, 1: at least half similar, 2: less. Full sets are compared unless signatures rule out one half."""
    x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint16).reshape(len(s), -1) for s in (sig_a, sig_b))
    out = np.full(len(x), 2, np.int32)
    viable = np.flatnonzero((x == y).mean(axis=1) >= _HALF)
    held: tuple[bytes | None, np.ndarray] = (None, np.empty(0, tk.U64))
    for start in range(0, len(viable), 64):
        own = pa.array(viable[start : start + 64])
        buf, off = _unpack(packed_a.take(own).to_pylist())
        hashes, ptr = shingles(buf, off, words)
        for k, other in enumerate(packed_b.take(own).to_pylist()):
            if other != held[0]:
                held = other, np.sort(shingles(*_unpack([other]), words)[0])
            mine = hashes[ptr[k] : ptr[k + 1]]
            common = int((held[1][np.minimum(np.searchsorted(held[1], mine), len(held[1]) - 1)] == mine).sum()) if len(held[1]) else 0
            union = len(mine) + len(held[1]) - common
            out[viable[start + k]] = 0 if union and 100 * common >= share * union else 1 if 2 * common >= union else 2
    return pa.array(out)


def _residual(table: pa.Table, bands: int, share: int, words: int) -> pa.Table:
    """Links that one group's buckets still give. A pair is looked at in the first band that has it, if it lies in different
    components, the triangle rule leaves it and signatures do not rule it out; then full sets are compared. Of the links
    found, only those leave that connect what the group had not connected yet."""
    part, band, cid, comp, status, side = (table.column(c).to_numpy() for c in ("part", "band", "cid", "comp", "status", "side"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(part), -1)
    packed = table.column("packed")
    sets: dict[int, np.ndarray] = {}
    held = 0

    def set_of(row: int) -> np.ndarray:
        nonlocal held
        if row not in sets:
            if held > _HELD:
                sets.clear()
                held = 0
            sets[row] = np.sort(shingles(*_unpack([packed[row].as_py()]), words)[0])
            held += len(sets[row])
        return sets[row]

    order = np.lexsort((cid, part))
    bounds = np.flatnonzero(np.concatenate(([True], part[order][1:] != part[order][:-1], [True])))
    _, label = np.unique(comp, return_inverse=True)
    links: list[tuple[int, int]] = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = order[lo:hi]
        for i in own[status[own] > 0].tolist():
            other = own[(label[own] != label[i]) & ((status[own] > 0) | (status[i] == 1)) & ((side[own] != side[i]) | (side[i] == 2))]
            other = other[(status[other] == 0) | (cid[other] < cid[i])]
            if not len(other):
                continue
            same = sig[other] == sig[i]
            shared = same.reshape(len(other), bands, -1).all(axis=2)
            other = other[(same.mean(axis=1) >= _VIABLE) & (shared.argmax(axis=1) == band[i])]
            mine = set_of(i) if len(other) else None
            for j in other.tolist():
                if label[j] == label[i]:
                    continue
                theirs = set_of(j)
                if 100 * min(len(mine), len(theirs)) < share * max(len(mine), len(theirs)):
                    continue
                common = int((mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs).sum())
                if 100 * common >= share * (len(mine) + len(theirs) - common):
                    links.append((int(cid[i]), int(cid[j])))
                    label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "r": pa.array([x[1] for x in links], pa.int64())})


def cluster(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, share: int = SHARE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    tk.ensure_checkpoint_dir(spark)
    facts = F.arrow_udf(lambda t: _facts(t, bands, rows, words), _FACTS)
    pack = F.arrow_udf(lambda t: _pack(t, bands * rows, words), T.StructType([T.StructField("sig", T.BinaryType()), T.StructField("packed", T.BinaryType())]))
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    narrow = docs.select("id", facts("text").alias("f")).select("id", "f.*").checkpoint()

    usable = narrow.where("n > 0 and id is not null")
    same = ["n", "h1", "h2"]
    classes = usable.groupBy(*same).agg(F.min("id").alias("cid")).checkpoint()
    members = usable.join(classes.withColumn("id", F.col("cid")), ["id", *same]).select("cid", "n", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("key").agg(F.min("cid").alias("leader"), F.max("cid").alias("last")).where("leader != last").select("key", "leader")
    placed = members.join(buckets, "key").distinct().checkpoint()

    needed = placed.select(F.col("cid").alias("id")).distinct()
    path = tk.shared_dir(spark, "minhash")
    docs.join(needed, "id").select("id", pack("text").alias("p")).select("id", "p.*").write.option("compression", "zstd").parquet(path)
    texts = spark.read.parquet(path)

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("packed").alias("packed_a"))
        right = texts.select(F.col("id").alias("r"), F.col("sig").alias("sig_r"), F.col("packed").alias("packed_r"))
        check = F.arrow_udf(lambda s, t, u, v: _confirm(s, t, u, v, share, words), T.IntegerType())
        both = pairs.join(left, "a").join(right, "r")
        return both.select("a", "r", check("sig_a", "packed_a", "sig_r", "packed_r").alias("status")).groupBy("a", "r").agg(F.min("status").alias("status")).checkpoint()

    stars = confirmed(placed.where("cid != leader").select(F.col("cid").alias("a"), F.col("leader").alias("r")).distinct())
    links = stars.where("status = 0").select("a", "r")
    roots = components(links, "a", "r").checkpoint()

    state = placed.join(roots.select(F.col("node").alias("cid"), F.col("root").alias("comp")), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    state = state.join(stars.select(F.col("a").alias("cid"), F.col("r").alias("leader"), "status"), ["cid", "leader"], "left")
    state = state.withColumn("status", F.when(F.col("cid") == F.col("leader"), 0).otherwise(F.col("status")))
    between, loose = F.col("status") == 1, F.col("status") > 0
    open_ = state.groupBy("key").agg(
        F.min("band").alias("band"), F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.max(between.cast("int")).alias("between"),
        F.sum(loose.cast("int")).alias("loose"), F.sum(F.when(loose, F.col("n")).otherwise(0)).alias("loose_n"),
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("size_n"), F.bit_xor(F.xxhash64("cid")).alias("who"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("who_2"),
    ).where("c1 != c2 and (between = 1 or loose > 1)")
    open_ = open_.groupBy("size", "who", "who_2", "between", "loose", "loose_n", "size_n").agg(F.min_by("key", "band").alias("key"))
    rest = state.join(open_, "key").where("status > 0 or between = 1")
    held = lambda whole, part: F.when(F.col("between") == 1, F.col(whole)).otherwise(F.col(part))
    rest = rest.withColumn("blocks", F.greatest(F.ceil(held("size", "loose") / F.lit(_BLOCK)), F.ceil(held("size_n", "loose_n") / F.lit(_BLOCK_SHINGLES))).cast("int"))
    rest = rest.withColumn("block", F.pmod(F.xxhash64("cid", "key"), F.col("blocks")).cast("int"))
    rest = rest.select("key", "band", "cid", "comp", "status", "n", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    rest = rest.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("part"), "band", "cid", "comp", "status", "n", side.alias("side")).checkpoint()
    size = rest.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["rows"] // _GROUP), -(-size["n"] // _GROUP_SHINGLES))
    full = rest.drop("n").join(texts.select(F.col("id").alias("cid"), "sig", "packed"), "cid")
    more = full.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(groups))).groupBy("g").applyInArrow(lambda t: _residual(t, bands, share, words), "a long, r long").checkpoint()
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("r")).union(more), "a", "r")

    out = narrow.select("id", *same).join(classes, same, "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "cid", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the document of smallest id of each component, same columns; rows without an id stay."""
    gone = cluster(docs, id_col=id_col, text_col=text_col, **options).where("not kept").select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
