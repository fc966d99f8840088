"""Filter interaction audit: what each filter removes in every order, from truth-table survival words.

A document that fails the filters of the set m survives a set T of filters if m and T share none. Its survival word has 32
bits, one for each T; positional popcounts of all words tell how many documents survive each T, and every figure of every
order is a difference of two of them. The popcounts are carry-save sums: three words of one weight become a word of that
weight and one of twice the weight, so most additions are a few bit operations on whole arrays. Tasks send 96 counts a part
(all documents, those labelled good, those labelled toxic), which are summed up.

Filters: A under 100 words; B distinct words under 80 % of the words; C A-Z over 10 % of the code points; D any of ``#$%&*|``;
E the text of a row with a smaller id. Texts are compared by SHA-256; the smallest id of a digest comes from partial minima,
and only digests that occur twice are joined back, over salted keys.

Defined cases: null text is empty; null lang is the empty part; rows with a null id never repeat and are never repeated;
repeated rows count each and do not repeat each other; a document is good or toxic if any of its label rows says so; no
documents, no rows; other columns are ignored, so their names cannot clash. A very long text is split into words in one task.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceframe.sources.shared import written

from . import textkit as tk

FILTERS = "ABCDE"
_SETS = 1 << len(FILTERS)
_CLASSES = 3
#: The survival word of a document that fails the filters of the index.
SURVIVAL = np.array([sum(1 << t for t in range(_SETS) if not m & t) for m in range(_SETS)], np.uint32)
#: Keys that a digest with copies is dealt over.
_SALTS = 16
_SPACE = r"[\x20\x09-\x0D]+"


def popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save addition."""
    total = np.zeros(32, np.int64)
    weight, level = 1, words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) >= 3:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            odd = a ^ b
            carries.append((a & b) | (c & odd))
            level = np.concatenate([odd ^ c, level[3 * third :]])
        bits = (level[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        total += weight * bits.sum(axis=0, dtype=np.int64)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return total


def _flag(condition: Column, name: str) -> Column:
    return F.shiftleft(condition.cast("int"), FILTERS.index(name))


def failures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part, fails (bit k: the k-th of FILTERS) of every row."""
    tk.ensure_checkpoint_dir(docs.sparkSession)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = text.withColumn("inner", F.expr(r"trim(BOTH ' \t\n\u000B\f\r' FROM text)"))
    split = text.withColumn("words", F.split("inner", _SPACE))
    n = F.when(F.col("inner") == "", 0).otherwise(F.size("words"))
    facts = split.select("id", "part", "text", n.cast("long").alias("n"), F.size(F.array_distinct("words")).cast("long").alias("kinds"))
    upper = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    alone = _flag(F.col("n") < 100, "A") + _flag((F.col("n") > 0) & (100 * F.col("kinds") < 80 * F.col("n")), "B")
    alone = alone + _flag(100 * upper > 10 * F.length("text").cast("long"), "C") + _flag(F.col("text").rlike("[#$%&*|]"), "D")
    rows = written(facts.select("id", "part", alone.alias("alone"), F.unhex(F.sha2("text", 256)).alias("digest")), "audit")
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first != last")
    firsts = firsts.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    both = rows.withColumn("salt", F.pmod(F.xxhash64("id", "part"), F.lit(_SALTS)).cast("int")).join(firsts, ["digest", "salt"], "left")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return both.select("id", "part", (F.col("alone") + _flag(copy, "E")).alias("fails"))


def _tally(batches):
    """The popcounts of a task's documents: for each part, 32 of all, 32 of good and 32 of toxic ones."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        parts = tk.as_array(batch.column("part")).dictionary_encode()
        words = SURVIVAL[batch.column("fails").to_numpy(zero_copy_only=False)]
        of = parts.indices.to_numpy()
        classes = [np.ones(len(of), bool), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic"))]
        for k, part in enumerate(parts.dictionary.to_pylist()):
            own = of == k
            counts = np.concatenate([popcounts(words[own & c]) for c in classes])
            sums[part] = sums[part] + counts if part in sums else counts
    if sums:
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.string()), "n": pa.array([list(map(int, s)) for s in sums.values()], pa.list_(pa.int64()))})


def survivors(failing: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """part, n: arrays of 96 counts; n[t] documents survive the filters of t, n[32 + t] good and n[64 + t] toxic ones."""
    said = labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("id is not null and (good or toxic)")
    said = said.groupBy("id").agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"), F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    said = said.withColumn("spread", F.lit(0))
    spread = F.when(F.col("id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)) + 1).otherwise(0).cast("int")
    both = failing.withColumn("spread", spread).join(said, ["id", "spread"], "left")
    flags = both.select("part", "fails", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    tasks = flags.mapInArrow(_tally, "part string, n array<long>")
    return tasks.groupBy("part").agg(F.array(*[F.sum(F.col("n")[k]) for k in range(_CLASSES * _SETS)]).alias("n"))


def _steps() -> list[dict]:
    """Every step of every order: the sets of filters before and after it, and its filter's place."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            own = FILTERS.index(name)
            out.append({"filter_order": order, "step": step, "own": own, "before": before, "after": before | 1 << own})
            before |= 1 << own
    return out


def report(survived: DataFrame) -> DataFrame:
    """One row per part, order and step from survivors()."""
    count = lambda t, c=0: F.col("n")[F.lit(c * _SETS) + t]
    size = len(FILTERS)

    def shapley(own: int) -> Column:
        terms = [(factorial(t.bit_count()) * factorial(size - 1 - t.bit_count()), t) for t in range(_SETS) if not t >> own & 1]
        return sum((F.lit(w) * (count(F.lit(t)) - count(F.lit(t | 1 << own))) for w, t in terms), F.lit(0))

    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order: string, step: int, own: int, before: int, after: int>>")
    rows = survived.select("part", "n", F.array(*[shapley(k) for k in range(size)]).alias("shares")).select("*", F.explode(steps).alias("s")).select("part", "n", "shares", "s.*")
    removed = [count(F.col("before"), c) - count(F.col("after"), c) for c in range(_CLASSES)]
    failing = count(F.lit(0)) - count(F.expr("shiftleft(1, own)"))
    others = F.expr(f"{_SETS - 1} ^ shiftleft(1, own)")
    return rows.select(
        "part", "filter_order", "step", count(F.col("after")).alias("kept"), removed[0].alias("removed"), (failing - removed[0]).alias("redundant"),
        (count(others) - count(F.lit(_SETS - 1))).alias("unique_fails"), removed[1].alias("good_lost"), removed[2].alias("toxic_lost"), F.col("shares")[F.col("own")].alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The report of all documents, by part."""
    return report(survivors(failures(docs, id_col=id_col, text_col=text_col, part_col=part_col), labels, id_col=id_col))
