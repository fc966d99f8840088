"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of the whole text become ``dims`` random cosine features, which approximate a Gaussian kernel. Each partition sums
the normal equations of its labelled rows, for each of ``folds`` folds by a hash of the statistics; the sums are added by row
of the matrix in a shuffle, so what reaches the driver is folds * (dims + 1) rows whatever the corpus. Ridge scores that each
fold gets from the other folds' model are pooled in ``bins`` score bins, and a pool-adjacent-violators fit over the bins gives
the calibrated probability. The final model uses all folds.

Defined cases: null and empty texts have statistics of zero and are scored like any other; rows with a null label are not
learnt from; without any labelled row every score is 0.5; repeated rows count as often as they occur; only the text is an
input of the score, other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

#: Byte classes whose shares are statistics: control, line end, space, digit, upper, lower, non-ASCII, and marks by kind.
_CLASSES = np.zeros(256, np.int64)
for _k, _bytes in enumerate(("\n", " \t", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", ".,;:", "!?", "|/\\_", "#$%&*@^~+=", "\"'()[]{}<>-"), 1):
    _CLASSES[np.frombuffer(_bytes.encode(), np.uint8)] = _k
_CLASSES[0x80:] = 11
_N_CLASSES = 12
_SENTENCE_END = tk.table((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
NAMES = (
    [f"share_{k}" for k in range(_N_CLASSES)]
    + ["log_bytes", "log_words", "word_mean", "word_sd", "short_words", "long_words", "distinct_words", "distinct_3_words", "upper_words", "marked_words", "single_mark_words"]
    + ["log_lines", "words_a_line", "repeated_lines", "sentence_end_lines"]
)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of len(NAMES) statistics for each text."""
    buf, off = tk.utf8(column)
    out = [_statistics(buf[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in tk.slices(off)]
    return np.concatenate(out) if out else np.empty((0, len(NAMES)))


def _statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    size = np.diff(off)
    doc = np.repeat(np.arange(n), size)
    by_class = np.bincount(doc * _N_CLASSES + _CLASSES[buf], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    starts, ends, ptr = tk.words(buf, off, tk.NOT_SPACE)
    count = np.diff(ptr)
    word_doc = np.repeat(np.arange(n), count)
    length = (ends - starts).astype(float)
    per = lambda values: np.bincount(word_doc, values, n) / np.maximum(count, 1)
    mean = per(length)
    up, low = (np.concatenate(([0], np.cumsum(_CLASSES[buf] == k))) for k in (4, 5))
    mark = np.concatenate(([0], np.cumsum((_CLASSES[buf] == 7) | (_CLASSES[buf] == 9))))
    n_up, n_low, n_mark = (x[ends] - x[starts] for x in (up, low, mark))
    hashes = tk.range_hash(tk.byte_sums(buf), starts, ends)
    at, three = tk.rolling(hashes, ptr, 3)
    line_start, line_end, line_ptr = tk.words(buf, off, ~tk.table((10, 10)))
    lines = np.diff(line_ptr)
    line_doc = np.repeat(np.arange(n), lines)
    ends_well = np.bincount(line_doc, _SENTENCE_END[buf[line_end - 1]], n) if len(line_end) else np.zeros(n)
    line_hash = tk.range_hash(tk.byte_sums(buf), line_start, line_end)
    columns = [
        np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(per(length**2) - mean**2, 0)),
        per(length <= 3), per(length >= 14), _distinct(word_doc, hashes, n) / np.maximum(count, 1), _distinct(word_doc[at], three, n) / np.maximum(count - 2, 1),
        per((n_up > 0) & (n_low == 0)), per(n_mark >= 2), per((length == 1) & (n_up + n_low == 0)),
        np.log1p(lines), np.log1p(count / np.maximum(lines, 1)), 1 - _distinct(line_doc, line_hash, n) / np.maximum(lines, 1), ends_well / np.maximum(lines, 1),
    ]
    return np.column_stack([by_class / np.maximum(size, 1)[:, None], *columns])


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each document has; 24 bits for the document of a slice, 40 of the hash."""
    keys = (doc.astype(tk.U64) << tk.U64(40)) | (hashes >> tk.U64(24))
    keys.sort()
    own = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return np.bincount((own >> tk.U64(40)).astype(np.int64), minlength=n)[:n]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def text_statistics(texts: pa.Array) -> pa.Array:
    rows = statistics(texts)
    flat = pa.array(rows.ravel(), pa.float64())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(NAMES), pa.int32()), flat)


@dataclass
class Fourier:
    """Standardisation and random cosine features; the same seed gives the same features."""

    mean: np.ndarray
    scale: np.ndarray
    dims: int
    width: float
    seed: int

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(self.seed)
        weights = draw.standard_normal((len(self.mean), self.dims)) / (self.width * np.sqrt(len(self.mean)))
        shift = draw.uniform(0, 2 * np.pi, self.dims)
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.cos(z @ weights + shift) * np.sqrt(2 / self.dims), z * 0.1, np.ones(len(rows))])


@dataclass
class Model:
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(rows), 0.5)
        return np.interp(self.fourier(rows) @ self.weights, self.knots, self.values)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return tk.as_array(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over x in ascending order: block centres and non-decreasing block means."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(rows: DataFrame, stats_col: str = "stats", label_col: str = "label", *, dims: int = 256, width: float = 0.7, ridge: float = 1e-3, folds: int = 3, bins: int = 512, seed: int = 7) -> Model:
    """Fit on rows with statistics and a label of 0 or 1."""
    rows = rows.where(F.col(label_col).isNotNull()).select(F.col(stats_col).alias("stats"), F.col(label_col).cast("double").alias("label"))
    moments = rows.select(*[f(F.element_at("stats", k + 1)).alias(f"{n}{k}") for k in range(len(NAMES)) for n, f in (("m", F.avg), ("s", F.stddev_pop))], F.count(F.lit(1)).alias("n")).first()
    if not moments["n"]:
        return Model(Fourier(np.zeros(len(NAMES)), np.ones(len(NAMES)), dims, width, seed), np.empty(0), np.empty(0), np.empty(0))
    scale = np.array([moments[f"s{k}"] for k in range(len(NAMES))])
    fourier = Fourier(np.array([moments[f"m{k}"] for k in range(len(NAMES))]), np.where(scale > 1e-9, scale, 1.0), dims, width, seed)
    size = dims + len(NAMES) + 1

    def fold_of(stats: np.ndarray) -> np.ndarray:
        return (tk.mix(np.ascontiguousarray(stats).view(tk.U64)[:, ::5].sum(axis=1)) % tk.U64(folds)).astype(int)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        for batch in batches:
            stats, label = _matrix(batch.column(0)), batch.column(1).to_numpy()
            fold = fold_of(stats)
            for k in range(folds):
                x = fourier(stats[fold == k])
                total[k] += x.T @ np.column_stack([x, label[fold == k]])
        yield pa.RecordBatch.from_pydict({"i": np.arange(folds * size), "row": [r.tobytes() for r in total.reshape(-1, size + 1)]}, pa.schema([("i", pa.int64()), ("row", pa.binary())]))

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, float) for b in group.column("row").to_pylist()], axis=0)
        return pa.table({"i": group.column("i").slice(0, 1), "row": pa.array([total.tobytes()], pa.binary())})

    total = np.zeros((folds * size, size + 1))
    for r in rows.mapInArrow(sums, "i long, row binary").groupBy("i").applyInArrow(add, "i long, row binary").collect():
        total[r.i] = np.frombuffer(r.row, float)
    total = total.reshape(folds, size, size + 1)
    penalty = np.full(size, ridge * max(moments["n"], 1) / dims)
    penalty[-1] = 1e-6

    def solve(equations: np.ndarray) -> np.ndarray:
        return np.linalg.solve(equations[:, :-1] + np.diag(penalty), equations[:, -1])

    parts = np.array([solve(total.sum(axis=0) - total[k]) for k in range(folds)])

    @F.arrow_udf("double")
    def out_of_fold(stats: pa.Array) -> pa.Array:
        rows = _matrix(stats)
        return pa.array(np.einsum("ij,ij->i", fourier(rows), parts[fold_of(rows)]))

    binned = rows.select(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), out_of_fold("stats"))).alias("x"), "label")
    binned = binned.groupBy(F.floor((F.col("x") + 0.5) / 2 * (bins - 1)).alias("bin")).agg(F.avg("x").alias("x"), F.avg("label").alias("y"), F.count(F.lit(1)).alias("w")).orderBy("bin").collect()
    knots, values = isotonic(np.array([b.x for b in binned]), np.array([b.y for b in binned]), np.array([float(b.w) for b in binned]))
    return Model(fourier, solve(total.sum(axis=0)), knots, values)


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "stats") -> DataFrame:
    return docs.withColumn(into, text_statistics(F.col(text_col)))


def with_score(docs: DataFrame, model: Model, stats_col: str = "stats", into: str = "score") -> DataFrame:
    """docs with a calibrated score between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        return pa.array(np.clip(shared.value.score(_matrix(stats)), 0, 1))

    return docs.withColumn(into, score(F.col(stats_col)))


def learnable(id_col: str = "doc_id"):
    """Rows that labels may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) != 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> Model:
    """Fit on all of docs whose id has a label and is learnable; a label given twice counts twice."""
    known = labels.where(learnable(id_col)).where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"))
    narrow = with_statistics(docs.where(learnable(id_col)).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))).select("_id", "stats")
    tk.ensure_checkpoint_dir(docs.sparkSession)
    return fit(narrow.join(known, "_id").select("stats", "label").checkpoint(), **options)


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    tk.ensure_checkpoint_dir(docs.sparkSession)
    narrow = with_statistics(docs.select(F.col(id_col), F.col(text_col).alias("_text")), "_text").select(id_col, "stats").checkpoint()
    known = labels.where(learnable(id_col)).where(F.col("quality").isin(0, 1)).select(F.col(id_col), F.col("quality").alias("label"))
    model = fit(narrow.join(known, id_col).select("stats", "label"), **options)
    scored = with_score(narrow, model)
    return scored.select(id_col, F.coalesce(~learnable(id_col), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without those scored under 0.5, same columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    stats, score = tk.fresh("stats", docs.columns), tk.fresh("score", docs.columns)
    return with_score(with_statistics(docs, text_col, stats), model, stats, score).where(F.col(score) >= 0.5).select(*docs.columns)
