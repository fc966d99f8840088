"""Personal data: high-recall generators propose overlapping spans; boosted trees with calibrated thresholds select more.

Kinds, in order: email, ip, card, phone. Base spans follow fixed patterns and checks and always stay. Looser generators
propose further spans (spelt-out addresses, IPv6, other separators, numbers without a plus sign). A span's format and context are
features. What the trees have to tell apart are loose spans, so they are trained on loose spans: every accepted base span, as
it is and rewritten in place into looser forms (label 1: spelt-out at and dot, other separators, no plus sign, an IPv6 address for an
IP), and loose proposals outside accepted spans of their kind and without a word nearby that announces personal data, as well as base matches that the base check
rejects, are label 0. From a sample of at most ``sample`` of each kind, chosen by a hash, histogram gradient boosting learns a
score. A third of each kind is held out: on it, the kind's threshold is the lowest score above which the share of true spans is
``precision`` or more. A kind with fewer than 20 true spans held out takes the threshold calibrated over the held-out spans of
all kinds; one that has them but does not reach the precision over 20 spans adds nothing. Loose proposals over their threshold
that overlap no base span are added, best first, without overlaps; of equal scores the one that starts first, then by kind.

Defined cases: null is the empty text and has no spans; offsets are code points, the end exclusive; repeated rows are each
reported; without both kinds of labels nothing is added to the base spans; only the text is looked at. Texts of any length
are searched whole, in time that grows with their length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Looser proposals. The first are anchored at a digit, the others searched where their mark occurs.
_LOOSE_PHONE = re.compile(r"\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,5}\)?){2,4}(?![0-9])")
_LOOSE_CARD = re.compile(r"[0-9]{4}(?:[ ./_-]?[0-9]{3,6}){2,4}(?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,4}")
_HINTS = (("mail", "e-mail", "contact"), ("ip", "host", "server", "addr"), ("card", "visa", "credit", "pay"), ("tel", "phone", "call", "mobile", "fax"), ("token", "key", "id", "hash", "isbn", "="))

_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_PROPOSAL = T.StructType([*_SPAN.fields, T.StructField("label", T.IntegerType()), T.StructField("features", T.ArrayType(T.FloatType()))])
FOUND = T.StructType([T.StructField("base", T.ArrayType(_SPAN)), T.StructField("proposals", T.ArrayType(_PROPOSAL))])
_ARROW = pa.struct([("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))), ("proposals", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("features", pa.list_(pa.float32()))])))])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def matches(text: str) -> list[list[tuple[int, int, bool]]]:
    """By kind: start, end and whether the check accepts it, of every leftmost match of the base patterns."""
    email, ip, card, phone = [], [], [], []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            email.append((start, m.end(), True))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    ip_end = card_end = 0
    for run in _DIGITS.finditer(text):
        start = run.start()
        if start >= ip_end and (m := _IP.match(text, start)):
            ip_end = m.end()
            ip.append((start, ip_end, all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))))
        if start >= card_end and (m := _CARD.match(text, start)):
            card_end = m.end()
            digits = _only_digits(m[0])
            card.append((start, card_end, 16 <= len(digits) <= 19 and luhn(digits)))
    plus = text.find("+")
    while plus >= 0:
        m = _PHONE.match(text, plus)
        if m:
            phone.append((plus, m.end(), 8 <= len(_only_digits(m[0])) <= 15))
        plus = text.find("+", m.end() if m else plus + 1)
    return [email, ip, card, phone]


def _loose(text: str, base: list[list[tuple[int, int, bool]]]) -> list[tuple[int, int, int]]:
    """Proposals that no base pattern makes; they may overlap each other and base spans."""
    known = {(k, a, b) for k, part in enumerate(base) for a, b, _ in part}
    out = []
    for run in _DIGITS.finditer(text):
        start = run.start()
        for kind, pattern in ((3, _LOOSE_PHONE), (2, _LOOSE_CARD)):
            begin = start - (kind == 3 and start > 0 and text[start - 1] == "(")
            if m := pattern.match(text, begin):
                out.append((kind, begin, m.end()))
    if ":" in text:
        out += [(1, m.start(), m.end()) for m in _IPV6.finditer(text)]
    for mark in ("[at]", "(at)", "{at}", "[AT]", "(AT)", "[ at ]", "( at )", "[@]", "(@)"):
        at = text.find(mark)
        while at >= 0:
            low = max(0, at - 66)
            out += [(0, m.start(), m.end()) for m in _SPELT.finditer(text, low, min(len(text), at + 300)) if m.start() < at < m.end()]
            at = text.find(mark, at + 1)
    return [x for x in dict.fromkeys(out) if x not in known]


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of a span and its context, as numbers."""
    own = text[start:end]
    digits = _only_digits(own)
    groups = _DIGITS.findall(own)
    before, after = text[start - 1 : start], text[end : end + 1]
    left = text[max(0, start - 24) : start].lower()
    host = own.rpartition("@")[2].split(".")
    side = lambda c: 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0
    return [
        *(float(kind == k) for k in range(4)),
        len(own), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        sum(c.isalpha() for c in own), sum(own.count(c) for c in " -."), float("(" in own and ")" in own), float("@" in own),
        float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        max((min(int(g[:6]), 999) for g in groups), default=-1) if kind == 1 else -1.0,
        len(host) if kind == 0 else -1.0, len(host[-1]) if kind == 0 else -1.0,
        side(before), side(after), len(set(digits)), float(own[:1] == "0"),
        *(float(any(h in left for h in hints)) for hints in _HINTS),
    ]


def _looser(kind: int, own: str) -> list[str]:
    """An accepted base span in forms that its base pattern does not accept and a proposer finds."""
    digits = _only_digits(own)
    if kind == 0:
        local, _, host = own.rpartition("@")
        return [f"{local} [at] {host}", f"{local}(at){host.replace('.', ' [dot] ')}"]
    if kind == 1:
        parts = [f"{int(x) & 0xFFFF:x}" for x in own.split(".")]
        return [f"fe80:0:0:0:{':'.join(parts)}", f"2001:db8:{':'.join(parts)}:0:1"]
    if kind == 2:
        groups = [digits[k : k + 4] for k in range(0, 12, 4)] + [digits[12:]]
        return [".".join(groups), "/".join(groups)]
    head, rest = digits[:-7], digits[-7:]
    return [f"{head[-4:].rjust(2, '0')} {rest[:3]} {rest[3:]}", f"({head[-3:].rjust(2, '0')}) {rest[:3]}-{rest[3:]}"]


def examples(text: str, found: list[list[tuple[int, int, bool]]], loose: list[tuple[int, int, int]]) -> list[tuple[int, int, list[float]]]:
    """Kind, label and features of what the trees learn from."""
    out = []
    for kind, part in enumerate(found):
        for a, b, ok in part:
            if not ok and b - a >= 7:
                out.append((kind, 0, features(text, kind, a, b)))
            for form in [text[a:b], *_looser(kind, text[a:b])] if ok else []:
                left, right = text[max(0, a - 24) : a], text[b : b + 1]
                out.append((kind, 1, features(left + form + right, kind, len(left), len(left) + len(form))))
    accepted = [([a for a, _, ok in part if ok], [b for _, b, ok in part if ok]) for part in found]
    for kind, a, b in loose:
        near = text[max(0, a - 24) : a].lower()
        last = bisect_right(accepted[kind][0], b - 1) - 1  # accepted spans of a kind do not overlap
        inside = last >= 0 and accepted[kind][1][last] > a
        if not inside and not any(h in near for hints in _HINTS[:4] for h in hints):
            out.append((kind, 0, features(text, kind, a, b)))
    return out


@F.arrow_udf(FOUND)
def propose(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts.to_pylist():
        if not text:
            out.append({"base": [], "proposals": []})
            continue
        found = matches(text)
        loose = _loose(text, found)
        taught = [(k, 0, 0, label, f) for k, label, f in examples(text, found, loose)]
        asked = [(k, a, b, -1, features(text, k, a, b)) for k, a, b in loose]
        out.append({
            "base": [{"kind": k, "start": a, "end": b} for k, part in enumerate(found) for a, b, ok in part if ok],
            "proposals": [{"kind": k, "start": a, "end": b, "label": label, "features": f} for k, a, b, label, f in taught + asked],
        })
    return pa.array(out, _ARROW)


@dataclass
class Trees:
    """Boosted trees of depth 3 in arrays: at each inner node a feature and a cut, at each leaf a value."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    prior: float
    thresholds: tuple[float, ...]

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.prior)
        index = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(rows), int)
            for _ in range(3):
                node = 2 * node + 1 + (rows[index, feature[node]] > cut[node])
            total += leaf[node - 7]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.2, bins: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Gradient boosting for the logistic loss; cuts are chosen from histograms over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    prior = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    total = np.full(len(y), prior)
    feature, cut, leaf = np.zeros((rounds, 7), int), np.full((rounds, 7), np.inf), np.zeros((rounds, 8))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        for inner in range(7):
            own = np.flatnonzero(node == inner)
            best = (1e-6, 0, None)
            if len(own):
                g, h = grad[own].sum(), hess[own].sum()
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(binned[own, f], grad[own], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[own, f], hess[own], len(c) + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            right = np.zeros(len(own), bool)
            if best[2] is not None:
                feature[r, inner], cut[r, inner] = best[1], cuts[best[1]][best[2]]
                right = binned[own, best[1]] > best[2]
            node[own] = 2 * inner + 1 + right
        for k in range(8):
            own = node - 7 == k
            leaf[r, k] = rate * grad[own].sum() / (hess[own].sum() + 1)
        total += leaf[r][node - 7]
    return feature, cut, leaf, prior


def _threshold(score: np.ndarray, y: np.ndarray, precision: float, least: int) -> float:
    """The middle between the lowest score down to which the share of true spans is precision and the next one below, 0.5 at
    least; 2 where fewer than least spans reach it."""
    by = np.argsort(-score, kind="stable")
    good = np.flatnonzero(np.cumsum(y[by]) >= precision * np.arange(1, len(by) + 1))
    if len(good) < least:
        return 2.0
    low, below = float(score[by[good[-1]]]), float(score[by[good[-1] + 1]]) if good[-1] + 1 < len(by) else 0.0
    return max(0.5, (low + below) / 2)


def fit(rows: list[tuple[int, int, list[float]]], precision: float = 0.99) -> Trees | None:
    """rows: kind, label and features of the sample, by kind in hash order; every third is held out for the thresholds."""
    if not rows or len({label for _, label, _ in rows}) < 2:
        return None
    kind, y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    held = np.arange(len(rows)) % 3 == 2
    trees = Trees(*boost(x[~held], y[~held]), (2.0,) * len(KINDS))
    score = trees.score(x)
    pooled = _threshold(score[held], y[held], precision, 1)
    own = [held & (kind == k) for k in range(len(KINDS))]
    trees.thresholds = tuple(_threshold(score[o], y[o], precision, 20) if y[o].sum() >= 20 else pooled for o in own)
    return trees


def find(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, sample: int = 20_000, precision: float = 0.99, into: str = "spans") -> DataFrame:
    """The columns ``keep`` (all but the text by default) and ``into``: array<struct<kind, start, end, base>>, by kind and start.

    Proposals are written once to the checkpoint folder, so the text is scanned once for both training and selection.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    tk.ensure_checkpoint_dir(docs.sparkSession)
    found = tk.fresh("found", [*keep, into])
    narrow = docs.select(*keep, propose(F.col(text_col)).alias(found)).checkpoint()
    flat = narrow.select(F.explode(f"{found}.proposals").alias("p")).where("p.label >= 0").select("p.kind", "p.label", "p.features", F.xxhash64("p.features", "p.kind", "p.start").alias("h"))
    counts = {r["kind"]: r["count"] for r in flat.groupBy("kind").count().collect()}
    share = F.lit(0)  # of each kind, so partitions send about twice its sample in all, not a sample each
    for k, n in counts.items():
        share = F.when(F.col("kind") == k, F.lit(int(min(1.0, 2 * sample / n) * (1 << 30)))).otherwise(share)
    ranked = flat.where(F.pmod("h", F.lit(1 << 30)) <= share).withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy("h", "label")))
    rows = [(r.kind, r.label, list(r.features)) for r in ranked.where(F.col("place") <= sample).orderBy("kind", "place").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, precision))

    @F.arrow_udf(T.ArrayType(T.StructType([*_SPAN.fields, T.StructField("base", T.BooleanType())])))
    def select(column: pa.Array) -> pa.Array:
        trees: Trees | None = shared.value
        out = []
        for row in column.to_pylist():
            spans = [(s["kind"], s["start"], s["end"], True) for s in row["base"]]
            more = [p for p in row["proposals"] if p["label"] < 0]
            if more and trees is not None:
                score = trees.score(np.array([p["features"] for p in more], float))
                taken = [(a, b) for _, a, b, _ in spans]
                for s, p in sorted(zip(score.tolist(), more, strict=True), key=lambda x: (-x[0], x[1]["start"], x[1]["kind"])):
                    if s >= trees.thresholds[p["kind"]] and all(b <= p["start"] or a >= p["end"] for a, b in taken):
                        taken.append((p["start"], p["end"]))
                        spans.append((p["kind"], p["start"], p["end"], False))
            out.append([{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in sorted(spans)])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])))

    return narrow.select(*keep, select(F.col(found)).alias(into))


def _joined(spans):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id", col: str = "spans") -> DataFrame:
    """One row per document: counts of base spans by kind, their digest, and all spans as text."""
    base = F.filter(col, lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col(col)).alias("spans"))


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[{}]", **options) -> DataFrame:
    """docs with every span replaced by its kind's mark, same columns."""
    source, spans = tk.fresh("source", docs.columns), tk.fresh("spans", docs.columns)
    found = find(docs.withColumn(source, F.col(text_col)), text_col=source, keep=docs.columns, into=spans, **options)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    first = F.filter(ordered, lambda s, i: (i == 0) | (s["start"] >= F.array_max(F.transform(F.slice(ordered, 1, F.greatest(i, F.lit(1))), lambda o: o["end"]))))
    names = F.array(*(F.lit(mark.format(k)) for k in KINDS))
    text = F.col(text_col)
    starts, ends = F.concat(F.array(F.lit(0)), F.transform(first, lambda s: s["end"])), F.concat(F.transform(first, lambda s: s["start"]), F.array(F.length(text)))
    marks = F.concat(F.transform(first, lambda s: F.element_at(names, s["kind"] + 1)), F.array(F.lit("")))
    pieces = F.zip_with(F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a)), marks, lambda t, m: F.concat(t, m))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)).select(*docs.columns)
