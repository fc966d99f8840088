"""Mixing sources to target weights, DataFrame functions only: budgets down a domain-language-source tree, seeded epochs.

Whole-token budgets go from the root to domains, to the languages of each, to the sources of those, in proportion to integer
weights. A node can take at most ``epochs`` times the tokens below it; what a child cannot take is shared by its siblings, and
only what all of them cannot take is left to the ancestors' other children. Both follow from filling each level to the
capacities of whole subtrees: children sorted by capacity per weight, the full ones are a prefix of that order.

A leaf that gets b tokens of the t it has takes every document b div t times and, in the next epoch, the longest prefix of
documents that fits into the remainder, in the order of a digest of seed, epoch, id and text. The prefix is found without
sorting the leaf: documents fall into about sqrt(n) ranges of the digest, sums per range (partial aggregates) tell the range
in which the budget ends, and only that range is sorted.

Tokens are runs of characters other than space and U+0009 to U+000D.

Defined cases: null texts count no tokens; null domain, language or source is the child '' of its parent; children without a
weight get ``default``; leaves without tokens give nothing; budgets round down to whole tokens; equal rows are alike, as many of
them as fit fill the prefix; the digest breaks all other ties. Other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk

LEVELS = ("domain", "lang", "source")
#: Leaves that may be broadcast; more are joined.
MAX_BROADCAST_LEAVES = 20_000


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(names: tuple[str, ...], weights: dict[str, dict[str, int]], default: int) -> Column:
    known = weights.get(names[-1], {})
    value = F.col(names[-1])
    out = F.lit(default)
    for name, w in known.items():
        out = F.when(value == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _fill(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """nodes (w, cap) with their whole-token share ``give`` of the parent's budget."""
    group = [F.lit(0)] if not parent else [F.col(c) for c in parent]
    by = Window.partitionBy(*group).orderBy("ratio", *[c for c in LEVELS if c in nodes.columns])
    nodes = nodes.withColumn("ratio", F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double")).otherwise(F.lit(float("inf")))).withColumn("budget", budget)
    before, from_here = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    big = lambda c: c.cast("decimal(38,0)")
    nodes = nodes.withColumns({"used": big(F.coalesce(F.sum("cap").over(before), F.lit(0))), "left_w": big(F.sum("w").over(from_here))})
    nodes = nodes.withColumn("full", (F.col("w") > 0) & (F.col("cap") * F.col("left_w") <= (F.col("budget") - F.col("used")) * F.col("w")))
    whole = Window.partitionBy(*group)
    nodes = nodes.withColumns({"rest": big(F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))), "rest_w": big(F.sum(F.when(~F.col("full"), F.col("w"))).over(whole))})
    share = F.when(F.col("w") <= 0, F.lit(0)).when(F.col("full"), F.col("cap")).otherwise(F.floor(F.col("rest") * F.col("w") / F.col("rest_w")))
    return nodes.withColumn("give", big(share)).drop("ratio", "budget", "used", "left_w", "full", "rest", "rest_w")


def budgets(leaves: DataFrame, percent: int, epochs: int, weights: dict[str, dict[str, int]], default: int) -> DataFrame:
    """leaves (domain, lang, source, have, n) with the whole-token budget ``give`` of each."""
    level, total = leaves.withColumn("cap", (F.col("have") * epochs).cast("decimal(38,0)")), leaves.agg(F.sum("have")).first()[0] or 0
    given: DataFrame | None = None
    for depth in range(1, len(LEVELS) + 1):
        path = list(LEVELS[:depth])
        nodes = level.groupBy(*path).agg(F.sum("cap").cast("decimal(38,0)").alias("cap")).withColumn("w", _weight(tuple(path), weights, default))
        if given is None:
            nodes = _fill(nodes, [], F.lit(total * percent // 100).cast("decimal(38,0)"))
        else:
            nodes = _fill(nodes.join(given.select(*path[:-1], F.col("give").alias("above")), path[:-1]), path[:-1], F.col("above")).drop("above")
        given = nodes.drop("cap", "w")
    return leaves.join(given, list(LEVELS))


def mix(docs: DataFrame, domain: Column, *, weights: dict[str, dict[str, int]], percent: int = 60, epochs: int = 2, default: int = 10, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A row for each time a document is taken: domain, n_tokens, epoch (from 0), and docs in the struct ``row``."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    own = docs.select(F.struct("*").alias("row"), blank(domain).alias("domain"), blank(F.col(lang_col)).alias("lang"), blank(F.col(source_col)).alias("source"), tokens(F.col(text_col)).alias("n_tokens"), F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    tk.ensure_checkpoint_dir(docs.sparkSession)
    leaves = own.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("have"), F.count(F.lit(1)).alias("n")).where("have > 0").checkpoint()
    plan = budgets(leaves, percent, epochs, weights, default)
    plan = plan.select(*LEVELS, F.ceil(F.sqrt("n")).cast("long").alias("ranges"), F.floor(F.col("give") / F.col("have")).cast("int").alias("rounds"), F.expr("cast(give % have as long)").alias("rest")).checkpoint()
    small = plan.limit(MAX_BROADCAST_LEAVES + 1).count() <= MAX_BROADCAST_LEAVES
    hint = F.broadcast if small else lambda x: x
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("rounds").cast("string"), F.coalesce("id", F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    placed = own.join(hint(plan), list(LEVELS)).withColumn("order", order)
    placed = placed.withColumn("range", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(2**32)).cast("long"))
    sums = placed.where("rest > 0").groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("in_range"), F.max("rest").alias("rest"))
    until = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("upto", F.sum("in_range").over(until)).where("upto > rest").groupBy(*LEVELS).agg(F.min_by(F.struct("range", (F.col("upto") - F.col("in_range")).alias("before")), "range").alias("end"))
    ends = ends.select(*LEVELS, F.col("end.range").alias("end_range"), F.col("end.before").alias("before")).checkpoint()
    cutting = placed.join(hint(ends), list(LEVELS)).where("range = end_range")
    # rows with one digest are alike: how many of them fit is told by number, and they are numbered at the prefix's end alone
    alike = cutting.groupBy(*LEVELS, "order").agg(F.count(F.lit(1)).alias("copies"), F.first("n_tokens").alias("n_tokens"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*LEVELS).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    begun = alike.withColumn("taken", F.col("before") + F.coalesce(F.sum(F.col("n_tokens") * F.col("copies")).over(running), F.lit(0))).where("taken <= rest")
    fit = F.when(F.col("n_tokens") > 0, F.least("copies", F.floor((F.col("rest") - F.col("taken")) / F.col("n_tokens")))).otherwise(F.col("copies")).cast("long")
    last = begun.withColumn("fit", fit).where("fit > 0").groupBy(*LEVELS).agg(F.max_by(F.struct("order", "fit", "copies"), "order").alias("last"))
    last = last.select(*LEVELS, F.col("last.order").alias("last_order"), "last.fit", (F.col("last.fit") < F.col("last.copies")).alias("split")).checkpoint()
    out = placed.join(hint(ends), list(LEVELS), "left").join(hint(last), list(LEVELS), "left")
    at_end = F.coalesce((F.col("range") == F.col("end_range")) & (F.col("order") == F.col("last_order")) & F.col("split"), F.lit(False))
    number: Column = F.lit(0)
    if not last.where("split").isEmpty():
        numbered = out.where(at_end).withColumn("number", F.row_number().over(Window.partitionBy(*LEVELS).orderBy("order")))
        out, number = out.where(~at_end).withColumn("number", F.lit(0)).unionByName(numbered), F.col("number")
    inside = F.when(at_end, number <= F.col("fit")).otherwise(F.col("order") <= F.col("last_order"))
    extra = (F.col("rest") > 0) & (F.col("end_range").isNull() | (F.col("range") < F.col("end_range")) | ((F.col("range") == F.col("end_range")) & inside))
    times = F.col("rounds") + F.coalesce(extra, F.lit(False)).cast("int")
    return out.where(times > 0).select("row", "domain", "n_tokens", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))


#: The parameters of the registered query and of the pipeline.
PRODUCTION = {
    "weights": {"domain": {"web": 50, "reference": 30, "forum": 15}, "lang": {"en": 40, "de": 20, "fr": 20, "es": 20}, "source": {"src0": 5}},
    "percent": 60,
    "epochs": 2,
    "default": 10,
    "seed": 17,
}


def domain_of(source: Column) -> Column:
    """The domain of a source: by its number modulo 3, or other."""
    number = F.regexp_extract(source, "^src([0-9]{1,6})$", 1)
    return F.when(number.isNull() | (number == ""), "other").otherwise(F.element_at(F.array(F.lit("web"), F.lit("reference"), F.lit("forum")), F.when(number != "", number).cast("int") % 3 + 1))


def oracle_sql(table: str = "documents") -> str:
    """The same for PRODUCTION in DuckDB, with plain windows over whole leaves."""

    def weight(level: str) -> str:
        known = PRODUCTION["weights"][level]
        return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in known.items()) + f" ELSE {PRODUCTION['default']} END::HUGEINT"

    steps = []
    for depth in range(1, len(LEVELS) + 1):
        path, parent = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1])
        budget = f"(SELECT (sum(have) * {PRODUCTION['percent']} // 100)::HUGEINT FROM leaves)" if depth == 1 else "any_value(p.give)"
        source = "leaves l" if depth == 1 else f"leaves l JOIN give{depth - 1} p USING ({parent})"
        part = f"PARTITION BY {parent}" if parent else ""
        order = f"{part} ORDER BY cap::DOUBLE / w::DOUBLE, {path}"
        steps.append(f"""
node{depth} AS (SELECT {path}, {weight(LEVELS[depth - 1])} AS w, (sum(have) * {PRODUCTION['epochs']})::HUGEINT AS cap, {budget} AS budget FROM {source} GROUP BY {path}),
rank{depth} AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used, sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM node{depth}),
full{depth} AS (SELECT *, cap * left_w <= (budget - used) * w AS is_full FROM rank{depth}),
give{depth} AS (SELECT {path}, CASE WHEN is_full THEN cap ELSE ((budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0)) * w) // sum(CASE WHEN NOT is_full THEN w END) OVER ({part}) END AS give FROM full{depth}),""")
    numbered = "regexp_extract(source, '^src([0-9]{1,6})$', 1)"
    return f"""
WITH own AS (SELECT doc_id, text, CASE WHEN source IS NULL OR {numbered} = '' THEN 'other' ELSE ['web', 'reference', 'forum'][{numbered}::INT % 3 + 1] END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, lang AS own_lang, source AS own_source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM {table}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS have FROM own GROUP BY ALL HAVING sum(n_tokens) > 0),
{''.join(steps)}
plan AS (SELECT domain, lang, source, (give // have)::INT AS rounds, give % have AS rest FROM leaves JOIN give3 USING (domain, lang, source)),
placed AS (SELECT *, md5(concat('{PRODUCTION['seed']}:', rounds, ':', coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS o FROM own JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
times AS (SELECT *, rounds + (CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END) AS times FROM summed)
SELECT doc_id, domain, own_lang AS lang, own_source AS source, n_tokens, unnest(range(times))::INT AS epoch FROM times WHERE times > 0
"""


ORACLE_SQL = oracle_sql()
