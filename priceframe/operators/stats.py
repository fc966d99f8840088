"""Summaries and health gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.operators.dedup import running_rank

col = F.col


def _filled(name: str) -> Column:
    return F.nullif(c.strip(col(name)), F.lit(""))


def _count() -> Column:
    return F.count(F.lit(1))


def source_summary(offers: DataFrame) -> DataFrame:
    """By source: rows, dates and their span, distinct providers, GPU types, regions and pricing types; blanks do not count."""
    distinct = {"providers": "provider", "gpus": "gpu_name", "regions": "region"}
    return offers.groupBy("source").agg(
        _count().alias("n_rows"), F.countDistinct(_filled("snapshot_date")).alias("dates"), F.min(_filled("snapshot_date")).alias("first_date"), F.max(_filled("snapshot_date")).alias("last_date"),
        *[F.countDistinct(_filled(x)).alias(k) for k, x in distinct.items()], F.array_join(F.array_sort(F.collect_set(_filled("pricing_type"))), ",").alias("pricing_types"),
    )


def top_gpus(offers: DataFrame, seq: str = "row_seq", most: int = 20) -> DataFrame:
    """The GPU names with most rows; ties by first appearance."""
    name = F.coalesce(_filled("gpu_name"), F.lit("(unknown)"))
    return offers.groupBy(name.alias("gpu_name")).agg(_count().alias("n_rows"), F.min(seq).alias("first")).orderBy(F.desc("n_rows"), "first").limit(most).select("gpu_name", "n_rows")


def top_gpus_by_source(offers: DataFrame, seq: str = "row_seq", most: int = 20) -> DataFrame:
    name = F.coalesce(_filled("gpu_name"), F.lit("(unknown)"))
    counted = offers.groupBy("source", name.alias("gpu_name")).agg(_count().alias("n_rows"), F.min(seq).alias("first"))
    return running_rank(counted, ["source"], [F.desc("n_rows"), col("first")], most).select("source", "gpu_name", "n_rows", "place")


def rows_by_date(offers: DataFrame) -> DataFrame:
    return offers.groupBy("snapshot_date").agg(_count().alias("n_rows")).orderBy("snapshot_date")


def source_totals(offers: DataFrame) -> DataFrame:
    """Rows by source, and of all under the name (all)."""
    return offers.rollup("source").agg(_count().alias("n_rows"), F.grouping("source").alias("g")).select(F.when(col("g") == 1, "(all)").otherwise(col("source")).alias("source"), "n_rows")


def master_summary(offers: DataFrame) -> DataFrame:
    return offers.agg(_count().alias("n_rows"), F.countDistinct(_filled("provider")).alias("providers"), F.countDistinct(_filled("gpu_name")).alias("gpus"), F.min("snapshot_date").alias("first_date"), F.max("snapshot_date").alias("last_date"))


def _span() -> Column:
    return F.datediff(F.max(col("snapshot_date").cast("date")), F.min(col("snapshot_date").cast("date"))).cast("long")


def baseline_metrics(offers: DataFrame) -> DataFrame:
    """By source: rows, first and last date, days between them."""
    return offers.groupBy("source").agg(_count().alias("n_rows"), F.min("snapshot_date").alias("first_date"), F.max("snapshot_date").alias("last_date"), _span().alias("span_days"))


def health_gate(offers: DataFrame, min_sources: int = 20, min_rows: int = 1_000_000, min_days: int = 75) -> DataFrame:
    """One row: sources, rows, span, and the first floor that is missed (ok if none is); of offers, or of counts of them (n_rows)."""
    rows = F.coalesce(F.sum("n_rows"), F.lit(0)) if "n_rows" in offers.columns else _count()
    own = offers.agg(F.countDistinct("source").alias("sources"), rows.alias("n_rows"), F.coalesce(_span(), F.lit(0)).alias("span_days"))
    status = F.when(col("sources") < min_sources, "too few sources").when(col("n_rows") < min_rows, "too few rows").when(col("span_days") < min_days, "span too short").otherwise("ok")
    return own.withColumn("status", status)


def require_healthy(offers: DataFrame, **floors: int) -> None:
    """Fail the job when a floor is missed."""
    row = health_gate(offers, **floors).first()
    if row["status"] != "ok":
        raise ValueError(f"unhealthy data: {row['status']} ({row['sources']} sources, {row['n_rows']} rows, {row['span_days']} days)")


def rollup_components(prices: DataFrame, key: list[str], seq: str = "row_seq", describe: list[str] | None = None) -> DataFrame:
    """Price components of an offer summed up: by hour (unit Hrs) and upfront (unit Quantity); descriptive columns from the
    first component; negative and non-numeric prices do not count; offers with neither price are dropped."""
    price = c.number(col("price"))
    good = F.when(price >= 0, price)
    out = prices.groupBy(*key).agg(
        F.round(F.coalesce(F.sum(F.when(col("unit") == "Hrs", good)), F.lit(0.0)), 6).alias("price_per_hour"),
        F.round(F.coalesce(F.sum(F.when(col("unit") == "Quantity", good)), F.lit(0.0)), 6).alias("upfront_price"),
        *[F.min_by(x, seq).alias(x) for x in describe or []],
    )
    return out.where("price_per_hour > 0 or upfront_price > 0")
