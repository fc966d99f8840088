"""Exact duplicates, retention, archives and set operations on offer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.operators.quality import keep_existing
from priceframe.schema import COLUMNS
from priceframe.sources.shared import bucketed


def dedup_exact(rows: DataFrame, columns: list[str] = COLUMNS, buckets: int | None = None) -> DataFrame:
    """One row for each different content; missing counts as blank. Equal rows are alike, so any of them may stay. With buckets
    (0: as many as bucketed() takes) the rows meet in parts of a written table, whose columns take a tenth of the disk that shuffled
    rows do."""
    own = rows.select(*[c.text(F.col(x)).alias(x) for x in columns])
    return (bucketed(own, columns, "distinct", buckets) if buckets is not None else own).distinct()


def dedup_first(rows: DataFrame, seq: str = "row_seq", columns: list[str] = COLUMNS, texts: bool = False) -> DataFrame:
    """One row for each different content of the columns, with the first of its places. texts: the columns hold texts and no null, so
    that buckets by some of them serve."""
    return rows.groupBy(*[F.col(x) if texts else c.text(F.col(x)).alias(x) for x in columns]).agg(F.min(seq).alias(seq))


def dedup_keyed(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, found by a partial minimum over the order and the rest of the row."""
    rest = [x for x in rows.columns if x not in key and x not in order]
    first = rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*[F.col(x) if x in key else F.col(f"_first.{x}") for x in rows.columns])


def expired(cutoff: str) -> Column:
    """Dates before the cutoff, blank ones too; dates compare as text."""
    return c.text(F.col("snapshot_date")) < cutoff


def retention_split(rows: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Retained and expired rows."""
    return rows.where(~expired(cutoff)), rows.where(expired(cutoff))


def prune(rows: DataFrame, cutoff: str, quality: bool = False) -> DataFrame:
    """Distinct retained rows, with quality only those that the rules keep."""
    out = retention_split(dedup_exact(rows), cutoff)[0]
    return out.where(keep_existing()) if quality else out


def content(columns: list[str] = COLUMNS) -> Column:
    """96 bits of SHA-256 over a row's texts and their lengths: equal for equal texts, and for any two different ones of 400 million
    rows with a chance of 1e-12."""
    texts = [c.text(F.col(x)) for x in columns]
    return F.substring(F.unhex(F.sha2(F.concat_ws("\1", *texts, *[F.length(x) for x in texts]), 256)), 1, 12)


def prune_metrics(rows: DataFrame, cutoff: str) -> DataFrame:
    """By source: rows, duplicates removed, expired and kept. Rows are compared by their content's bits: only these are shuffled."""
    once = rows.select(content().alias("content"), c.text(F.col("source")).alias("source"), expired(cutoff).alias("old")).groupBy("content", "source", "old").agg(F.count(F.lit(1)).alias("n"))
    old = F.col("old").cast("long")
    return once.groupBy("source").agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("deduped"), F.sum(old).alias("expired"), F.sum(1 - old).alias("kept"))


def affected_dates(old: DataFrame, new: DataFrame, cutoff: str) -> DataFrame:
    """Dates to rebuild: those of all new rows that have not expired, and those that lose old rows to the quality rules."""
    lost = old.where(~expired(cutoff) & ~keep_existing()).select("snapshot_date")
    return new.where(~expired(cutoff)).select("snapshot_date").unionByName(lost).distinct()


def scan_dates(rows: DataFrame, dates: DataFrame) -> DataFrame:
    return rows.join(dates.select("snapshot_date").distinct(), "snapshot_date", "left_semi")


def replace_dates(published: DataFrame, rebuilt: DataFrame, dates: DataFrame, cutoff: str) -> DataFrame:
    """published without expired rows and without the dates, and the rebuilt rows of those dates."""
    rest = published.where(~expired(cutoff)).join(dates.select("snapshot_date").distinct(), "snapshot_date", "left_anti")
    return rest.select(*published.columns).unionByName(rebuilt.select(*published.columns))


def merge_archives(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of both over the new one's columns (the existing one's if it has none); missing counts as blank."""
    columns = new.columns or existing.columns
    both = existing.unionByName(new, allowMissingColumns=True)
    return dedup_exact(both, columns)


def archive_month(date: Column) -> Column:
    """The archive a row belongs to: its month, or unknown."""
    month = F.substring(c.text(date), 1, 7)
    return F.when(month.rlike(r"^\d{4}-\d{2}$"), month).otherwise("unknown")


def union_sources(tables: dict[str, DataFrame]) -> DataFrame:
    """All sources' rows, tagged with the source in name order."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in sorted(tables.items()) if not name.startswith("_")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def incremental_finalize(published: DataFrame, old: DataFrame, new: DataFrame, cutoff: str, rebuild, seq: str = "row_seq", texts: bool = False) -> DataFrame:
    """The published table after new rows arrived: only affected dates are rebuilt, from old and new rows of all sources (with
    their places), expired and affected dates leave it."""
    dates = [r[0] for r in affected_dates(old, new, cutoff).collect()]  # a date each; filters by them leave rows in their buckets
    rows = old.unionByName(new).where(~expired(cutoff) & keep_existing() & F.col("snapshot_date").isin(dates))
    rest = published.where(~expired(cutoff) & ~F.col("snapshot_date").isin(dates))
    return rest.unionByName(rebuild(dedup_first(rows, seq, texts=texts)).select(*published.columns))


def migrate_header(cells: DataFrame, old_header: list[str], columns: list[str] = COLUMNS, col: str = "cells") -> DataFrame:
    """Rows of text cells under a stale header: full rows go by position, others by the old names; blank rows are dropped."""
    at = {name: k for k, name in enumerate(old_header)}
    own = F.col(col)
    full = F.size(own) == len(columns)
    named = [F.when(full, F.get(own, k)).otherwise(F.get(own, at[n]) if n in at else F.lit("")) for k, n in enumerate(columns)]
    rest = [x for x in cells.columns if x != col]
    return cells.where(F.exists(own, lambda x: F.trim(x) != "")).select(*rest, *[c.text(v).alias(n) for n, v in zip(columns, named, strict=True)])


def running_rank(rows: DataFrame, key: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key."""
    by = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most)
