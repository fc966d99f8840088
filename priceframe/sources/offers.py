"""Reading and writing offer tables: CSV source files, the master and inference tables, archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceframe.functions import conform as c
from priceframe.operators import dedup, quality
from priceframe.schema import COLUMNS, RAW_SCHEMA
from priceframe.sources import bulk
from priceframe.sources.shared import bucketed, discard, written
from priceframe.sources.store import Commit

MASTER_ORDER = ["snapshot_date", "provider", "gpu_name", "region", "pricing_type", "instance_type"]
INFERENCE_ORDER = ["snapshot_date", "provider", "instance_type"]


def scan_sources(spark: SparkSession, folder: str, date: str | None = None) -> DataFrame:
    """All sources' CSV files but those whose name starts with an underscore; cells go by their file's header, may hold line ends,
    and are blank where missing. Large files are split. The source of a row is its own column; stem tells the file it came from,
    row_seq the row's place in it."""
    rows = bulk.read(spark, f"{folder}/[!_]*.csv*", COLUMNS, preamble=0)
    rows = rows.select(*[c.text(F.col(x)).alias(x) for x in COLUMNS], F.regexp_extract("file", r"([^/]*?)\.csv(\.gz)?$", 1).alias("stem"), F.format_string("%020d", "at").alias("row_seq"))
    return rows if date is None else rows.where(F.col("snapshot_date") == date)


def append_offers(offers: DataFrame, folder: str) -> None:
    """Store what the save filter keeps, a partition for each date."""
    offers.where(quality.save_filter()).write.mode("append").partitionBy("snapshot_date").parquet(folder)


def sorted_table(offers: DataFrame, order: list[str]) -> DataFrame:
    """The 33 columns in order, by ranges that may cut through a date."""
    return offers.select(*COLUMNS).repartitionByRange(*order).sortWithinPartitions(*order)


def publish(commit: Commit, hourly: DataFrame, inference: DataFrame, dates: set[str]) -> None:
    """Both tables of some dates as part of a commit; each input is evaluated once, for a copy in buckets by date, so a date's rows are
    sorted by one task into one file without a shuffle."""
    for table, rows, order in (("master", hourly, MASTER_ORDER), ("inference", inference, INFERENCE_ORDER)):
        copy = bucketed(rows.select(*COLUMNS), ["snapshot_date"], table)
        commit.replace(table, copy.sortWithinPartitions(*order), "snapshot_date", dates)
        discard(copy)


ARCHIVE = T.StructType([*RAW_SCHEMA.fields, T.StructField("month", T.StringType())])


def merge_archives(commit: Commit, expired: DataFrame) -> dict[str, int]:
    """Add expired rows to the archives of their months, gzip CSV, a partition for each month: only months that get rows are read
    and written again, each with its distinct rows. Gives the rows that those months have now."""
    new = written(expired.select(*COLUMNS).withColumn("month", dedup.archive_month(F.col("snapshot_date"))), "expired", "zstd")
    months = {r[0] for r in new.select("month").distinct().collect()}
    if not months:
        return {}
    old = commit.store.read("archive", ARCHIVE, months, commit.base, kind="csv")
    merged = written(dedup.dedup_exact(old.unionByName(new), ARCHIVE.names, buckets=0), "archive", "zstd")
    commit.replace("archive", merged, "month", months, kind="csv")
    counts = {r["month"]: r["n"] for r in merged.groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}
    discard(new, merged)
    return counts


def write_archives(expired: DataFrame, folder: str, mode: str = "append") -> None:
    """Expired rows as gzip CSV, a folder for each month."""
    rows = expired.select(*COLUMNS).withColumn("month", dedup.archive_month(F.col("snapshot_date")))
    rows.write.mode(mode).partitionBy("month").option("header", True).option("escape", '"').option("compression", "gzip").csv(folder)
