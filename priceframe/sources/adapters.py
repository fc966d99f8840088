"""Adapters: functions from landed payloads to offer fields, by name; what they give is conformed, priced per GPU and filtered.

Payload tables have source, file and body. Network access is no part of them: payloads are landed files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t
from priceframe.operators import conform, flatten, quality, text
from priceframe.sources import bulk

Fields = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Adapter:
    name: str
    kind: str
    make: Fields
    active: bool = True


ADAPTERS: dict[str, Adapter] = {}


def adapter(name: str, kind: str, active: bool = True) -> Callable[[Fields], Fields]:
    """Register a function payloads -> offer fields (any of the 33 columns, other columns pass through)."""

    def add(make: Fields) -> Fields:
        ADAPTERS[name] = Adapter(name, kind, make, active)
        return make

    return add


def landed(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Landed bodies of a source, a row for each file (pages and API answers; bulk files are read by lines instead)."""
    rows = spark.read.text(folder, wholetext=True)
    return rows.select(F.lit(source).alias("source"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))


def collect(payloads: DataFrame, name: str) -> DataFrame:
    """Offer rows of one adapter's payloads, those worth storing. The price per GPU is made where the adapter gives none."""
    if not ADAPTERS[name].active:
        raise ValueError(f"adapter {name} is not active")
    fields = ADAPTERS[name].make(payloads)
    own = conform.conform_offers(fields)
    for total, each in (("price_per_hour", "price_per_gpu_hour"), ("upfront_price", "upfront_price_per_gpu")):
        if each not in fields.columns:
            own = own.withColumn(each, c.per_gpu_price(F.col(total), F.col("gpu_count")))
    return own.where(quality.save_filter())


ITEMS = "struct<items:array<struct<provider:string,name:string,gpu:string,count:string,memory:string,region:string,type:string,price:string>>>"


@adapter("json_items", "api")
def json_items(payloads: DataFrame) -> DataFrame:
    """An array of offers under ``items``."""
    rows = flatten.flatten_items(payloads.drop("file"), ITEMS, path="items")
    names = {"name": "instance_type", "gpu": "gpu_name", "count": "gpu_count", "memory": "gpu_memory_gb", "type": "pricing_type", "price": "price_per_hour"}
    return rows.withColumnsRenamed(names)


@adapter("jsonld_pages", "page")
def jsonld_pages(payloads: DataFrame) -> DataFrame:
    """Products of pages, priced by the hour; the GPU is named in the product's name."""
    found = text.jsonld_products(payloads.select("source", "body"), "body")
    return found.select("source", F.col("source").alias("provider"), F.col("name").alias("instance_type"), F.col("name").alias("gpu_name"), F.lit("1").alias("gpu_count"), F.col("price").cast("string").alias("price_per_hour"), "currency")


@adapter("page_pairs", "page")
def page_pairs(payloads: DataFrame) -> DataFrame:
    """GPU names and prices that stand near each other on a page."""
    found = text.gpu_price_pairs(payloads.select("source", "body"), "body")
    return found.select("source", F.col("source").alias("provider"), F.col("gpu").alias("instance_type"), F.col("gpu").alias("gpu_name"), F.lit("1").alias("gpu_count"), F.col("price").cast("string").alias("price_per_hour"))


def bulk_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of the bulk price files under path that name an accelerator family, as payloads of bulk_prices."""
    return bulk.read(spark, path, [*t.BULK_KEY, *flatten.BULK_COLUMNS.values()], naming=[f"{f}." for f in t.BULK_FAMILIES], **options)


@adapter("bulk_prices", "bulk")
def bulk_prices(records: DataFrame) -> DataFrame:
    """Offers of bulk price files, given by bulk_files()."""
    return flatten.bulk_fields(flatten.bulk_components(records), "aws")
