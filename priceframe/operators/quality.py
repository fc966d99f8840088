"""Keep-or-drop rules on offer rows, as conditions that combine with & and |."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t

col = F.col


def of(name: str) -> Column:
    """Rows whose source or provider is the given one."""
    return (c.text(col("source")) == name) | (c.text(col("provider")) == name)


def is_inference() -> Column:
    return F.lower(c.text(col("pricing_type"))) == "inference"


def save_filter() -> Column:
    """Worth storing: per-token offers, and offers that name a device."""
    return is_inference() | (c.strip(col("gpu_name")) != "")


def over_bound(bounds: list[tuple[str, str, float]] = t.MAX_GPU_PRICE) -> Column:
    """Priced above what is plausible for the source's model."""
    price = c.parse_float(col("price_per_gpu_hour"))
    return reduce(lambda a, b: a | b, [of(source) & (c.text(col("gpu_name")) == gpu) & (price > most) for source, gpu, most in bounds], F.lit(False))


def other_tier(canonical: dict[str, str] = t.CANONICAL_METRIC) -> Column:
    """One of several price tiers of an offer, but not the canonical one."""
    metric = F.coalesce(c.blank_to_null(c.json_get(col("raw_extra"), "price_metric")), c.json_get(col("raw_extra"), "price_tier"))
    suffix = F.regexp_extract(c.strip(col("instance_type")), r"_(min|max|avg|med|weightedAverage)$", 1)
    return reduce(lambda a, b: a | b, [of(s) & F.when(metric != "", metric != m).otherwise((suffix != "") & (suffix != m)) for s, m in canonical.items()], F.lit(False))


def price_as_count(source: str = "coreweave") -> Column:
    """An on-demand row whose count is its price."""
    count, price, each = (c.parse_float(col(x)) for x in ("gpu_count", "price_per_hour", "price_per_gpu_hour"))
    fraction = F.abs(count - F.rint(count)) > 1e-6
    return of(source) & (F.lower(c.text(col("pricing_type"))) == "on_demand") & (count > 0) & (price > 0) & fraction & (F.abs(count - price) <= 1e-6) & (F.abs(each - 1.0) <= 1e-6)


def keep_existing() -> Column:
    """What stays in the history."""
    name = c.strip(col("gpu_name"))
    named = (name != "") & ~name.rlike(r"^\d+(\.\d+)?$")
    return ~over_bound() & ~other_tier() & ~price_as_count() & (is_inference() | named)


def has_keyword(texts: list[Column], words: list[str]) -> Column:
    """Any of the words in the texts, case ignored."""
    whole = F.lower(F.concat_ws(" ", *texts))
    return reduce(lambda a, b: a | b, [whole.contains(w.lower()) for w in words], F.lit(False))


def price_between(price: Column, low: float, high: float, low_open: bool = True, high_open: bool = True) -> Column:
    return (price > low if low_open else price >= low) & (price < high if high_open else price <= high)


def split_kind(offers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hourly and per-token offers."""
    return offers.where(~is_inference()), offers.where(is_inference())
