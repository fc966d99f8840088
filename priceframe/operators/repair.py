"""Repairs of stored rows: conditional rewrites, each adding what it changed to a flag column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t
from priceframe.operators.conform import beside, gpu_steps, group_steps, in_steps, memory_steps, provider_steps, region_steps
from priceframe.operators.quality import keep_existing, of
from priceframe.schema import COLUMNS

col = F.col


def _rewrite(rows: DataFrame, new: dict[str, Column], flag: str) -> DataFrame:
    """rows with new values for all the columns at once, and in flag whether any differs from the old one (see beside).
    Columns of rows that start with two underscores are helpers and go."""
    made = {k: f"__new_{k}" for k in new}
    out = beside(rows, **{made[k]: c.text(v) for k, v in new.items()})
    before = F.coalesce(col(flag), F.lit(False)) if flag in rows.columns else F.lit(False)
    differs = reduce(lambda a, b: a | b, [col(made[k]) != c.text(col(k)) for k in new], before)
    return out.select(*[col(made[x]).alias(x) if x in made else col(x) for x in rows.columns if x != flag and not x.startswith("__")], differs.alias(flag))


def _tail(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with values of the JSON tail, read once, as __key."""
    return beside(rows, **{f"__{k}": c.json_get(col("raw_extra"), k) for k in keys})


def shifted_tail(rows: DataFrame, flag: str = "shifted") -> DataFrame:
    """Rows whose last columns were written two places early: move eight cells and blank the last two."""
    off = F.upper(c.strip(col("available"))).isin(t.CURRENCIES) & F.lower(c.strip(col("available_count"))).isin(t.PRICE_UNITS) & F.lower(c.strip(col("os"))).isin(t.BOOLEANS)
    moved = {
        "upfront_price": col("currency"), "upfront_price_per_gpu": col("price_unit"), "currency": col("available"), "price_unit": col("available_count"), "available": col("os"),
        "available_count": col("tenancy"), "os": col("pre_installed_sw"), "tenancy": col("raw_extra"), "pre_installed_sw": F.lit(""), "raw_extra": F.lit(""),
    }
    return _rewrite(rows, {k: F.when(off, v).otherwise(col(k)) for k, v in moved.items()}, flag)


def normalise(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """Provider, GPU name, memory, region and geographic group by the conforming rules."""
    out = in_steps(rows, provider_steps("provider", "__provider"), gpu_steps("gpu_name", "__gpu"), add=beside)
    out = in_steps(out, memory_steps("gpu_memory_gb", "__gpu", "__memory"), region_steps("region", "__provider", "__region"), add=beside)
    out = in_steps(out, group_steps("__region", "__group"), add=beside)
    new = {"provider": col("__provider"), "gpu_name": col("__gpu"), "gpu_memory_gb": col("__memory"), "region": col("__region"), "geo_group": col("__group")}
    return _rewrite(out, new, flag)


def reserved_markers(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """On-demand rows that are capacity blocks or reservations, by their markers or by a price under the model's floor."""
    rows = _tail(rows, "billing_model", "purchase_option", "capacity_status")
    billing, purchase, status = col("__billing_model"), col("__purchase_option"), col("__capacity_status")
    price, floor = c.parse_float(col("price_per_gpu_hour")), c.lookup(t.RESERVED_FLOORS, c.text(col("gpu_name")))
    kind = (
        F.when((billing == "capacity_block") | (purchase == "capacity_block"), "capacity_block")
        .when((billing == "capacity_reservation") | (purchase == "capacity_reservation"), "capacity_reservation")
        .when(status.isin("UnusedCapacityReservation", "AllocatedCapacityReservation"), "capacity_reservation")
        .when((price > 0) & (price < floor), "capacity_block")
    )
    rows = beside(rows, __kind=F.when(of("aws") & (F.lower(c.text(col("pricing_type"))) == "on_demand"), kind))
    kind = col("__kind")
    fill = lambda own: F.coalesce(c.blank_to_null(own), kind)
    put = c.json_put(col("raw_extra"), {"purchase_option": fill(purchase), "billing_model": fill(billing)})
    hit = kind.isNotNull()
    new = {"pricing_type": F.lit("reserved"), "commitment_period": fill(c.text(col("commitment_period"))), "raw_extra": put}
    return _rewrite(rows, {k: F.when(hit, v).otherwise(col(k)) for k, v in new.items()}, flag)


def upfront(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """Known machine types get their true GPUs; impossible hourly prices become upfront ones; prices per GPU are recomputed."""
    mine = of("azure")
    spec = lambda k: c.lookup({sku: v[k] for sku, v in t.SKU_SPECS.items()}, c.text(col("instance_type")))
    known = mine & spec(0).isNotNull()
    specs = {name: F.when(known, spec(k)).otherwise(c.text(col(name))) for k, name in enumerate(("gpu_name", "gpu_memory_gb", "gpu_count", "gpu_variant"))}
    each = c.parse_float(col("price_per_gpu_hour"))
    odd = mine & (c.text(col("pricing_type")) == "on_demand") & (each > 500)
    own = lambda k: c.text(col(k))
    or_ = lambda k, other: F.coalesce(c.blank_to_null(own(k)), other)
    rows = beside(rows, __mine=mine, __odd=odd, __price=c.parse_float(col("price_per_hour")), __count=c.parse_float(specs["gpu_count"]),
                  __up=F.when(odd, or_("upfront_price", own("price_per_hour"))).otherwise(own("upfront_price")))
    mine, odd, price, count, up = (col(x) for x in ("__mine", "__odd", "__price", "__count", "__up"))
    up_each = F.when(odd, or_("upfront_price_per_gpu", own("price_per_gpu_hour"))).otherwise(own("upfront_price_per_gpu"))
    kind = F.when(odd, F.lit("reserved")).otherwise(own("pricing_type"))
    reserved = mine & (count > 0) & (kind == "reserved") & (c.parse_float(up) > 0)
    hourly = mine & (count > 0) & ~reserved & (price > 0)
    new = {
        **specs,
        "pricing_type": kind,
        "commitment_period": F.when(odd, or_("commitment_period", F.lit("unknown"))).otherwise(own("commitment_period")),
        "upfront_price": up,
        "upfront_price_per_gpu": F.when(reserved, c.format_float(c.parse_float(up) / count)).otherwise(up_each),
        "price_per_hour": F.when(odd, F.lit("0")).otherwise(own("price_per_hour")),
        "price_per_gpu_hour": F.when(hourly, c.format_float(price / count)).when(odd, F.lit("0")).otherwise(own("price_per_gpu_hour")),
    }
    return _rewrite(rows, new, flag)


def daily_as_hourly(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """Hourly prices that were divided by 24 although the source's price was hourly already."""
    rows = _tail(rows, "daily_usd", "source_price_usd", "source_price_unit")
    old = c.parse_float(col("__daily_usd"))
    rows = beside(
        rows, __mine=of("cloreai"), __legacy=old, __price=c.parse_float(col("price_per_hour")), __each=c.parse_float(col("price_per_gpu_hour")), __own=c.parse_float(col("gpu_count")),
        __source=F.when(old > 0, old).otherwise(c.parse_float(col("__source_price_usd"))), __unit=F.when(old > 0, "hour").otherwise(F.lower(col("__source_price_unit"))),
    )
    mine, legacy, price, each, source = (col(x) for x in ("__mine", "__legacy", "__price", "__each", "__source"))
    usable = mine & (source > 0) & col("__unit").isin("hour", "hr", "hourly")
    count = F.when(col("__own") > 0, col("__own")).otherwise(1.0)
    moved = c.json_put(col("raw_extra"), {"source_price_usd": c.format_float(legacy), "source_price_unit": F.lit("hour")}, ["daily_usd"])
    new = {
        "price_per_hour": F.when(usable & (price > 0) & (F.abs(price * 24 - source) <= 1e-4), c.format_float(source)).otherwise(col("price_per_hour")),
        "price_per_gpu_hour": F.when(usable & (each > 0) & (F.abs(each * 24 - source / count) <= 1e-4), c.format_float(source / count)).otherwise(col("price_per_gpu_hour")),
        "raw_extra": F.when(mine & (legacy > 0), moved).otherwise(col("raw_extra")),
    }
    return _rewrite(rows, new, flag)


def tier_marker(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """The tier's old key becomes the metric; the canonical suffix leaves the instance name."""
    rows = _tail(rows, "price_tier", "price_metric")
    mine, tier = of("akash"), col("__price_tier")
    put = c.json_put(col("raw_extra"), {"price_metric": F.coalesce(c.blank_to_null(col("__price_metric")), tier)}, ["price_tier"])
    new = {
        "raw_extra": F.when(mine & (tier != ""), put).otherwise(col("raw_extra")),
        "instance_type": F.when(mine, F.regexp_replace(c.strip(col("instance_type")), "_weightedAverage$", "")).otherwise(col("instance_type")),
    }
    return _rewrite(rows, new, flag)


def node_counts(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """Whole nodes that were stored as one GPU."""
    name = F.regexp_replace(c.strip(col("instance_type")), r"\s+", " ")
    count = F.when(of("coreweave"), c.lookup(t.NODE_COUNTS, name))
    price = c.parse_float(col("price_per_hour"))
    new = {
        "gpu_count": F.coalesce(count, c.text(col("gpu_count"))),
        "gpu_memory_gb": F.when(count.isNotNull(), c.lookup(t.NODE_MEMORY, name)).otherwise(col("gpu_memory_gb")),
        "price_per_gpu_hour": F.when(count.isNotNull() & (price > 0), c.format_float(price / count.cast("double"))).otherwise(col("price_per_gpu_hour")),
    }
    return _rewrite(rows, new, flag)


def effective_count(gpu_name: Column, memory: Column) -> Column:
    """How many whole cards the memory amounts to; 1 where that is unknown."""
    share = F.round(c.number(memory) / c.lookup({k: float(v) for k, v in t.FULL_CARD_MEMORY.items()}, gpu_name), 6)
    return F.when(share > 0, share).otherwise(1.0)


def fractional_count(rows: DataFrame, flag: str = "changed") -> DataFrame:
    """Shares of a card get a fractional count."""
    mine, price = of("vultr"), c.parse_float(col("price_per_hour"))
    count = effective_count(col("gpu_name"), col("gpu_memory_gb"))
    new = {
        "gpu_count": F.when(mine, c.number_text(count)).otherwise(col("gpu_count")),
        "price_per_gpu_hour": F.when(mine & (price > 0), c.format_float(price / count)).otherwise(col("price_per_gpu_hour")),
    }
    return _rewrite(rows, new, flag)


def repair_all(rows: DataFrame) -> DataFrame:
    """All repairs in their order; adds shifted, changed and keep (the quality rule on the repaired row). The session's limit for
    generated methods is set to what HotSpot compiles; longer ones would be interpreted."""
    rows.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    rest = [x for x in rows.columns if x not in COLUMNS]
    out = normalise(shifted_tail(rows))
    for step in (reserved_markers, upfront, daily_as_hourly, tier_marker, node_counts, fractional_count):
        out = step(out)
    return out.withColumn("keep", keep_existing()).select(*COLUMNS, *rest, "shifted", "changed", "keep")


def repair_counts(repaired: DataFrame) -> DataFrame:
    """Shifted, changed and dropped rows by source."""
    total = lambda x: F.sum(x.cast("long"))
    return repaired.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), total(col("shifted")).alias("shifted"), total(col("changed")).alias("changed"), total(~col("keep")).alias("dropped"))
