"""Conforming, repairs, rules and resolution on literal rows, and queries against DuckDB."""

import random

import pytest
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.operators import conform, dedup, quality, repair, resolve, stats
from priceframe.plans import oracles, queries
from priceframe.schema import COLUMNS, OFFER_SCHEMA

SF = "/root/testdata/sf0.001"


def offer(**fields) -> tuple:
    return tuple(fields.get(x, "") for x in COLUMNS)


def table(spark, *rows):
    return spark.createDataFrame([offer(**r) for r in rows], ", ".join(f"{x} string" for x in COLUMNS))


def values(spark, f, cases):
    df = spark.createDataFrame([(k, *(a if isinstance(a, tuple) else (a,))) for k, (a, _) in enumerate(cases)], "k int, " + ", ".join(f"c{j} string" for j in range(len(cases[0][0]) if isinstance(cases[0][0], tuple) else 1)))
    out = [r.v for r in df.select("k", f(*[F.col(x) for x in df.columns[1:]]).alias("v")).orderBy("k").collect()]
    assert out == [b for _, b in cases]


def test_scalars(spark):
    values(spark, c.norm_provider, [("runpod_our_sponsor", "runpod"), ("lambda_labs", "lambda"), ("packet.ai_sponsored", "packet_ai"), ("oracle_cloud", "oracle"), ("google cloud", "gcp"), ("", ""), (None, ""), (" New-Co ", "new_co")])
    values(spark, c.norm_gpu_name, [("RTXA2000", "RTX A2000"), ("RTXPro6000", "RTX PRO 6000"), ("gtx1070ti", "GTX 1070 Ti"), ("p40", "P40"), ("gaudi2", "Gaudi 2"), ("GPU (unspecified)", ""), ("CPU", ""), ("1", ""), ("GB200 NVL72", "B200"), (None, ""), ("Odd One", "Odd One")])
    values(spark, c.norm_gpu_memory, [(("{'Gpus': [{'MemoryInfo': {'SizeInMiB': 81920}}]}", "H100", "8", ""), "80"), (("A100 80GB", "A100", "1", ""), "80"), (("", "A100 40GB", "1", ""), "40"), (("nonsense", "A100", "1", ""), ""), (("0", "H100", "1", ""), "0"), (("", "H100", "", "nvl"), "94"), (("1d", "H100", "1", ""), "80")])
    values(spark, c.norm_region, [(("", "akash", "", "", ""), "global"), (("", "vultr", "", '{"locations":["ewr","nrt"]}', ""), "ewr"), (("", "runpod", "us", "", ""), "US"), (("", "aws", "", "", "getdeploying"), "global"), (("x", "vultr", "", "not json", ""), "x"), ((None, None, None, None, None), "")])
    values(spark, c.geo_group, [(("us-east-1", ""), "US East"), (("", "NL"), "Europe"), (("me-south", ""), "Middle East"), (("eu_west", ""), "Europe"), (("usgov", ""), "US Other"), (("mars", ""), "Unknown"), (("", ""), "Unknown")])
    values(spark, c.norm_pricing_type, [("", "on_demand"), ("Preemptible", "spot"), ("savings plan", "reserved"), ("Hourly Deal", "Hourly Deal")])
    values(spark, c.norm_variant, [("SXM5", "SXM"), ("pci-e", "PCIe"), (" Odd ", "Odd"), (None, "")])
    values(spark, c.per_gpu_price, [(("49.24", "8"), "6.155"), (("800", "8"), "100"), (("3", "0"), "3"), (("", "2"), "")])
    values(spark, lambda x: c.format_float(c.parse_float(x)), [("1.5000", "1.5"), ("0", "0"), ("x", "0"), ("2", "2")])


def test_repairs(spark):
    def one(step, **row):
        return step(table(spark, row)).first()

    r = one(repair.shifted_tail, currency="12.5", price_unit="3.1", available="USD", available_count="hour", os="true", tenancy="4", pre_installed_sw="Linux", raw_extra="Shared")
    assert (r.upfront_price, r.upfront_price_per_gpu, r.currency, r.price_unit, r.available, r.available_count, r.os, r.tenancy, r.raw_extra, r.shifted) == ("12.5", "3.1", "USD", "hour", "true", "4", "Linux", "Shared", "", True)
    r = one(repair.upfront, source="azure", instance_type="Standard_NC40ads_H100_v5", pricing_type="on_demand", gpu_count="8", price_per_hour="6.98")
    assert (r.gpu_count, r.gpu_memory_gb, r.gpu_variant, r.price_per_gpu_hour) == ("1", "94", "NVL", "6.98")
    r = one(repair.upfront, source="azure", pricing_type="on_demand", gpu_count="1", price_per_hour="42066", price_per_gpu_hour="42066")
    assert (r.pricing_type, r.commitment_period, r.upfront_price, r.upfront_price_per_gpu, r.price_per_hour) == ("reserved", "unknown", "42066", "42066", "0")
    r = one(repair.reserved_markers, source="aws", pricing_type="on_demand", gpu_name="H100", price_per_gpu_hour="0.015625", raw_extra='{"a":1}')
    assert (r.pricing_type, r.commitment_period, r.changed) == ("reserved", "capacity_block", True) and "capacity_block" in r.raw_extra
    r = one(repair.daily_as_hourly, source="cloreai", gpu_count="8", price_per_hour="0.21875", price_per_gpu_hour="0.027344", raw_extra='{"daily_usd":5.25}')
    assert (r.price_per_hour, r.price_per_gpu_hour) == ("5.25", "0.65625") and "daily_usd" not in r.raw_extra
    r = one(repair.tier_marker, source="akash", instance_type="a_weightedAverage", raw_extra='{"price_tier":"weightedAverage"}')
    assert r.instance_type == "a" and '"price_metric":"weightedAverage"' in r.raw_extra
    r = one(repair.node_counts, source="coreweave", instance_type="A100", gpu_count="1", price_per_hour="21.6")
    assert (r.gpu_count, r.gpu_memory_gb, r.price_per_gpu_hour) == ("8", "80", "2.7")
    r = one(repair.fractional_count, source="vultr", gpu_name="A100", gpu_memory_gb="40", price_per_hour="1.199")
    assert (r.gpu_count, r.price_per_gpu_hour) == ("0.5", "2.398")


def test_rules(spark):
    rows = table(
        spark,
        {"source": "akash", "gpu_name": "GTX 1070 Ti", "price_per_gpu_hour": "55.83"},
        {"source": "akash", "gpu_name": "H100", "instance_type": "x_min"},
        {"source": "coreweave", "gpu_name": "H100", "pricing_type": "on_demand", "gpu_count": "19.71", "price_per_hour": "19.71", "price_per_gpu_hour": "1.0"},
        {"source": "aws", "gpu_name": "1"},
        {"source": "aws", "gpu_name": "H100"},
        {"source": "x", "pricing_type": "Inference"},
    )
    assert rows.where(quality.keep_existing()).count() == 2
    assert rows.where(quality.save_filter()).count() == 6


def greedy(rows):
    """The sequential rule: rows are (seq, source, provider, instance, gpu)."""
    from priceframe.functions.tables import OTHER_PRIORITY, PRIORITIES

    order = lambda r: (PRIORITIES.get(r[1], OTHER_PRIORITY), r[1], r[0])
    kept = set()
    for provider in {r[2] for r in rows if r[2].strip()}:
        own = sorted((r for r in rows if r[2] == provider), key=order)
        instances, gpus = set(), set()
        for r in own:
            if r[1] == own[0][1] or not (r[3] in instances or (r[4] and r[4] in gpus)):
                kept.add(r[0])
                instances.add(r[3])
                if r[4]:
                    gpus.add(r[4])
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_equal_sequential_rule(spark, seed):
    draw = random.Random(seed)
    rows = [(f"{k:04}", draw.choice(["aws", "skypilot", "shadeform", "other", "coreweave"]), draw.choice(["p", "q", " "]), f"i{draw.randrange(40)}", draw.choice(["", *(f"g{j}" for j in range(25))])) for k in range(300)]
    df = spark.createDataFrame([(r[0], *offer(source=r[1], provider=r[2], instance_type=r[3], gpu_name=r[4])) for r in rows], "row_seq string, " + ", ".join(f"{x} string" for x in COLUMNS))
    assert {r.row_seq for r in resolve.resolve(df, backfill=False).collect()} == greedy(rows)


def test_backfill(spark):
    rows = [("1", offer(source="aws", provider="p", instance_type="i", price_per_hour="10.0")), ("2", offer(source="skypilot", provider="P ", instance_type="I", price_per_hour="9", network_desc="fast", zone="nan")), ("3", offer(source="shadeform", provider="p", instance_type="i", network_desc="slow", zone="z"))]
    df = spark.createDataFrame([(k, *r) for k, r in rows], "row_seq string, " + ", ".join(f"{x} string" for x in COLUMNS))
    (out,) = resolve.resolve(df).collect()
    assert (out.price_per_hour, out.network_desc, out.zone, out.row_seq) == ("10.0", "fast", "z", "1")


def test_header_migration(spark):
    old = [x for x in COLUMNS if not x.startswith("upfront")]
    cells = [(1, [f"v{k}" for k in range(33)]), (2, [f"o{k}" for k in range(31)]), (3, [""] * 31)]
    out = dedup.migrate_header(spark.createDataFrame(cells, "id int, cells array<string>"), old).orderBy("id").collect()
    assert len(out) == 2 and out[0].raw_extra == "v32" and out[1].upfront_price == "" and out[1].raw_extra == "o30"


def test_incremental_finalize(spark):
    rows = lambda *r: table(spark, *r).withColumn("row_seq", F.lit("1"))
    published = rows({"snapshot_date": "2026-01-02", "provider": "keep"}, {"snapshot_date": "2026-01-05", "provider": "stale"}, {"snapshot_date": "2025-01-01", "provider": "old"})
    old, new = rows({"snapshot_date": "2026-01-02", "provider": "keep", "gpu_name": "H100"}), rows({"snapshot_date": "2026-01-05", "provider": "fresh", "gpu_name": "H100"}, {"snapshot_date": "2025-01-01", "provider": "late", "gpu_name": "H100"})
    out = dedup.incremental_finalize(published, old, new, "2025-10-01", lambda x: x)
    assert sorted(r.provider for r in out.collect()) == ["fresh", "keep"]


def test_gate_and_types(spark):
    df = table(spark, {"source": "a", "snapshot_date": "2026-01-01", "price_per_hour": "1.5", "vcpus": "16/32"}, {"source": "b", "snapshot_date": "2026-01-09"})
    assert stats.health_gate(df, 2, 2, 75).first().status == "span too short"
    with pytest.raises(ValueError):
        stats.require_healthy(df)
    typed = conform.typed(df)
    assert [f.dataType for f in typed.schema] == [f.dataType for f in OFFER_SCHEMA] and typed.first().vcpus is None
    assert stats.master_summary(df.limit(0)).first().n_rows == 0


def test_repair_all_order_and_counters(spark):
    rows = table(
        spark,
        {"source": "aws", "gpu_name": "h100", "pricing_type": "on_demand", "price_per_gpu_hour": "0.1", "raw_extra": '{"n":1}', "region": "r", "gpu_memory_gb": "80"},
        {"source": "akash", "gpu_name": "H100", "instance_type": "a_min", "region": "r", "geo_group": "Unknown", "gpu_memory_gb": "80"},
        {"source": "vultr", "provider": "vultr", "gpu_name": "a100-80gb", "gpu_memory_gb": "40", "price_per_hour": "1.2", "region": "r"},
        {"source": "x", "gpu_name": "H100", "currency": "1", "price_unit": "2", "available": "USD", "available_count": "hour", "os": "true", "region": "r", "geo_group": "Unknown", "gpu_memory_gb": "80"},
        {"source": "x", "gpu_name": "H100", "region": "r", "geo_group": "Unknown", "gpu_memory_gb": "80"},
    )
    out = repair.repair_all(rows)
    assert out.columns == [*COLUMNS, "shifted", "changed", "keep"]
    by = {r.source: r for r in out.where("source != 'x'").collect()}
    assert (by["aws"].pricing_type, by["aws"].raw_extra) == ("reserved", '{"n":1,"purchase_option":"capacity_block","billing_model":"capacity_block"}')
    assert (by["vultr"].gpu_name, by["vultr"].gpu_count, by["vultr"].price_per_gpu_hour) == ("A100", "0.5", "2.4")
    counts = {r.source: tuple(r)[1:] for r in repair.repair_counts(out).collect()}
    assert counts == {"aws": (1, 0, 1, 0), "akash": (1, 0, 0, 1), "vultr": (1, 0, 1, 0), "x": (2, 1, 0, 0)}


def test_tail_keeps_types(spark):
    raw = '{"a":1,"ok":true,"locs":["x",2],"n":{"k":2.5,"z":null},"s":"\\"q\\"","price_tier":"max"}'
    put = c.json_put(F.col("x"), {"ok": F.lit("no"), "new": F.lit("v"), "none": F.lit(None)}, ["price_tier"])
    cases = [raw, '{"a":1,"a":2}', "[1]", "nope", '{"price_tier":1}', "", None]
    out = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(cases)], "k int, x string").orderBy("k").select(put).collect()]
    assert out[:3] == ['{"a":1,"ok":"no","locs":["x",2],"n":{"k":2.5,"z":null},"s":"\\"q\\"","new":"v"}', '{"a":2,"ok":"no","new":"v"}', '{"ok":"no","new":"v"}']
    gone = c.json_put(F.col("x"), {}, ["price_tier"])
    assert [r[0] for r in spark.createDataFrame([(x,) for x in cases[4:]], "x string").select(gone).collect()] == ['{"price_tier":1}', "", ""]


def planned_scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_plans_read_each_table_once(spark):
    assert planned_scans(queries.conform_offers(spark, SF)) == 2
    assert planned_scans(queries.normalise_existing(spark, SF)) == 2
    assert planned_scans(queries.repair_counts(spark, SF)) == 2
    backfilled = queries.resolve_backfill(spark, SF)
    assert "lineitem" not in str(backfilled.inputFiles()) and planned_scans(backfilled) <= 8


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_prune_metrics_tells_rows_apart_by_narrow_bits(spark):
    """Texts that are equal when joined, with the joint's sign in them, are different rows; a whole row is never shuffled."""
    rows = table(spark, *[{"source": "a", "snapshot_date": "2026-01-01", "os": x, "tenancy": y} for x, y in (("p\1q", "r"), ("p", "q\1r"), ("p", "q\1r"), ("pq", "r"))], {"source": "b", "snapshot_date": "2020-01-01"})
    out = dedup.prune_metrics(rows.repartition(3), "2025-01-01")
    assert sorted(map(tuple, out.collect())) == [("a", 4, 1, 0, 3), ("b", 1, 0, 1, 0)]
    assert all("hashpartitioning(content#" in x or "hashpartitioning(source#" in x for x in plan_of(out).splitlines() if "Exchange hashpartitioning" in x)


def test_dedup_exact_through_buckets_needs_no_shuffle(spark):
    rows = table(spark, *[{"source": f"s{k % 5}", "os": "" if k % 2 else "x"} for k in range(60)]).withColumn("tenancy", F.when(F.col("os") == "x", F.lit(None).cast("string")).otherwise("")).repartition(4)
    out = dedup.dedup_exact(rows, buckets=3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, dedup.dedup_exact(rows).collect())) and out.count() == 10
    assert "Exchange" not in plan_of(out) and not [t for t in spark.catalog.listTables() if t.name.startswith("distinct")]


def test_resolution_needs_no_shuffle_of_offers(spark):
    """All steps group and join within buckets of date and provider, the backfill of the offers that stay included."""
    rows = [{"snapshot_date": f"2026-01-0{k % 3 + 1}", "provider": "p" if k % 2 else "q", "source": ["aws", "skypilot", "zzz"][k % 3 if k > 9 else 2], "instance_type": f"i{k % 7}", "gpu_name": f"g{k % 4}", "zone": "z" if k % 5 else ""} for k in range(60)]
    df = table(spark, *rows).withColumn("row_seq", F.format_string("%05d", F.monotonically_increasing_id()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_of(resolve.resolve(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_incremental_finalize_compares_rows_in_their_buckets(spark):
    assert "Exchange hashpartitioning" not in plan_of(queries.incremental_finalize(spark, SF))


def test_repairs_run_in_methods_that_are_compiled(spark):
    repair.repair_all(table(spark, {"source": "a"}))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    values(spark, lambda x: c.json_get(x, "a"), [('{"\\u0061":"x"}', "x"), ('{"a":" y "}', "y"), ('{"b":1}', ""), ("not json, a", ""), (None, "")])
