"""An offer table derived from the star-schema tables, dirty on purpose; the same SQL runs on Spark and on other engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _case(key: str, values: list[str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


SOURCES = ["aws", "azure", "cloreai", "akash", "coreweave", "vultr", "skypilot", "getdeploying"]
_PROVIDERS = ["aws", "AZURE ", "google cloud", "lambda-labs", "runpod_our_sponsor", "vultr", "akash", "coreweave", "cloreai", ""]
_GPUS = [
    "h100-sxm5-80gb", "NVIDIA H100", "A100 80GB", "a100-sxm4-40gb", "RTXA2000", "RTXPro6000", "gtx1070ti", "p40", "gaudi2", "GPU (unspecified)", "CPU", "1", "",
    "NVIDIA GeForce RTX 4070 Ti", "GB200 NVL72", "Tesla V100 PCIE 16GB", "L40S", "b200-192gb", " H200 ", "MI300X", "A10", "L4", "odd accelerator 9", "GTX 1070 Ti",
]
_REGIONS = ["us-east-1", "EU_West", "ap south", "", "NL", "westus2", "sa-east-1", "me-central", "canadacentral", "usgov-1", "northamerica-2", "mars-1", ""]
_MEMORY = ["80", "", "24 GB", "{''Gpus'': [{''MemoryInfo'': {''SizeInMiB'': 81920}}]}", "40GiB", "{\"TotalGpuMemoryInMiB\": 655360}", "nonsense"]
_PRICING = ["on-demand", "Preemptible", "committed", "inference", "", "on_demand", "Hourly Deal"]
_EXTRA = [
    "", "{\"locations\":[\"\",\"ewr\"]}", "{\"billing_model\":\"capacity_block\"}", "{\"purchase_option\":\"capacity_reservation\",\"a\":\"b\"}", "{\"capacity_status\":\"UnusedCapacityReservation\"}",
    "{\"price_tier\":\"max\"}", "{\"price_metric\":\"weightedAverage\"}", "not json", "{\"price_tier\":\"weightedAverage\",\"note\":\"x\"}",
    "{\"a\":1,\"ok\":true,\"locs\":[\"x\",2],\"n\":{\"k\":2.5},\"price_tier\":\"avg\",\"capacity_status\":\"AllocatedCapacityReservation\"}", "{\"daily_usd\":24.5,\"k\":[1,{\"b\":false}]}",
]

#: Cents of the hourly price; a price is shown with two decimals.
_CENTS = "CAST(round(l_extendedprice) AS BIGINT)"


def _money(cents: str) -> str:
    return f"(CAST(CAST(floor(({cents}) / 100) AS BIGINT) AS STRING) || '.' || lpad(CAST(({cents}) % 100 AS STRING), 2, '0'))"


def offer_columns() -> list[str]:
    """The offer's columns as SQL over lineitem and supplier."""
    pick = lambda values, key: _case(f"({key}) % {len(values)}", values)
    instance = """CASE WHEN l_suppkey % 8 = 1 AND l_partkey % 40 = 1 THEN 'Standard_NC40ads_H100_v5' WHEN l_suppkey % 8 = 4 AND l_partkey % 5 = 2 THEN ' GB200  NVL72'
        WHEN l_suppkey % 8 = 3 AND l_partkey % 5 = 3 THEN 'it_weightedAverage' WHEN l_suppkey % 8 = 3 AND l_partkey % 5 = 4 THEN 'it_max' ELSE 'it-' || CAST(l_partkey % 40 AS STRING) END"""
    each = f"""CASE WHEN l_suppkey % 8 = 1 AND l_partkey % 7 = 3 THEN '812.5' WHEN l_suppkey % 8 = 0 AND l_partkey % 5 = 1 THEN '0.015625' WHEN l_suppkey % 8 = 4 AND l_partkey % 11 = 3 THEN '1.0'
        WHEN l_suppkey % 8 = 3 AND l_partkey % 3 = 0 THEN '55.83' ELSE {_money(_CENTS)} END"""
    count = f"""CASE WHEN l_suppkey % 8 = 4 AND l_partkey % 11 = 3 THEN {_money(_CENTS)} ELSE {pick(['1', '2', '4', '8', '0', ''], 'l_linenumber + l_partkey')} END"""
    return [
        f"lpad(CAST(l_orderkey AS STRING), 12, '0') || lpad(CAST(l_linenumber AS STRING), 3, '0') || lpad(CAST(l_partkey AS STRING), 10, '0') || lpad(CAST(l_suppkey AS STRING), 9, '0') || lpad(CAST({_CENTS} AS STRING), 10, '0') AS row_seq",
        f"substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) || '-01' AS snapshot_date",
        f"CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T00:00:00Z' AS snapshot_ts",
        f"{pick(SOURCES, 'l_suppkey')} AS source",
        f"{pick(_PROVIDERS, 'l_partkey')} AS provider",
        f"{instance} AS instance_type",
        f"'f' || CAST(l_partkey % 6 AS STRING) AS instance_family",
        f"{pick(_GPUS, 'l_partkey + l_suppkey % 3')} AS gpu_name",
        f"{pick(['SXM5', 'pci-e', '', 'nvl', 'Odd ', 'PCI E'], 'l_linenumber + l_suppkey')} AS gpu_variant",
        f"{pick(_MEMORY, 'l_orderkey')} AS gpu_memory_gb",
        f"{count} AS gpu_count",
        f"{pick(['', 'NVLink', 'none', 'PCIe'], 'l_suppkey')} AS gpu_interconnect",
        f"{pick(['', '8', '16/32', '64'], 'l_orderkey')} AS vcpus",
        f"{pick(['nan', '64', '128.5'], 'l_orderkey + l_suppkey')} AS ram_gb",
        f"{pick(['', '2x1900 NVMe SSD', 'NULL'], 'l_suppkey')} AS storage_desc",
        f"{pick(['100 Gbps', '', ' '], 'l_orderkey')} AS network_desc",
        f"{pick(_REGIONS, 's_nationkey + l_linenumber')} AS region",
        f"{pick(['', 'a', 'b'], 'l_orderkey')} AS zone",
        f"{pick(['', 'us', 'DE', '', 'JP'], 's_nationkey')} AS country",
        f"'' AS geo_group",
        f"{pick(_PRICING, 'l_linenumber * 3 + l_suppkey')} AS pricing_type",
        f"{pick(['', '1yr', '', '3yr'], 'l_partkey')} AS commitment_period",
        f"{_money(_CENTS)} AS price_per_hour",
        f"{each} AS price_per_gpu_hour",
        f"'' AS upfront_price",
        f"'' AS upfront_price_per_gpu",
        f"CASE WHEN l_orderkey % 97 = 5 THEN '12.5' ELSE 'USD' END AS currency",
        f"CASE WHEN l_orderkey % 97 = 5 THEN '3.25' ELSE 'hour' END AS price_unit",
        f"CASE WHEN l_orderkey % 97 = 5 THEN 'usd' ELSE {pick(['True', 'False', ''], 'l_orderkey')} END AS available",
        f"CASE WHEN l_orderkey % 97 = 5 THEN 'hour' ELSE {pick(['', '3'], 'l_orderkey')} END AS available_count",
        f"CASE WHEN l_orderkey % 97 = 5 THEN 'true' ELSE {pick(['Linux', 'Windows'], 'l_linenumber')} END AS os",
        f"{pick(['Shared', ''], 'l_suppkey')} AS tenancy",
        f"{pick(['NA', ''], 'l_orderkey')} AS pre_installed_sw",
        f"{pick(_EXTRA, 'l_orderkey + l_partkey')} AS raw_extra",
    ]


def offers_sql() -> str:
    return f"SELECT {', '.join(offer_columns())} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"


#: So many rows of two numbers each are broadcast, some 40 MB.
BROADCAST_ROWS = 1_000_000


def read_spread(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns of a table, the first its key; rows of a table that is read in few splits, some of which may hold no row group, are
    dealt over all cores before costly work on each of them. A large table has splits enough, and dealing it would cost disk."""
    rows, cores = spark.read.parquet(path).select(*columns), spark.sparkContext.defaultParallelism
    return rows.repartition(cores, columns[0]) if rows.rdd.getNumPartitions() < 4 * cores else rows


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty offers, with row_seq: the place of a row in its source's file."""
    used = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    items = read_spread(spark, f"{sf_dir}/lineitem.parquet", used)
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    if suppliers.count() <= BROADCAST_ROWS:  # told by the file's footer; else Spark decides
        suppliers = F.broadcast(suppliers)
    return items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(*offer_columns())
