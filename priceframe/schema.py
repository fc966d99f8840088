"""The offer row: column names and the raw (text) and typed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

COLUMNS = (
    "snapshot_date snapshot_ts source provider instance_type instance_family gpu_name gpu_variant gpu_memory_gb gpu_count gpu_interconnect "
    "vcpus ram_gb storage_desc network_desc region zone country geo_group pricing_type commitment_period price_per_hour price_per_gpu_hour "
    "upfront_price upfront_price_per_gpu currency price_unit available available_count os tenancy pre_installed_sw raw_extra"
).split()

_TYPES = {
    "snapshot_date": T.DateType(), "snapshot_ts": T.TimestampType(), "gpu_memory_gb": T.DoubleType(), "gpu_count": T.DoubleType(), "vcpus": T.DoubleType(), "ram_gb": T.DoubleType(),
    "price_per_hour": T.DoubleType(), "price_per_gpu_hour": T.DoubleType(), "upfront_price": T.DoubleType(), "upfront_price_per_gpu": T.DoubleType(), "available": T.BooleanType(), "available_count": T.LongType(),
}

#: Everything is text, missing is the empty string; for ingestion, repair and comparisons of keys.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
#: For analytics; blanks become null.
OFFER_SCHEMA = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in COLUMNS])

#: Filled from a dropped offer when the kept one has nothing there.
BACKFILL = "gpu_variant gpu_memory_gb gpu_interconnect vcpus ram_gb storage_desc network_desc zone country geo_group available available_count commitment_period".split()
INSTANCE_KEY = "snapshot_date provider instance_type pricing_type".split()
GPU_KEY = "snapshot_date provider gpu_name gpu_count region pricing_type os".split()
