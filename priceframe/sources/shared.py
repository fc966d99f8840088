"""Folders that driver and executors share, for checkpoints and tables written between the steps of an operator."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, also given to DataFrame.checkpoint(). Where it is unset, a run on one machine (tests)
    gets a folder of its own; on a cluster, where that would hold blocks no other machine sees, it is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", where)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def written(rows: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """rows, written once to the shared folder and read back: what follows neither computes them again nor depends on the
    executors that did. zstd makes wide tables smaller."""
    path = f"{checkpoint_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path, compression=codec)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def bucketed(rows: DataFrame, by: list[str], name: str, buckets: int = 0) -> DataFrame:
    """rows, written once as a table in buckets by some columns: what groups or joins by them and others reads bucket by bucket and
    needs no shuffle, and columns take a tenth of the disk of shuffled rows. The table is only named while it is written. Unless
    buckets are given there are as many as shuffles have partitions, at most eight a core, and no more than twice as many tasks
    write, since each of them may write to each bucket."""
    spark, table = rows.sparkSession, f"{name}_{uuid.uuid4().hex}"
    if not buckets:
        cores = spark.sparkContext.defaultParallelism
        buckets, rows = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * cores), rows.coalesce(16 * cores)
    rows.write.bucketBy(buckets, *by).option("path", f"{checkpoint_dir(spark)}/{table}").option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the catalog's entry; files outside the warehouse stay
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the written tables that these read, which nothing else reads any more; files outside the checkpoint folder stay."""
    for rows in tables:
        spark, plain = rows.sparkSession, lambda path: re.sub("^file:/+", "file:/", path)
        for folder in {file.rpartition("/")[0] for file in rows.inputFiles()}:
            if plain(folder).startswith(plain(checkpoint_dir(spark)) + "/"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
