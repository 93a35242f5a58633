"""Tables that end a lineage: written in the folder that the cluster names, and read again, so that lost executors cost one step."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only a local session without the setting gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="wattledger-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over tasks; a small file is one task otherwise, however long the work on each of its rows takes."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
