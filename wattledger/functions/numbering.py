"""Row numbers over a whole table without sending it to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from wattledger.scratch import keep

ROWS = 1_000_000  # about so many in a range
_INSIDE = (1 << 33) - 1  # monotonically_increasing_id counts the rows of a partition in these bits


def global_row_number(df: DataFrame, key: str, name: str = "rn", rows: int = ROWS) -> DataFrame:
    """Number all rows from 1 by ``key``, nulls first.

    A window over the whole table runs in one task. Here the table is split into sorted ranges, as many as its size asks
    for; rows are counted inside their range, and ranges start where the counts before them end. The numbered ranges are
    written before they are counted, so that both steps see the same ones. Rows with equal keys, or none, are ordered by
    a hash of the row, and are split over ranges too.
    """
    tasks = max(1, -(-df.count() // rows))
    flat = [c for c in df.columns if not isinstance(df.schema[c].dataType, (MapType, VariantType))]
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*flat)]
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    numbered = keep(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_INSIDE)).alias("_in")), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = numbered.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_in") + 1).drop("_part", "_in", "_start")


def waves(df: DataFrame, key: str, size: int = 400, name: str = "wave") -> DataFrame:
    """The batch of at most ``size`` rows that each row of the sorted table falls in, from 1."""
    return global_row_number(df, key, "_rn").withColumn(name, F.ceil(F.col("_rn") / size).cast("bigint")).drop("_rn")
