"""Numbers for equal purchases that arrive over time, and purchases of closed months set aside.

A batch numbers the occurrences of a business key with a window over all its rows. Here rows arrive in micro-batches: each
numbers its own rows by a window and goes on from how often a key was seen before. These counts are a table beside the
checkpoint, a part for each micro-batch, which is joined and never enters Python; a micro-batch reads the parts before its own
and replaces its own, so that numbers go on after a restart and none is given twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.sources.sinks import exists

EVERY = 16  # each so many micro-batches a part holds the counts of all keys, so that few parts are read
_SEEN = "_hash string, _seen long"


def with_stream_ids(stream: DataFrame, order: Sequence[str], key: Sequence[str], closed_until: str | None = None) -> DataFrame:
    """A stream of purchases with the digest of their business key, their place among equal ones, and ``code``, for ``write_numbered``.

    Rows of one micro-batch are numbered in the order of the columns ``order``. A purchase of a month up to ``closed_until`` has
    the code CLOSED_MONTH, no id, and takes no number.
    """
    late = F.coalesce(F.col("ym") <= closed_until, F.lit(False)) if closed_until else F.lit(False)
    return stream.select("*", S.content_hash(*key).alias("_hash"), F.struct(*order).alias("_at"), F.when(late, "CLOSED_MONTH").alias("code"))


def _seen(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """(_hash, _seen): how often each key was seen before a micro-batch."""
    parts = [f"{folder}/batch={b}" for b in range(max(0, number // EVERY * EVERY - 1), number) if exists(spark, f"{folder}/batch={b}")]
    rows = spark.read.schema(_SEEN).parquet(*parts) if parts else spark.createDataFrame([], _SEEN)
    return rows.groupBy("_hash").agg(F.max("_seen").alias("_seen")) if len(parts) > 1 else rows


def write_numbered(stream: DataFrame, folder: str, checkpoint: str, parts: int | None = None):
    """Run the stream over all that is there; ``read_numbered`` gives its two tables.

    A micro-batch is one write into a folder of its own, so one that is run again after a failure replaces what it wrote before.
    ``parts`` is how many tasks number the rows, by default the session's shuffle partitions.
    """
    counts = f"{checkpoint}/seen"

    def write(batch: DataFrame, number: int) -> None:
        spark, place = batch.sparkSession, f"{folder}/batch={number}"
        before = _seen(spark, counts, number)
        # closed months have keys of their own, so that they leave the counts of open ones alone
        own = Window.partitionBy("_hash", "code").orderBy(F.col("_at").asc_nulls_first())
        met = batch.withColumn("_in", F.row_number().over(own)).join(before, "_hash", "left")
        numbered = met.withColumn("_nth", F.when(F.col("code").isNull(), F.col("_in") + F.coalesce("_seen", F.lit(0).cast("long")))).drop("_at", "_in", "_seen")
        numbered.withColumn("closed", F.col("code").isNotNull()).write.mode("overwrite").partitionBy("closed").parquet(place)
        told = spark.read.schema("_hash string, _nth long").parquet(place).where("_nth is not null").groupBy("_hash").agg(F.max("_nth").alias("_seen"))
        if number % EVERY == EVERY - 1:
            told = before.unionByName(told).groupBy("_hash").agg(F.max("_seen").alias("_seen"))
        told.write.mode("overwrite").parquet(f"{counts}/batch={number}")

    conf, name = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    try:
        if parts:
            conf.set(name, str(parts))  # a stream takes its settings when it starts
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(name, before)


def read_numbered(stream: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(facts, conflicts): the numbered purchases, and those of closed months with their code, of a stream that was written there."""
    plain = [f for f in stream.schema.fields if f.name not in ("_at", "_hash", "code")]
    schema = T.StructType([*plain, *(T.StructField(n, k) for n, k in (("_hash", T.StringType()), ("code", T.StringType()), ("_nth", T.LongType()), ("batch", T.IntegerType()), ("closed", T.BooleanType())))])
    rows = stream.sparkSession.read.schema(schema).parquet(folder)
    names = [f.name for f in plain]
    id_ = F.when(F.col("_nth") == 1, F.col("_hash")).otherwise(F.concat("_hash", F.lit("__"), F.col("_nth").cast("string")))
    return rows.where(~F.col("closed")).select(*names, id_.alias("atomicId")), rows.where("closed").select(*names, "code")
