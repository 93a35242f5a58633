"""Streams of purchases and events: windows with late rows, and months that are closed.

The source pipelines are batches; these carry their rules over to arriving data. A month that has been published is
closed: a late purchase of it is set aside as a conflict, never merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import scalars as S


def tumbling(events: DataFrame, every: str = "1 hour", late: str | None = None, time: str = "ts", kind: str = "event_type", value: str = "value") -> DataFrame:
    """Counts and sums in cents by window and kind; ``late`` sets the watermark of a stream."""
    typed = events.select(F.col(time).cast("timestamp").alias("_t"), F.col(kind).alias("kind"), S.cents(value).alias("_c"))
    if late:
        typed = typed.withWatermark("_t", late)
    out = typed.groupBy(F.window("_t", every), "kind").agg(F.count("*").alias("n"), F.sum("_c").cast("bigint").alias("value_c"))
    return out.select(S.iso_text(F.col("window.start")).alias("window_start"), "kind", "n", "value_c")


def split_closed(facts: DataFrame, closed_until: str) -> tuple[DataFrame, DataFrame]:
    """(open, conflicts): purchases after the last published month, and those that come too late."""
    return facts.where(F.col("ym") > closed_until), facts.where(F.col("ym") <= closed_until).withColumn("code", F.lit("CLOSED_MONTH"))


def append_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], available_now: bool = True):
    """Run ``write`` on each micro-batch; batch ids make it safe to write one again."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
