"""Raw and staged purchases to atomic facts, one row for each purchase, with ids from their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators import validate

# fixed values: the columns of an atomic fact and of a staged row, in order, and those that name a purchase
ATOMIC_COLUMNS = (
    "atomicId", "vendingProviderId", "lmPcode", "meterNo", "txAtISO", "txAtMs", "ym", "y", "m", "amountTotalC", "costC",
    "vatC", "currency", "sourceFileId", "sourceRow", "ingestedAtISO", "ingestedAtMs",
)
STAGING_COLUMNS = ("lmPcode", "txAt", "meterNo", "amountTotalC", "costC", "vatC")
BUSINESS_KEY = ("vendingProviderId", "lmPcode", "meterNo", "txAtISO", "amountTotalC", "costC", "vatC")


def stage_portal(raw: DataFrame, lm: str, month: str) -> validate.Split:
    """A portal export to staged rows, money as rand text again; rejected rows keep their source values."""
    found = validate.split(raw, validate.portal_rules(month), parsed=True)
    rand = lambda c: F.format_string("%d.%02d", F.floor(F.col(f"_{c}") / 100).cast("bigint"), F.pmod(f"_{c}", F.lit(100)))
    valid = found.valid.select(
        F.lit(lm).alias("lmPcode"), F.col("TransactionDateTime_2").alias("txAt"), F.col("_meter").alias("meterNo"),
        rand("Amount").alias("amountTotalC"), rand("CostOfUnits_2").alias("costC"), rand("VAT").alias("vatC"),
        *(c for c in raw.columns if c == "sourceRow"),
    )
    return validate.Split(valid, found.rejected.select(*raw.columns, "rejectReason"))


def with_atomic_ids(df: DataFrame, order: list[str | Column], key: tuple[str, ...] = BUSINESS_KEY) -> DataFrame:
    """``atomicId``: the key's SHA-1, and from its second occurrence on a suffix with the occurrence's number.

    Equal purchases are kept, not dropped; ``order`` tells the first.
    """
    hashed = df.withColumn("_hash", S.content_hash(*key))
    nth = F.row_number().over(Window.partitionBy("_hash").orderBy(*order))
    return hashed.withColumn("_nth", nth).withColumn("atomicId", F.when(F.col("_nth") == 1, F.col("_hash")).otherwise(F.concat("_hash", F.lit("__"), F.col("_nth")))).drop("_hash", "_nth")


def atomic_facts(staged: DataFrame, provider: str, lm: str, month: str, file_id: str, ingested_ms: int) -> validate.Split:
    """Staged rows with ``sourceRow`` to atomic facts."""
    found = validate.split(staged, validate.staging_rules(lm, month), parsed=True)
    time = F.col("_time")
    typed = found.valid.select(
        F.lit(provider).alias("vendingProviderId"), F.col("_place").alias("lmPcode"), F.col("_meter").alias("meterNo"),
        S.iso_text(time).alias("txAtISO"), S.wall_clock_ms(time).alias("txAtMs"), S.month_of(time).alias("ym"), F.year(time).cast("bigint").alias("y"), F.month(time).cast("bigint").alias("m"),
        *(F.col(f"_{c}").alias(c) for c in ("amountTotalC", "costC", "vatC")),
        F.lit("ZAR").alias("currency"), F.lit(file_id).alias("sourceFileId"), F.col("sourceRow").cast("bigint").alias("sourceRow"),
        S.ms_to_iso_z(F.lit(ingested_ms)).alias("ingestedAtISO"), F.lit(ingested_ms).cast("bigint").alias("ingestedAtMs"),
    )
    return validate.Split(with_atomic_ids(typed, ["sourceRow"]).select(*ATOMIC_COLUMNS), found.rejected.select(*staged.columns, "rejectReason"))


def id_mismatches(facts: DataFrame) -> DataFrame:
    """Facts whose id isn't the one that their content gives."""
    again = with_atomic_ids(facts.withColumnRenamed("atomicId", "_given"), ["sourceRow"])
    return again.where(F.col("_given") != F.col("atomicId")).drop("_given")


def fact_checks(lm: str, month: str) -> dict[str, Column]:
    """Conditions that no row of a month's facts may fulfil."""
    return {
        "other_municipality": F.col("lmPcode") != lm,
        "other_month": (F.col("ym") != month) | (F.substring("txAtISO", 1, 7) != month),
        "parts_differ": (F.col("y") != F.substring("ym", 1, 4).cast("bigint")) | (F.col("m") != F.substring("ym", 6, 2).cast("bigint")),
        "time_differs": F.unix_millis(F.col("txAtISO").cast("timestamp")) != F.col("txAtMs"),
        "money_differs": F.col("amountTotalC") != F.col("costC") + F.col("vatC"),
        "negative": F.least("amountTotalC", "costC", "vatC") < 0,
        "blank_meter": S.clean_text("meterNo") == "",
    }
