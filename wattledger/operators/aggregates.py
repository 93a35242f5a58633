"""Sales by meter and month, by municipality, and by spending group; and the checks that the three agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import scalars as S

MONEY = ("amountTotalC", "costC", "vatC")


def _sums(count: Column) -> list[Column]:
    return [count.cast("bigint").alias("purchasesCount"), *(F.sum(c).cast("bigint").alias(c) for c in MONEY)]


def monthly_meters(facts: DataFrame) -> DataFrame:
    """A row for each municipality, meter and month, with its spending group; sums run before the shuffle."""
    grouped = facts.groupBy("lmPcode", "meterNo", "ym").agg(*_sums(F.count("*")), F.min("txAtMs").alias("firstPurchaseMs"), F.max("txAtMs").alias("lastPurchaseMs"))
    return grouped.select(
        S.doc_id("lmPcode", "meterNo", "ym").alias("id"), "*", S.spending_group("amountTotalC").alias("salesGroupId"), S.spending_label("amountTotalC").alias("salesGroupLabel"),
        S.ms_to_iso_z("firstPurchaseMs").alias("firstPurchaseISO"), S.ms_to_iso_z("lastPurchaseMs").alias("lastPurchaseISO"),
    )


def monthly_municipalities(facts: DataFrame) -> DataFrame:
    """Exact distinct meters and sums for each municipality and month.

    Meters are grouped first and counted then: a municipality with a third of all rows is no hot key that way.
    """
    meters = facts.groupBy("lmPcode", "ym", "meterNo").agg(*_sums(F.count("*")), F.min("txAtMs").alias("firstPurchaseMs"), F.max("txAtMs").alias("lastPurchaseMs"))
    return meters.groupBy("lmPcode", "ym").agg(F.count("*").alias("metersCount"), *_sums(F.sum("purchasesCount")), F.min("firstPurchaseMs").alias("firstPurchaseMs"), F.max("lastPurchaseMs").alias("lastPurchaseMs")).withColumn("id", S.doc_id("lmPcode", "ym"))


def monthly_groups(monthly: DataFrame) -> DataFrame:
    """Each municipality, month and spending group that has meters."""
    keys = ["lmPcode", "ym", "salesGroupId", "salesGroupLabel"]
    out = monthly.groupBy(*keys).agg(F.count("*").alias("metersCount"), *_sums(F.sum("purchasesCount")), F.min("firstPurchaseMs").alias("firstPurchaseMs"), F.max("lastPurchaseMs").alias("lastPurchaseMs"))
    return out.withColumn("id", S.doc_id("lmPcode", "ym", "salesGroupId"))


def source_municipalities(monthly: DataFrame) -> DataFrame:
    """Municipality rows where only monthly totals exist: no purchase counts or times, but units and meters without sales."""
    return monthly.groupBy("lmPcode", "ym").agg(F.count("*").alias("metersCount"), F.sum("amountTotalC").cast("bigint").alias("amountTotalC"), F.sum("unitsTotal").cast("decimal(28,1)").alias("unitsTotal"), F.count_if(F.col("amountTotalC") == 0).alias("zeroSalesMetersCount"))


def source_groups(monthly: DataFrame) -> DataFrame:
    grouped = monthly.withColumns({"salesGroupId": S.spending_group("amountTotalC"), "salesGroupLabel": S.spending_label("amountTotalC")}).groupBy("lmPcode", "ym", "salesGroupId", "salesGroupLabel")
    return grouped.agg(F.count("*").alias("metersCount"), F.sum("amountTotalC").cast("bigint").alias("amountTotalC"), F.sum("unitsTotal").cast("decimal(28,1)").alias("unitsTotal"), F.count_if(F.col("amountTotalC") == 0).alias("zeroSalesMetersCount"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_rows(df: DataFrame, by: Sequence[str], over: Sequence[str]) -> DataFrame:
    """For each ``by``: rows, and rows beyond the first of those equal in ``over``."""
    copies = df.groupBy(*by, *(c for c in over if c not in by)).agg(F.count("*").alias("_n"))
    return copies.groupBy(*by).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_rows"))


def histogram(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def document_sizes(df: DataFrame, columns: Sequence[str], most: int = 900_000) -> DataFrame:
    """Documents, the largest as JSON bytes, and how many are too large for the store."""
    size = F.octet_length(S.canonical_json(columns))
    return df.agg(F.count("*").alias("documents"), F.max(size).cast("bigint").alias("largest"), F.count_if(size > most).alias("too_large"))


def value_changes(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """One row: ids in both with another value, ids only in the new, and ids only in the old."""
    both = old.select(key, F.col(value).alias("_old"), F.lit(True).alias("_in_old")).join(new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_in_new")), key, "full_outer")
    there = F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull()
    return both.agg(F.count_if(there & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"), F.count_if(F.col("_in_old").isNull()).alias("added"), F.count_if(F.col("_in_new").isNull()).alias("removed"))
