"""Dense month profiles: one row for each known meter, with a value for each month, sales or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError


def require_known(facts: DataFrame, master: DataFrame, key: str = "meterNo") -> None:
    """Every meter with sales is in the master; the first that isn't stops the run."""
    lost = facts.select(key).join(master.select(key), key, "left_anti").limit(5).collect()
    if lost:
        raise ContractError(f"sales of unknown meters, such as {[r[0] for r in lost]}")


def month_maps(monthly: DataFrame, key: str = "meterNo") -> DataFrame:
    """A meter's months as one map, with its total and the last purchase of a month with sales.

    ``monthly`` holds a row for each meter and month, so a map has as many entries as there are months.
    """
    grouped = monthly.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("ym", "amountTotalC")))).alias("monthlyTotalsC"),
        F.sum("amountTotalC").cast("bigint").alias("totalC"),
        F.max(F.when(F.col("amountTotalC") > 0, F.col("ym"))).alias("lastMonth"),
        F.max(F.when(F.col("amountTotalC") > 0, F.col("lastPurchaseMs"))).alias("lastPurchaseMs"),
    )
    return grouped


def sales_all(master: DataFrame, monthly: DataFrame, as_of: str | Column, key: str = "meterNo") -> DataFrame:
    """Every master row with its month map (empty without sales), total and recency; recency only where there are sales."""
    sums = month_maps(monthly, key)
    day = F.to_date(F.timestamp_millis("lastPurchaseMs"))
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    out = master.join(sums, key, "left").withColumns({
        "monthlyTotalsC": F.coalesce("monthlyTotalsC", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))),
        "totalC": F.coalesce("totalC", F.lit(0)).cast("bigint"),
    })
    sold = F.col("totalC") > 0
    return out.withColumns({"lastPurchaseDate": F.when(sold, F.date_format(day, "yyyy-MM-dd")), "lastMonth": F.when(sold, F.col("lastMonth")), "daysSinceLastPurchase": F.when(sold, F.datediff(as_of, day))}).drop("lastPurchaseMs")


def dense_months(master: DataFrame, monthly: DataFrame, first: str, last: str, key: str = "meterNo") -> DataFrame:
    """A row for each master meter and each month of the range, 0 where there are no sales.

    The months are exploded from a constant array, so no cross join is planned.
    """
    every = master.select(key, F.explode(S.month_range(F.lit(first), F.lit(last))).alias("ym"))
    return every.join(monthly.select(key, "ym", "amountTotalC"), [key, "ym"], "left").withColumn("amountTotalC", F.coalesce("amountTotalC", F.lit(0)).cast("bigint"))


def pivot_months(monthly: DataFrame, months: Sequence[str], key: str = "meterNo") -> DataFrame:
    """A column for each month of the list; conditional sums, one shuffle, 0 where there is nothing."""
    return monthly.groupBy(key).agg(*(F.coalesce(F.sum(F.when(F.col("ym") == m, F.col("amountTotalC"))), F.lit(0)).cast("bigint").alias(M.month_column(m)) for m in months))


def output_checks(months: Sequence[str]) -> dict[str, Column]:
    """Checks of a wide table: months add up to the total, and none is negative."""
    columns = [F.col(M.month_column(m)) for m in months]
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return {"total_differs": total != F.col("totalC"), "negative_month": F.least(*columns, F.lit(0)) < 0}
