"""The sales model laid over a star schema: line items are purchases, customers are meters, nations are municipalities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import scalars as S

PROVIDER = "P1"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def meter_text(c: str):
    return F.lpad(F.col(c).cast("string"), 11, "0")


def meters(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as a meter (meterNo, lmPcode, name, segment, balanceC)."""
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("lmPcode"))
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", meter_text("c_custkey").alias("meterNo"), "lmPcode", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), S.cents("c_acctbal").alias("balanceC"))


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a purchase; only the columns that a query uses are read."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("_t"))
    joined = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(meters(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    priced = joined.withColumn("amountTotalC", S.cents("l_extendedprice")).withColumn("vatC", F.expr("amountTotalC * cast(round(cast(l_tax as decimal(18,4)) * 100, 0) as bigint) div 100"))
    return priced.withColumns({
        "vendingProviderId": F.lit(PROVIDER), "costC": F.col("amountTotalC") - F.col("vatC"), "txAtISO": S.iso_text("_t"), "txAtMs": S.wall_clock_ms("_t"),
        "ym": S.month_of("_t"), "y": F.year("_t").cast("bigint"), "m": F.month("_t").cast("bigint"),
    })


# the same in SQL
METERS = """
meters as (select c_custkey, lpad(cast(c_custkey as varchar), 11, '0') as meter, n_name as lm, c_name as name, c_mktsegment as segment,
  cast(round(cast(c_acctbal as decimal(18,4)) * 100) as bigint) as balance from customer join nation on c_nationkey = n_nationkey)"""
FACTS = (
    METERS
    + """,
priced as (select *, cast(round(cast(l_extendedprice as decimal(18,4)) * 100) as bigint) as amount, cast(round(cast(l_tax as decimal(18,4)) * 100) as bigint) as pct
  from lineitem join orders on l_orderkey = o_orderkey join meters on o_custkey = c_custkey),
facts as (select *, amount * pct // 100 as vat, amount - amount * pct // 100 as cost, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as iso,
  epoch_ms(o_orderdate) as ms, strftime(o_orderdate, '%Y-%m') as ym from priced)"""
)
GROUP_ID = "case when {0} <= 9999 then 'GR1' when {0} <= 29999 then 'GR2' when {0} <= 49999 then 'GR3' when {0} <= 99999 then 'GR4' else 'GR5' end"
GROUP_LABEL = "case when {0} <= 9999 then '<=99.99' when {0} <= 29999 then '100-299.99' when {0} <= 49999 then '300-499.99' when {0} <= 99999 then '500-999.99' else '>=1000' end"
MONTHLY = (
    FACTS
    + """,
monthly as (select lm, meter, ym, count(*) as n, cast(sum(amount) as bigint) as amount, cast(sum(cost) as bigint) as cost, cast(sum(vat) as bigint) as vat,
  min(ms) as first_ms, max(ms) as last_ms from facts group by all)"""
)
