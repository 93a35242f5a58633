"""Queries on stores with versions: commits, scans that open few files, points, windows from anchors, and differences found by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import pipelines
from wattledger.operators import aggregates, sampling
from wattledger.plans.changes import _STORE, CUT, _documents, _plan
from wattledger.plans.registry import query
from wattledger.plans.tables import METERS, MONTHLY, meters, purchases, table
from wattledger.scratch import scratch_folder
from wattledger.sources import store

_FILE = 200  # rows in a file, so that small tables have many


def _place(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _months(c: str = "monthlyTotalsC"):
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")


_MAPS = """om2 as (select meter, string_agg(ym || '=' || amount, '|' order by ym) as months from om group by meter), nm2 as (select meter, string_agg(ym || '=' || amount, '|' order by ym) as months from nm group by meter)"""


@query(f"""with {_STORE}, {_MAPS}, one as (select o.meter, o.lm, o.last, m.months, cast(1 as bigint) as token from old o join om2 m using (meter)),
two as (select coalesce(p.meter, one.meter) as meter, coalesce(p.lm, one.lm) as lm, coalesce(p.last, one.last) as last, coalesce(m.months, one.months) as months, case when p.meter is not null then 2 else 1 end as token
  from one full outer join (select * from plan where state in ('CREATED', 'UPDATED')) p using (meter) left join nm2 m on m.meter = p.meter)
select meter as "meterNo", lm as "lmPcode", case when cast(meter as bigint) % 17 = 0 then 'closed' else last end as "lastMonth", months, cast(case when cast(meter as bigint) % 17 = 0 then 4 else token end as bigint) as token from two where cast(meter as bigint) % 13 <> 0""")
def store_after_commits(spark: SparkSession, folder: str) -> DataFrame:
    """A store after three commits: what a plan writes, some deletions, and one field of some documents; with the token of each row."""
    expected, existing = sides = _documents(spark, folder)
    path = _place(spark, "store")
    number = F.col("meterNo").cast("bigint")
    first = store.create(existing, path, "meterNo", rows_per_file=_FILE)
    written = _plan(spark, folder, sides).where("classification in ('CREATED', 'UPDATED')").select("meterNo")
    second = store.commit(first, expected.join(written, "meterNo", "left_semi"))
    third = store.commit(second, deleted=store.read(spark, second, columns=["meterNo"]).where(number % 13 == 0))
    last = store.commit(third, store.read(spark, third).where(number % 17 == 0).withColumn("lastMonth", F.lit("closed")))
    return store.read(spark, last, token=True).select("meterNo", "lmPcode", "lastMonth", _months().alias("months"), F.col(store.TOKEN).alias("token"))


@query(f"""with {MONTHLY} select meter as "meterNo", ym, amount as "amountTotalC" from monthly where ym = '{CUT}'""")
def month_scan(spark: SparkSession, folder: str) -> DataFrame:
    """One month of a store that is sorted by months: only files whose fences admit the month are opened, and three columns read."""
    rows = aggregates.monthly_meters(purchases(spark, folder)).withColumn("id", F.concat_ws("__", "meterNo", "ym"))
    seen = store.create(rows, _place(spark, "months"), "id", ["ym"], 20 * _FILE)
    return store.read(spark, seen, {"ym": CUT}, ["meterNo", "ym", "amountTotalC"])


@query(f"""with {METERS}, asked as (select distinct o_custkey from orders where o_orderdate >= date '1998-07-15')
select lpad(cast(o_custkey as varchar), 11, '0') as "meterNo", case when o_custkey % 5 = 0 then 'changed' else m.lm end as "lmPcode", m.meter is not null as found from asked left join (select * from meters where balance >= 0 and c_custkey % 7 <> 0) m on c_custkey = o_custkey and m.meter is not null""".replace("case when o_custkey % 5 = 0 then", "case when m.meter is null then null when o_custkey % 5 = 0 then"))
def point_get(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by their keys, after a commit that changed some and deleted others: fences and filters name the files to open."""
    known = meters(spark, folder).where("balanceC >= 0").select("meterNo", "lmPcode", "c_custkey")
    first = store.create(known.drop("c_custkey"), _place(spark, "points"), "meterNo", rows_per_file=_FILE)
    changed = known.where("c_custkey % 5 = 0 and c_custkey % 7 <> 0").select("meterNo", F.lit("changed").alias("lmPcode"))
    second = store.commit(first, changed, known.where("c_custkey % 7 = 0").select("meterNo"))
    asked = table(spark, folder, "orders").where("o_orderdate >= '1998-07-15'").select(F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("meterNo"))
    return store.get(spark, second, asked)


@query(f"""with {METERS}, ends as (select min(c_custkey) as a, max(c_custkey) as b from meters), live as (select * from meters where c_custkey % 11 <> 0),
drawn as (select distinct lpad(cast(a + cast('0x' || substr(sha256('7:' || i), 1, 12) as bigint) % (b - a + 1) as varchar), 11, '0') as anchor from range(0, 12) t(i), ends),
placed as (select anchor, meter, lm, row_number() over (partition by anchor order by meter) as place from drawn join live on meter >= anchor)
select anchor, cast(place as integer) as place, meter as "meterNo", lm as "lmPcode" from placed where place <= 20""")
def anchored_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty documents in order from each of twelve drawn keys, in a store from which some documents were deleted."""
    known = meters(spark, folder).select("meterNo", "lmPcode")
    first = store.create(known, _place(spark, "windows"), "meterNo", rows_per_file=_FILE)
    seen = store.commit(first, deleted=known.where(F.col("meterNo").cast("bigint") % 11 == 0).select("meterNo"))
    found = store.windows(spark, seen, sampling.key_anchors(known, "meterNo", 12, 7), 20)
    return found.select("anchor", "place", "row.meterNo", "row.lmPcode")


@query(f"""with {_STORE}, p as (select * from plan where state <> 'CONFLICT')
select count(*) as planned, count_if(state = 'CREATED') as created, count_if(state = 'UPDATED') as updated, count_if(state = 'UNCHANGED') as unchanged, true as written, cast(2 as bigint) as version, cast(0 as bigint) as differing, cast(0 as bigint) as preserved, 'PASS' as verdict from p""")
def refreshed_store(spark: SparkSession, folder: str) -> DataFrame:
    """A month's refresh over a store, without the documents that are in conflict: planned, gated, rehearsed, written as patches, and verified with histories."""
    expected, existing = sides = _documents(spark, folder)
    path = _place(spark, "refreshed")
    store.create(existing, path, "meterNo", rows_per_file=_FILE)
    good = expected.join(_plan(spark, folder, sides).where("classification <> 'CONFLICT'").select("meterNo"), "meterNo", "left_semi")
    stored = existing.select("meterNo", F.col("lmPcode").alias("_lm"))
    # a municipality is an identity: documents without a conflict keep theirs
    return pipelines.refresh_store(spark, path, good.join(stored, "meterNo", "left").withColumn("lmPcode", F.coalesce("_lm", "lmPcode")).drop("_lm"), ["lmPcode", "provider"], ["lastMonth"], ["monthlyTotalsC"])
