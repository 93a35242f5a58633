"""Queries that write tables to files and read them back: JSON lines, verified CSV, guarded and published tables, months by folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import pipelines
from wattledger.functions import maps as M
from wattledger.operators import evidence, facts, reconcile, validate
from wattledger.plans.changes import _STORE, _documents
from wattledger.plans.registry import query
from wattledger.plans.stores import _months, _place
from wattledger.plans.tables import FACTS, METERS, meters, purchases, table
from wattledger.scratch import keep
from wattledger.sources import delimited, sinks
from wattledger.sources.sinks import read_text


@query("""with l as (select o_orderkey as id, o_orderpriority as p, o_orderkey % 7 as k from orders)
select case when k > 2 then id end as id, case when k > 2 then p end as priority, case k when 0 then 'INVALID_JSON' when 1 then 'NOT_AN_OBJECT' end as code, case k when 0 then '{"id": ' || id when 1 then '[' || id || ']' end as text from l where k <> 2""")
def json_lines_split(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as JSON lines, some of them broken, some no objects, some blank: records and exceptions."""
    k, id_ = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    line = F.when(k == 0, F.concat(F.lit('{"id": '), id_)).when(k == 1, F.concat(F.lit("["), id_, F.lit("]"))).when(k == 2, F.lit("  ")).otherwise(F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))))
    path = _place(spark, "lines")
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    good, bad = delimited.split_json_lines(spark, path, "id bigint, priority string")
    none = F.lit(None)
    return good.select("id", "priority", none.cast("string").alias("code"), none.cast("string").alias("text")).unionByName(bad.select(none.cast("bigint").alias("id"), none.cast("string").alias("priority"), "code", F.col("value").alias("text")))


@query("""select o_orderkey as id, o_orderpriority as priority, cast(o_totalprice as varchar) as total from orders where o_orderkey % 3 > 0""")
def json_lines_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as canonical JSON lines with blank lines between, read back with blank lines skipped."""
    path = _place(spark, "lines")
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("string").alias("total"))
    sinks.write_json_lines(rows.where("id % 3 > 0"), path)
    rows.where("id % 3 = 0").select(F.lit("").alias("value")).write.mode("append").text(path)
    return delimited.read_json_lines(spark, path, "id bigint, priority string, total string", "lenient")


@query(f"""with {METERS} select meter as "meterNo", name, cast(balance as varchar) as balance, case when balance < 0 then 'negative_balance' end as reason from meters""")
def verified_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted meters as CSV that is read back before it is moved into place, and rejected ones with their reason beside it."""
    rows = meters(spark, folder).select("meterNo", "name", F.col("balanceC").cast("string").alias("balance"), (F.col("balanceC") < 0).alias("bad"))
    path = _place(spark, "verified")
    sinks.write_verified_csv(rows.where("not bad").drop("bad"), f"{path}/accepted")
    sinks.write_rejections(rows.where("bad").drop("bad").withColumn("rejectReason", F.lit("negative_balance")), f"{path}/rejected")
    accepted = delimited.read_csv(spark, f"{path}/accepted", ["meterNo", "name", "balance"]).withColumn("reason", F.lit(None).cast("string"))
    return accepted.unionByName(delimited.read_csv(spark, f"{path}/rejected", ["rejectReason", "meterNo", "name", "balance"]).withColumnRenamed("rejectReason", "reason"))


@query(f"""with {METERS}, n as (select count(*) as a, count_if(balance >= 0) as b from meters) select 1 as step, 'MISSING' as state, a as rows from n union all select 2, 'IDENTICAL', a from n union all select 3, 'REFUSED', a from n union all select 4, 'DIFFERENT', b from n""")
def guarded_states(spark: SparkSession, folder: str) -> DataFrame:
    """A table written, written again in another order, refused with other rows, and replaced by them: the state and the rows that stand there after each step."""
    rows = keep(meters(spark, folder).select("meterNo", "lmPcode", "balanceC"), "rows")
    path, told = _place(spark, "guarded"), []
    other = rows.where("balanceC >= 0")
    for step, (df, replace) in enumerate(((rows, False), (rows.orderBy(F.desc("meterNo")), False), (other, False), (other, True)), 1):
        try:
            state = sinks.guarded_write(df, path, replace)
        except sinks.ContractError:
            state = "REFUSED"
        told.append(sinks.read_table(spark, path).agg(F.lit(step).alias("step"), F.lit(state).alias("state"), F.count("*").alias("rows")))
    return told[0].unionByName(told[1]).unionByName(told[2]).unionByName(keep(told[3], "last"))


@query(f"""with {FACTS} select 'masters' as output, (select count(*) from meters) as rows, true as same union all select 'sales', (select count(*) from (select distinct meter, ym from facts)), true""")
def published_load(spark: SparkSession, folder: str) -> DataFrame:
    """An initial load of two tables: what its evidence says, and whether the published tables have the digests that it names."""
    masters = keep(meters(spark, folder).select("meterNo", "lmPcode", "name"), "masters")
    sales = keep(purchases(spark, folder).groupBy(F.concat_ws("__", "meterNo", "ym").alias("id")).agg(F.sum("amountTotalC").cast("bigint").alias("amountTotalC")), "sales")
    path = _place(spark, "published")
    evidence = pipelines.initial_load(spark, {"masters": (masters, "meterNo"), "sales": (sales, "id")}, path)
    version = sinks.pointer(spark, f"{path}/current")[1]["version"]
    entries = json.loads(read_text(spark, f"{path}/versions/{version}.json"))
    found = None
    for name, blob in entries.items():
        df = sinks.read_table(spark, blob)
        one = reconcile.digest(df, df.columns).select(F.lit(name).alias("output"), F.col("digest").alias("found"))
        found = one if found is None else found.unionByName(one)
    return evidence.join(found, "output").select("output", "rows", (F.col("digest") == F.col("found")).alias("same"))


@query(f"""with {FACTS} select distinct meter as "meterNo" from facts where ym between '1997-11' and '1998-02'""")
def months_union(spark: SparkSession, folder: str) -> DataFrame:
    """Meters of several months: facts stand in folders by month, and only those months' folders are read."""
    path = _place(spark, "by-month")
    sinks.write_partitioned(purchases(spark, folder).select("meterNo", "ym", "txAtMs", "amountTotalC"), path)
    return spark.read.parquet(path).where("ym between '1997-11' and '1998-02'").select("meterNo").distinct()


@query("""select 'lineitem' as name, (select count(*) from lineitem) as rows union all select 'orders', (select count(*) from orders) union all select 'customer', (select count(*) from customer) union all select 'events', (select count(*) from events) union all select 'embeddings', (select count(*) from embeddings)""")
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of tables, of which no column is read."""
    parts = [table(spark, folder, n).agg(F.lit(n).alias("name"), F.count("*").alias("rows")) for n in ("lineitem", "orders", "customer", "events", "embeddings")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(f"""with {FACTS} select meter as "meterNo", cast(l_orderkey * 10 + l_linenumber as bigint) as "sourceRow" from facts where l_orderkey % 50 = 0""")
def id_check(spark: SparkSession, folder: str) -> DataFrame:
    """Facts whose id isn't what their content gives: some had a digit changed, some lost their number."""
    rows = facts.with_atomic_ids(purchases(spark, folder).withColumn("sourceRow", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint")), ["sourceRow"])
    changed = F.when(F.col("l_orderkey") % 100 == 0, F.concat(F.lit("x"), F.substring("atomicId", 2, 100))).otherwise(F.concat("atomicId", F.lit("__9999")))
    return facts.id_mismatches(rows.withColumn("atomicId", F.when(F.col("l_orderkey") % 50 == 0, changed).otherwise(F.col("atomicId")))).select("meterNo", "sourceRow")


@query(f"""with {_STORE}, both_sides as (select meter from (select distinct meter from om) join (select distinct meter from nm) using (meter)), clash as (select om.meter, string_agg(om.ym, '|' order by om.ym) as conflicts from om join nm using (meter, ym) where om.amount <> nm.amount group by om.meter),
merged as (select meter, ym, amount from om union all select meter, ym, amount from nm where not exists (select 1 from om where om.meter = nm.meter and om.ym = nm.ym) and meter not in (select meter from clash))
select meter as "meterNo", string_agg(ym || '=' || amount, '|' order by ym) as months, coalesce(any_value(conflicts), '') as conflicts from merged join both_sides using (meter) left join clash using (meter) group by meter""")
def history_extension(spark: SparkSession, folder: str) -> DataFrame:
    """Stored month histories with new months appended; one with a changed month stays as it is and names it."""
    expected, existing = _documents(spark, folder)
    met = existing.select("meterNo", F.col("monthlyTotalsC").alias("old")).join(expected.select("meterNo", F.col("monthlyTotalsC").alias("new")), "meterNo")
    told = met.select("meterNo", M.extend_history(F.col("old"), F.col("new")).alias("x")).select("meterNo", F.col("x.value").alias("months"), F.array_join("x.conflicts", "|").alias("conflicts"))
    return told.withColumn("months", _months("months"))


_SCOPES = f"""{FACTS}, firsts as (select meter, min(ym) as first_month from facts group by meter),
m as (select lm, segment, ym, meter, any_value(balance) as balance, max(amount) as top from facts where ym between '1998-04' and '1998-07' group by lm, segment, ym, meter)"""


@query(f"""with {_SCOPES}, g as (select lm, segment, ym, count(*) as n, count_if(balance > -95000) as inspected, count_if(balance >= -90000) as verified, count_if(balance > 980000) as conflicts, count_if(top < 8500000) as scoped, count_if(top < 9500000) as planned from m group by all)
select lm as "lmPcode", segment, ym as month, concat_ws('|', case when inspected <> n then 'CLASSIFICATION_INCOMPLETE' end, case when conflicts > 0 then 'CONFLICTS_OR_FAILURES' end, case when scoped <> n then 'MEMBERS_OUTSIDE_SCOPE' end, case when verified <> n then 'NOT_FULLY_VERIFIED' end,
  case when planned <> n then 'PLAN_EVIDENCE_MISSING' end, case when scoped <> n then 'SCOPE_INCOMPLETE' end) as issues from g""")
def month_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of four months for each municipality and segment, counted from the purchases: meters out of scope, unverified, unplanned or in conflict break the rules."""
    rows = purchases(spark, folder)
    firsts = rows.groupBy("meterNo").agg(F.min("ym").alias("firstMonth"))
    each = rows.where("ym between '1998-04' and '1998-07'").groupBy("lmPcode", "segment", F.col("ym").alias("month"), "meterNo", "balanceC").agg(F.max("amountTotalC").alias("top")).join(firsts, "meterNo")
    listed = lambda which: F.array_sort(F.collect_list(F.when(which, F.col("meterNo"))))
    made = each.groupBy("lmPcode", "segment", "month").agg(
        F.count("*").alias("rowsRead"), F.count_if(F.col("balanceC") > -95000).alias("inspected"), F.count_if(F.col("balanceC") >= -90000).alias("verified"), F.count_if(F.col("balanceC") > 980000).alias("conflicts"), F.count_if(F.col("top") < 9500000).alias("planRecords"),
        F.count_if(F.col("firstMonth") == F.col("month")).alias("created"), listed(F.lit(True)).alias("members"), listed(F.col("top") < 8500000).alias("scope"),
    )
    sha = lambda c: F.sha2(F.concat_ws("|", F.lit(c), "lmPcode", "segment", "month"), 256)
    waves = F.ceil(F.col("created") / 400).cast("bigint")
    told = made.withColumns({
        "snapshotSha256": sha("snapshot"), "populationSnapshotSha256": sha("snapshot"), "sourceSha256": sha("source"), "categoryPackageSha256": sha("package"), "preservedBefore": sha("kept"), "preservedAfter": sha("kept"), "recoverySha256": sha("recovery"), "planSha256": sha("plan"),
        "governedMonth": F.col("month"), "scopeSha256": F.sha2(F.to_json("scope"), 256), "replacements": F.array().cast("array<struct<predecessor: string, successor: string>>"), "complete": F.lit(True), "status": F.lit("PASS"), "result": F.lit("REFRESH_VERIFIED"), "preflightOnly": F.lit(False),
        "gatePassed": F.lit(True), "updated": F.lit(0), "unchanged": F.col("rowsRead") - F.col("created"), "failures": F.lit(0), "writeAttempts": F.col("created"), "writeSuccesses": F.col("created"), "wavesAttempted": waves, "wavesCommitted": waves, "verification": F.lit("PASS"), "recoveryRecords": F.col("rowsRead"),
    })
    return told.select("lmPcode", "segment", "month", F.array_join(F.array_sort(validate.reasons(evidence.executed_month_rules())), "|").alias("issues"))
