"""Queries on pairs of documents, purchases in their months, and a migration that is executed and verified."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import pipelines
from wattledger.operators import aggregates, documents, records, validate
from wattledger.plans.changes import BEFORE, CUT
from wattledger.plans.governance import _MASTER_DOC, _OLD_FAULTS, _fault, _filled, _ids, _sql_fault
from wattledger.plans.registry import query
from wattledger.plans.stores import _FILE, _place
from wattledger.plans.tables import FACTS, METERS, MONTHLY, meters, purchases
from wattledger.scratch import keep
from wattledger.sources import store

# what is written into the two documents of some meters, and the issue that it makes
_MASTER = {"meterNo": '{"raw":"@","normalized":"@"}', "lmPcode": '"LM"', "refs": '{"asts":{"id":"A"},"sales":{"id":"@","provider":"conlog"}}'}
_SALES = {"master": '{"id":"@","visibility":"VISIBLE"}', "meterNoNormalized": '"@"', "lmPcode": '"lm"', "provider": '"conlog"'}
_PAIR_FAULTS: dict[int, tuple[dict[str, str | None], dict[str, str | None], str]] = {
    1: ({"meterNo": '{"normalized":"X"}'}, {}, "MASTER_IDENTITY_MISMATCH"), 2: ({"meterNo": '"@"'}, {}, "MASTER_IDENTITY_MISMATCH"), 3: ({"lmPcode": '"XX"'}, {}, "MASTER_LM_MISMATCH"), 4: ({"refs": "[]"}, {}, "MASTER_REFS_INVALID"), 5: ({"refs": '{"sales":5}'}, {}, "MASTER_REFS_SHAPE_INVALID"),
    6: ({"refs": '{"sales":{"id":"X","provider":"conlog"}}'}, {}, "MASTER_SALES_ID_MISMATCH"), 7: ({"refs": '{"sales":{"id":"@","provider":"other"}}'}, {}, "MASTER_SALES_PROVIDER_MISMATCH"), 8: ({"refs": '{"asts":{"id":7},"sales":{"id":"@","provider":"conlog"}}'}, {}, "MASTER_AST_ID_NOT_STRING"),
    9: ({}, {"master": None}, "SALES_MASTER_MISSING"), 10: ({}, {"master": '{"id":"X","visibility":"VISIBLE"}'}, "SALES_MASTER_ID_MISMATCH"), 11: ({}, {"master": '{"id":"@","visibility":"HIDDEN"}'}, "SALES_VISIBILITY_INVALID"), 12: ({}, {"meterNoNormalized": "5"}, "SALES_IDENTITY_MISMATCH"),
    13: ({}, {"lmPcode": None}, "SALES_LM_MISMATCH"), 14: ({}, {"provider": '"x"'}, "SALES_PROVIDER_MISMATCH"),
}


@query(f"""with {METERS} select meter as "masterId", case when balance < -80000 then 'MASTER_MISSING' when segment = 'HOUSEHOLD' then 'SALES_MISSING' else {_sql_fault({n: f"'{code}'" for n, (_, _, code) in _PAIR_FAULTS.items()}, "null", 20)} end as issue,
  case when balance >= -80000 and segment <> 'HOUSEHOLD' then {_sql_fault({n: "null" for n in _PAIR_FAULTS}, "case when balance > 500000 then 'INVISIBLE' else 'VISIBLE' end", 20)} end as visibility from meters""")
def pair_identity(spark: SparkSession, folder: str) -> DataFrame:
    """Masters with their sales documents: what keeps two from being a pair, or the visibility that the master's references ask for."""
    whole = F.when(F.col("balanceC") > 500000, _filled(_MASTER | {"refs": '{"asts":{"id":" "},"sales":{"id":"@","provider":"CONLOG"}}'})).otherwise(_filled(_MASTER))
    master = _fault({n: _filled(_MASTER | m) for n, (m, _, _) in _PAIR_FAULTS.items()}, whole, 20)
    sales = _fault({n: _filled(_SALES | s) for n, (_, s, _) in _PAIR_FAULTS.items()}, _filled(_SALES), 20)
    rows = _ids(spark, folder).select("masterId", F.when(F.col("balanceC") >= -80000, master).alias("m"), F.when(F.col("segment") != "HOUSEHOLD", sales).alias("s"))
    return documents.pair_issues(rows, "m", "s", "masterId", "LM", "conlog").select("masterId", "issue", "visibility")


@query(f"""with {MONTHLY}, r as (select meter, ym, case when balance < -50000 then 0 else amount end as amount, case when balance > 900000 or balance < -50000 then null when segment = 'MACHINERY' then last_ms + 86400000 * cast(14 as bigint) else last_ms end as p from monthly join (select meter, balance, segment from meters) using (meter)),
j as (select meter, ym, concat_ws('|', case when ym not between '1993-01' and '1998-06' then 'month_not_approved' end, case when amount > 0 and p is null then 'purchase_missing' end, case when strftime(make_timestamp(p * 1000), '%Y-%m') <> ym then 'purchase_of_another_month' end) as reasons from r)
select meter as "meterNo", ym, reasons from j where reasons <> ''""")
def purchase_months(spark: SparkSession, folder: str) -> DataFrame:
    """Month rows outside the approved range, with an amount but no purchase, or with a purchase of another month."""
    known = meters(spark, folder).select("meterNo", "balanceC", "segment")
    rows = aggregates.monthly_meters(purchases(spark, folder)).join(known, "meterNo")
    last = F.timestamp_millis(F.when(F.col("segment") == "MACHINERY", F.col("lastPurchaseMs") + 86_400_000 * 14).otherwise(F.col("lastPurchaseMs")))
    purchase = F.when((F.col("balanceC") <= 900000) & (F.col("balanceC") >= -50000), last)
    amount = F.when(F.col("balanceC") < -50000, 0).otherwise(F.col("amountTotalC"))
    rules = validate.purchase_month_rules(amount, purchase, F.col("ym"), F.lit("1993-01"), F.lit("1998-06"))
    return rows.select("meterNo", "ym", F.array_join(validate.reasons(rules), "|").alias("reasons")).where("reasons <> ''")


_KEPT = {n: f for n, f in _OLD_FAULTS.items() if f[1] != "CONFLICT"}


@query(f"""with {METERS}, k as (select {_sql_fault({n: f"'{s}'" for n, (_, s, _) in _OLD_FAULTS.items()}, "'UNCHANGED'")} as state from meters)
select count_if(state <> 'CONFLICT') as planned, count_if(state = 'UPDATED') as updated, count_if(state = 'UNCHANGED') as unchanged, cast(0 as bigint) as conflict, true as written, cast(0 as bigint) as "left", cast(0 as bigint) as touched, 'PASS' as verdict from k""")
def migrated_store(spark: SparkSession, folder: str) -> DataFrame:
    """Old master documents of a store brought to their canonical form, but for those in conflict, and planned again: nothing is left to change."""
    doc = _fault({n: _filled(_MASTER_DOC | change) for n, (change, _, _) in _OLD_FAULTS.items()}, _filled(_MASTER_DOC))
    conflict = F.col("c_custkey") % 40
    old = _ids(spark, folder).where(~conflict.isin(*(n for n in _OLD_FAULTS if n not in _KEPT))).select("masterId", doc.alias("doc"))
    path = _place(spark, "migrated")
    store.create(old, path, "masterId", rows_per_file=_FILE)
    return pipelines.migrate_store(spark, path, "doc")


_SETS = f"""{FACTS}, k as (select distinct meter from facts where ym < '{CUT}'), p as (select distinct meter from facts where ym = '{BEFORE}'), c as (select distinct meter from facts where ym = '{CUT}'),
part as (select distinct meter from facts where segment = 'MACHINERY'), whole as (select distinct meter from facts),
n as (select (select count(*) from p) as previous, (select count(*) from c) as current, (select count(*) from p where meter in (select meter from c)) as unchanged, (select count(*) from p where meter in (select meter from c) and meter in (select meter from part)) as in_part,
  (select count(*) from c where meter not in (select meter from k)) as creates)"""


@query(f"""with {_SETS}, x as (select unchanged <> in_part as odd from n)
select 'short' as report, code from x, (values ('current_IMBALANCE'), ('previous_IMBALANCE'), ('unchanged_DIFFERS')) v(code) where odd
union all select 'forged', code from x, (values ('creates_IMBALANCE'), ('newCreates_DIFFERS')) v(code)""")
def declared_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Three reports of a month's population against the populations: a sound one, one that counts the unchanged of one segment only, and one with a number changed."""
    rows = purchases(spark, folder).select("meterNo", "ym", "segment")
    before, now, known = rows.where(F.col("ym") == BEFORE), rows.where(F.col("ym") == CUT), rows.where(F.col("ym") < CUT)
    pairs = rows.limit(0).select(F.col("meterNo").alias("predecessor"), F.col("meterNo").alias("successor"))
    accounts = keep(records.population_accounts(known, before, now, pairs), "accounts")
    sound = accounts.select(*records.ACCOUNTS)
    segment = lambda df: df.where("segment = 'MACHINERY'").select("meterNo").distinct()
    some = segment(before).join(segment(now), "meterNo", "left_semi").agg(F.count("*").alias("some"))
    short = sound.join(F.broadcast(some)).withColumn("unchanged", F.col("some")).drop("some")
    forged = sound.withColumn("newCreates", F.col("newCreates") + 1)
    named = lambda df, name: df.select(F.lit(name).alias("report"), *records.ACCOUNTS)
    return records.account_errors(named(sound, "sound").unionByName(named(short, "short")).unionByName(named(forged, "forged")), accounts)
