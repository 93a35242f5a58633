"""Queries on populations, links between sources, and plans that change a store of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators import aggregates, linkage, population, upsert, wide
from wattledger.plans.registry import query
from wattledger.plans.tables import FACTS, METERS, MONTHLY, PROVIDER, meter_text, meters, purchases, table
from wattledger.scratch import keep

CUT = "1998-06"
BEFORE = "1998-05"


def _active(spark: SparkSession, folder: str) -> DataFrame:
    return purchases(spark, folder).select("meterNo", "ym")


@query(f"""with {FACTS}, k as (select distinct meter from facts where ym < '{CUT}'), p as (select distinct meter from facts where ym = '{BEFORE}'), c as (select distinct meter from facts where ym = '{CUT}'),
ids as (select meter from p union select meter from c)
select meter as "meterNo", case when p.meter is not null and c.meter is not null then 'unchanged' when p.meter is not null then 'missing' when k.meter is not null then 'known_addition' else 'created' end as state
from ids left join p using (meter) left join c using (meter) left join k using (meter)""")
def snapshot_delta(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, folder)
    return population.snapshot_delta(rows.where(F.col("ym") < CUT), rows.where(F.col("ym") == BEFORE), rows.where(F.col("ym") == CUT))


@query(f"""with {FACTS}, s as (select distinct meter, ym from facts), nxt as (select meter, strftime(cast(ym || '-01' as date) + interval 1 month, '%Y-%m') as ym from s), firsts as (select meter, min(ym) as ym from s group by meter),
months as (select coalesce(s.ym, nxt.ym) as ym, count(s.meter) as members, count(*) filter (where s.meter is not null and nxt.meter is not null) as continuing, count(*) filter (where nxt.meter is null) as entered,
  count(*) filter (where s.meter is null) as exited from s full outer join nxt on s.meter = nxt.meter and s.ym = nxt.ym group by 1)
select ym, members, continuing, entered, exited, new_members, cast(sum(new_members) over (order by ym) as bigint) as known
from (select m.*, (select count(*) from firsts where firsts.ym = m.ym) as new_members from months m where members > 0)""")
def membership_movement(spark: SparkSession, folder: str) -> DataFrame:
    return population.movement(_active(spark, folder))


@query(f"""with {FACTS}, k as (select meter, min(ym) as first_month from facts where ym < '{CUT}' group by meter)
select meter as "meterNo", first_month as "firstMonth" from k union all select distinct meter, ym from facts where ym = '{CUT}' and meter not in (select meter from k)""")
def append_only_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, folder)
    first = lambda df: df.groupBy("meterNo").agg(F.min("ym").alias("firstMonth"))
    return population.append_only(first(rows.where(F.col("ym") < CUT)), first(rows.where(F.col("ym") == CUT)))


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each meter's first month, with the meter of the next lower number as the one it says it replaced."""
    rows = purchases(spark, folder).groupBy("meterNo", "c_custkey").agg(F.min("ym").alias("ym"))
    return rows.where("c_custkey > 0").withColumn("previousMeterNo", F.lpad((F.col("c_custkey") - 1).cast("string"), 11, "0"))


@query(f"""with {FACTS}, firsts as (select meter, c_custkey, min(ym) as ym from facts group by all), named as (select lpad(cast(c_custkey - 1 as varchar), 11, '0') as predecessor, meter as successor from firsts where ym >= '1996-01' and c_custkey > 0)
select predecessor, successor from named where predecessor in (select meter from facts where ym < '{CUT}') and predecessor not in (select meter from facts where ym = '{CUT}')""")
def replacement_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, folder)
    return population.replacements(_pairs(spark, folder).where("ym >= '1996-01'"), rows.where(F.col("ym") < CUT), rows.where(F.col("ym") == CUT))


@query(f"""with {FACTS}, s as (select distinct meter, ym from facts), firsts as (select meter, c_custkey, min(ym) as ym from facts group by all),
pairs as (select ym, lpad(cast(c_custkey - 1 as varchar), 11, '0') as predecessor, lpad(cast(greatest(c_custkey, 1) as varchar), 11, '0') as successor from firsts where c_custkey > 0)
select p.ym, p.predecessor, p.successor, 'PREDECESSOR_NOT_ACTIVE' as error from pairs p
where not exists (select 1 from s where s.meter = p.predecessor and s.ym = strftime(cast(p.ym || '-01' as date) - interval 1 month, '%Y-%m'))""")
def replacement_errors(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pairs(spark, folder).select("ym", F.col("previousMeterNo").alias("predecessor"), F.col("meterNo").alias("successor"))
    return population.replacement_errors(_active(spark, folder), pairs)


_HEADERS = f"""{FACTS}, h as (select ym, count(distinct meter) as members from facts where o_orderstatus = 'F' and segment = 'BUILDING' and o_totalprice > 490000 group by ym),
headers as (select ym, sha1(ym || '|' || members) as sha, members, lag(members) over (order by ym) as before, lag(sha1(ym || '|' || members)) over (order by ym) as prev, lag(ym) over (order by ym) as prev_ym from h)"""


@query(f"""with {_HEADERS} select ym, case when prev_ym <> strftime(cast(ym || '-01' as date) - interval 1 month, '%Y-%m') then 'MONTH_GAP' else 'BROKEN_CHAIN' end as error from headers
where prev_ym is not null and (prev_ym <> strftime(cast(ym || '-01' as date) - interval 1 month, '%Y-%m') or members < before)""")
def chain_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of months with large orders: months between are missing, and smaller months don't name the one before."""
    rows = purchases(spark, folder).join(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey").where("o_orderstatus = 'F' and segment = 'BUILDING' and o_totalprice > 490000")
    months = rows.groupBy("ym").agg(F.countDistinct("meterNo").alias("members")).withColumn("sha", F.sha1(F.concat("ym", F.lit("|"), F.col("members").cast("string")).cast("binary")))
    order = Window.orderBy("ym")  # a row for each month
    headers = months.withColumn("previousSha", F.when(F.col("members") >= F.lag("members").over(order), F.lag("sha").over(order)))
    return population.chain_errors(headers).select("ym", "error")


@query(f"""with {FACTS} select distinct meter as "meterNo" from facts where ym = '{CUT}' and meter in (select meter from facts where ym < '{CUT}')""")
def semi_join_known(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, folder)
    return rows.where(F.col("ym") == CUT).select("meterNo").distinct().join(rows.where(F.col("ym") < CUT).select("meterNo"), "meterNo", "left_semi")


@query(f"""with {METERS} select meter as "meterNo" from meters where c_custkey not in (select o_custkey from orders where strftime(o_orderdate, '%Y-%m') < '1997-01')""")
def anti_join_new(spark: SparkSession, folder: str) -> DataFrame:
    early = table(spark, folder, "orders").where(S.month_of("o_orderdate") < "1997-01").select(F.col("o_custkey").alias("c_custkey"))
    return meters(spark, folder).join(early, "c_custkey", "left_anti").select("meterNo")


@query(f"""with {FACTS} select meter as "meterNo", {", ".join(f"max(cast(ym = '1998-{m}' as integer)) as in_1998_{m}" for m in ("06", "07", "08"))} from facts group by meter""")
def history_membership(spark: SparkSession, folder: str) -> DataFrame:
    return population.history_membership(_active(spark, folder), ["1998-06", "1998-07", "1998-08"])


@query(f"""with {METERS} select meter as "meterNo" from meters where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F') and balance >= 0""")
def complete_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder)
    classified = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(meter_text("o_custkey").alias("meterNo"))
    return population.complete_exceptions(known, classified, known.where("balanceC < 0"))


@query("""with keys as (select distinct cast(p_partkey as varchar) as k from part), hits as (
  select k, s_name, 'EXACT_FORMAT' as rule from keys join supplier on cast(s_suppkey as varchar) = k union all select k, s_name, 'APPEND_ONE_TRAILING_ZERO' from keys join supplier on cast(s_suppkey as varchar) = k || '0')
select k as "gisKey", coalesce(array_to_string(list_sort(list(distinct s_name) filter (where s_name is not null)), '|'), '') as parcels,
  case when count(distinct rule) = 0 then 'NO_MATCH' when count(distinct rule) > 1 then 'MULTIPLE_COMPARISON_FORMATS' else min(rule) end as rule from keys left join hits using (k) group by k""")
def alt_key_join(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("gisKey"))
    lookup = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("gisKey"), F.col("s_name").alias("erfId"))
    return linkage.resolve_keys(keys, lookup).withColumn("parcels", F.array_join("parcels", "|"))


@query(f"""with {METERS}, canon as (select meter as id from meters union select cast(c_custkey as varchar) from meters where balance < 0), given as (select cast(p_partkey as varchar) as g from part),
bare as (select ltrim(id, '0') as b, count(*) as n, min(id) as sole from canon group by 1)
select g as given, case when g in (select id from canon) then g when n = 1 then sole end as canonical, case when g in (select id from canon) then 'EXACT' when n = 1 then 'ALIASED' when n > 1 then 'AMBIGUOUS' else 'UNMATCHED' end as match
from given left join bare on b = ltrim(g, '0')""")
def leading_zero_join(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder)
    canonical = known.select("meterNo").unionByName(known.where("balanceC < 0").select(F.col("c_custkey").cast("string").alias("meterNo")))
    return linkage.alias_join(table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("meterNo")), canonical)


_BRIDGE = f"""{METERS}, bridge as (select c_name as account, case when substr(o_orderpriority, 1, 1) = '1' then '' else substr(o_orderpriority, 1, 1) end as k from orders join customer on o_custkey = c_custkey where o_orderstatus = 'P' and o_totalprice > 350000),
acc as (select account, count(distinct k) filter (where k <> '') as nk, min(k) filter (where k <> '') as k from bridge group by account),
hits as (select k, n_name, rule from (select distinct k from acc where nk = 1) join (select cast(n_nationkey as varchar) as nk, n_name from nation where n_regionkey <> 0) x on true, (values ('EXACT_FORMAT', ''), ('APPEND_ONE_TRAILING_ZERO', '0')) r(rule, tail) where x.nk = k || tail),
res as (select k, count(distinct n_name) as n, min(n_name) as sole, case when count(distinct rule) > 1 then 'MULTIPLE_COMPARISON_FORMATS' else min(rule) end as rule from hits group by k),
linked as (select meter, case when balance < 0 then '' else name end as account, nk, res.n, sole, case when nk = 1 then coalesce(rule, 'NO_MATCH') else 'NONE' end as rule
  from meters left join acc on acc.account = case when balance < 0 then '' else name end left join res on res.k = acc.k and nk = 1),
detailed as (select *, case when account = '' then 'BLANK_ACCOUNT' when nk is null then 'ACCOUNT_NOT_IN_BRIDGE' when nk = 0 then 'ACCOUNT_HAS_NO_GIS_KEY' when nk > 1 then 'ACCOUNT_MULTIPLE_GIS_KEYS'
  when n is null then 'GIS_KEY_NOT_FOUND_IN_PIPELINE' when n > 1 then 'GIS_KEY_MULTIPLE_ERFS' else 'EXACT_ONE_TO_ONE' end as detail from linked)"""


def _bridge(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P' and o_totalprice > 350000")
    key = F.substring("o_orderpriority", 1, 1)
    named = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return named.select(F.col("c_name").alias("accountNo"), F.when(key == "1", "").otherwise(key).alias("gisKey"))


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder).select("meterNo", F.when(F.col("balanceC") < 0, "").otherwise(F.col("name")).alias("accountNo"))
    lookup = table(spark, folder, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").cast("string").alias("gisKey"), F.col("n_name").alias("erfId"))
    return linkage.link_meters(known, _bridge(spark, folder), lookup)


@query(f"""with {_BRIDGE} select meter as "meterNo", account as "accountNo", case when detail = 'EXACT_ONE_TO_ONE' then sole end as "erfId",
  case when detail = 'BLANK_ACCOUNT' then 'BLANK_ACCOUNT_NUMBER' when detail = 'ACCOUNT_NOT_IN_BRIDGE' then 'ACCOUNT_NOT_FOUND_IN_ELM' when detail in ('ACCOUNT_HAS_NO_GIS_KEY', 'GIS_KEY_NOT_FOUND_IN_PIPELINE') then 'ERF_NUMBER_NOT_FOUND_IN_PIPELINE_LOOKUP'
  when detail in ('ACCOUNT_MULTIPLE_GIS_KEYS', 'GIS_KEY_MULTIPLE_ERFS') then 'PARTIAL_ERF_LOOKUP_MATCH' else 'MATCHED_SINGLE_GPS' end as status, detail as "detailStatus", rule from detailed""")
def linkage_status(spark: SparkSession, folder: str) -> DataFrame:
    return _linked(spark, folder)


@query(f"""with {_BRIDGE} select detail as "detailStatus", count(*) as n from detailed group by detail""")
def one_to_one_assessment(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.histogram(_linked(spark, folder), "detailStatus")


@query(f"""with {_BRIDGE}, p as (select account, k, count(*) as n from bridge group by all), a as (select account, sum(n) as n, sum(case when k = '' then n else 0 end) as bk, count_if(k <> '') as keys, count(*) as pairs from p group by account)
select cast(sum(n) as bigint) as rows, cast(sum(case when account = '' then n else 0 end) as bigint) as blank_accounts, cast(sum(bk) as bigint) as blank_keys, cast(sum(pairs) as bigint) as distinct_pairs,
  cast(sum(n - pairs) as bigint) as repeated_rows, cast(count_if(account <> '' and keys > 1) as bigint) as accounts_with_several_keys from a""")
def bridge_profile(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.bridge_profile(_bridge(spark, folder))


@query(f"""with {METERS}, parcels as (select cast(n_nationkey as varchar) as id, case when n_regionkey = 1 then '' else 'K' || case when n_nationkey < 5 then 0 else n_nationkey end end as pk, n_name as no from nation),
uses as (select pk, count(*) as n from parcels where pk <> '' group by pk),
r as (select m.*, c_nationkey from meters m join customer using (c_custkey)),
j as (select r.*, p.id, p.pk, p.no, u.n, case when r.segment = 'FURNITURE' then 'X' else r.lm end as cno from r left join parcels p on p.id = case when r.segment = 'HOUSEHOLD' then '99' else cast(c_nationkey as varchar) end left join uses u on u.pk = p.pk),
w as (select meter, id, case when segment = 'BUILDING' then 'NO_SINGLE_AUTHORITATIVE_CANDIDATE' when balance < 0 then 'SOURCE_GPS_NOT_VALIDATED' when id is null then 'CANDIDATE_NOT_IN_AUTHORITATIVE_ERF_SOURCE'
  when pk = '' then 'AUTHORITATIVE_PARCEL_FIELDS_INCOMPLETE' when n <> 1 then 'AMBIGUOUS_AUTHORITATIVE_PARCEL_KEY' when balance > 900000 then 'CANDIDATE_LM_MISMATCH' when cno <> no then 'CANDIDATE_ERF_NUMBER_MISMATCH' end as reason from j)
select meter as "masterId", case when reason is null then id end as "erfId", reason from w""")
def parcel_evidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = meters(spark, folder).join(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    one = F.struct(
        F.when(F.col("segment") == "HOUSEHOLD", "99").otherwise(F.col("c_nationkey").cast("string")).alias("ErfId"), F.when(F.col("segment") == "FURNITURE", "X").otherwise(F.col("lmPcode")).alias("ErfNumber"),
        F.when(F.col("balanceC") > 900000, "OTHER").otherwise("LM").alias("LmPcode"),
    )
    given = rows.select(F.col("meterNo").alias("masterId"), F.when(F.col("segment") == "BUILDING", F.array(one, one)).otherwise(F.array(one)).alias("candidates"), (F.col("balanceC") >= 0).alias("hasUsableGps"))
    key = F.when(F.col("n_regionkey") == 1, "").otherwise(F.concat(F.lit("K"), F.when(F.col("n_nationkey") < 5, 0).otherwise(F.col("n_nationkey")).cast("string")))
    parcels = table(spark, folder, "nation").select(F.col("n_nationkey").cast("string").alias("erfId"), key.alias("parcelKey"), F.col("n_name").alias("erfNo"))
    return linkage.parcel_evidence(given, parcels, "LM")


# the store holds what was known before a month; what is expected holds everything, with some months changed
_STORE = f"""{FACTS}, om as (select meter, lm, ym, sum(amount) as amount from facts where ym < '{CUT}' group by all),
nm as (select meter, ym, sum(amount) as amount from facts where not (segment = 'MACHINERY' and l_returnflag = 'R' and l_discount > 0.08) group by all),
old as (select meter, lm, max(ym) as last, count(*) as months from om group by all), new as (select nm.meter, case when balance < -90000 then 'MOVED' else lm end as lm, max(ym) as last from nm join meters using (meter) group by all),
lost as (select om.meter, min(om.ym) as ym from om left join nm on nm.meter = om.meter and nm.ym = om.ym where nm.amount is distinct from om.amount group by om.meter),
added as (select nm.meter, count(*) as n from nm left join om on om.meter = nm.meter and om.ym = nm.ym where om.ym is null group by nm.meter),
judged as (select n.meter, case when o.meter is null then null when l.ym is not null then 'history monthlyTotalsC.' || l.ym when o.lm <> n.lm then 'lmPcode differs' end as reason, o.meter is not null as there,
  case when o.last <> n.last then 1 else 0 end as moved, coalesce(a.n, 0) as added, n.last, n.lm, o.last as old_last from new n left join old o using (meter) left join lost l using (meter) left join added a using (meter)),
plan as (select *, case when not there then 'CREATED' when reason is not null then 'CONFLICT' when moved + added > 0 then 'UPDATED' else 'UNCHANGED' end as state from judged)"""


def _documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(expected, existing): (meterNo, lmPcode, provider, lastMonth, monthlyTotalsC)."""
    rows = purchases(spark, folder)
    changed = (F.col("segment") == "MACHINERY") & (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08)
    # one pass over the purchases for both states
    sums = rows.groupBy("meterNo", "lmPcode", "balanceC", "ym").agg(F.count_if(~changed).alias("_kept"), F.sum(F.when(~changed, F.col("amountTotalC"))).cast("bigint").alias("_new"), F.sum("amountTotalC").cast("bigint").alias("_old"))
    months = keep(sums, "months")

    def documents(part: DataFrame, amount: str, place) -> DataFrame:
        grouped = part.groupBy("meterNo", "lmPcode", "balanceC").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ym", F.col(amount).alias("amountTotalC"))))).alias("monthlyTotalsC"), F.max("ym").alias("lastMonth"))
        return grouped.select("meterNo", place.alias("lmPcode"), F.lit(PROVIDER).alias("provider"), "lastMonth", "monthlyTotalsC")

    expected = documents(months.where("_kept > 0"), "_new", F.when(F.col("balanceC") < -90000, "MOVED").otherwise(F.col("lmPcode")))
    return expected, documents(months.where(F.col("ym") < CUT), "_old", F.col("lmPcode"))


def _plan(spark: SparkSession, folder: str, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """What has to happen to each document; ``sides`` are the two states, where the caller has them already."""
    return upsert.classify(*(sides or _documents(spark, folder)), "meterNo", ["lmPcode", "provider"], ["lastMonth"], ["monthlyTotalsC"])


@query(f"""with {_STORE} select meter as "meterNo", state as classification, reason from plan""")
def classify_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return _plan(spark, folder).select("meterNo", "classification", "reason")


@query(f"""with {_STORE}, patches as (select meter, 'lastMonth' as path, last as value from plan where state = 'UPDATED' and moved = 1
  union all select nm.meter, 'monthlyTotalsC.' || nm.ym, cast(nm.amount as varchar) from nm join plan on plan.meter = nm.meter and state = 'UPDATED' left join om on om.meter = nm.meter and om.ym = nm.ym where om.ym is null)
select meter as "meterNo", path, value from patches""")
def minimal_patch(spark: SparkSession, folder: str) -> DataFrame:
    return _plan(spark, folder).select("meterNo", F.explode("updates").alias("path", "value"))


@query(f"""with {_STORE} select count(*) as planned, count_if(state = 'CREATED') as created, count_if(state = 'UPDATED') as updated, count_if(state = 'UNCHANGED') as unchanged, count_if(state = 'CONFLICT') as conflict, count_if(state = 'CONFLICT') = 0 as may_write from plan""")
def global_gate(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.gate(_plan(spark, folder))


@query(f"""with {_STORE} select count(*) as expected, count_if(cast(meter as bigint) % 13 = 0) as missing, count_if(state = 'CONFLICT' and cast(meter as bigint) % 13 <> 0) as different, 'FAIL' as verdict from plan""")
def post_write_verify(spark: SparkSession, folder: str) -> DataFrame:
    """The store after the plan without its conflicts, and without some documents that were lost: only those differ from what was expected."""
    expected, existing = _documents(spark, folder)
    written = upsert.apply_plan(_plan(spark, folder), expected, existing, "meterNo").where(F.col("meterNo").cast("bigint") % 13 != 0)
    flat = lambda df: df.select("meterNo", "lmPcode", "lastMonth", F.to_json(F.array_sort(F.map_entries("monthlyTotalsC"))).alias("months"))
    return upsert.verify(flat(expected), flat(written), "meterNo", ["lmPcode", "lastMonth", "months"])


@query(f"""with {_STORE} select coalesce(new.meter, old.meter) as "meterNo", case when new.meter is null then 'EXTRA' when old.meter is null then 'MISSING' when old.lm = new.lm and old.last = new.last then 'MATCHING' else 'CONFLICT' end as state from new full outer join old using (meter)""")
def resume_state(spark: SparkSession, folder: str) -> DataFrame:
    expected, existing = _documents(spark, folder)
    return upsert.resume_state(expected, existing, "meterNo", ["lmPcode", "lastMonth"])


@query(f"""with {_STORE} select new.meter as "meterNo", case when old.meter is null then 'MISSING' when old.last = new.last then 'IDENTICAL' else 'DIFFERENT' end as state from new left join old using (meter)""")
def deploy_state(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.deploy_state(*_documents(spark, folder), "meterNo", ["lastMonth"])


@query(f"""with {_STORE} select new.meter as "meterNo", case when old.meter is null then 'CREATED' when old.lm <> new.lm then 'CONFLICT' when old.last <> new.last then 'UPDATED' else 'UNCHANGED' end as classification,
  case when old.meter is null then '' when old.lm <> new.lm then 'lmPcode' when old.last <> new.last then 'lastMonth' else '' end as fields from new left join old using (meter)""")
def monthly_refresh(spark: SparkSession, folder: str) -> DataFrame:
    found = upsert.refresh_monthly(*_documents(spark, folder), "meterNo", ["lmPcode", "provider"], ["lastMonth"])
    return found.withColumn("fields", F.array_join("fields", "|"))


@query(f"""with {FACTS}, o as (select meter, c_custkey, lm, segment, balance, min(ym) as first_month from facts group by all)
select meter as "masterId", case when first_month >= '1996-06' then 'CREATED' when segment = 'BUILDING' or balance < -90000 or (segment = 'FURNITURE' and balance > 500000) then 'CONFLICT' when balance < 0 or segment = 'HOUSEHOLD' then 'UPDATED' else 'UNCHANGED' end as classification,
  case when first_month >= '1996-06' then 'MM_MISSING' when segment = 'BUILDING' then 'MM_RAW_IDENTITY_CONFLICT' when balance < -90000 then 'MM_LM_CONFLICT' when segment = 'FURNITURE' and balance > 500000 then 'MM_SALES_REFERENCE_CONFLICT'
  when balance < 0 or segment = 'HOUSEHOLD' then 'MM_SALES_FIELDS_UPDATED' else 'MM_VALUES_UNCHANGED' end as code from o""")
def refresh_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = purchases(spark, folder).groupBy("meterNo", "lmPcode", "segment", "balanceC").agg(F.min("ym").alias("firstMonth"))
    id_ = F.col("meterNo")
    common = lambda raw, lm, customer, sales: rows.select(id_.alias("masterId"), raw.alias("meterNoRaw"), lm.alias("lmPcode"), F.lit("prepaid").alias("meterType"), customer.alias("customerNo"), F.lit("").alias("accountNo"), sales.alias("salesId"), F.when(sales != "", PROVIDER).otherwise("").alias("salesProvider"), id_.alias("meterNoNormalized"), "firstMonth")
    incoming = common(id_, F.when(F.col("balanceC") < -90000, "MOVED").otherwise(F.col("lmPcode")), F.when(F.col("balanceC") < 0, "NEW").otherwise(""), id_)
    sales = F.when((F.col("segment") == "FURNITURE") & (F.col("balanceC") > 500000), "OTHER").when(F.col("segment") == "HOUSEHOLD", "").otherwise(id_)
    existing = common(F.when(F.col("segment") == "BUILDING", F.concat(id_, F.lit("X"))).otherwise(id_), F.col("lmPcode"), F.lit("OLD"), sales).where("firstMonth < '1996-06'")
    return upsert.refresh_masters(incoming.drop("firstMonth"), existing.drop("firstMonth")).select("masterId", "classification", "code")


_CATEGORY = f"""{FACTS}, c as (select meter, ym, max(l_returnflag) as v from facts where ym in ('1998-04', '{BEFORE}', '{CUT}') group by all), held as (select distinct meter from c where ym < '{CUT}'),
incoming as (select meter, max(l_returnflag) as v from facts where ym <= '{CUT}' group by meter)"""


@query(f"""with {_CATEGORY}, stored as (select meter, v from c where ym = '{CUT}')
select i.meter as "meterNo", case when h.meter is null and s.meter is null then 'CONFLICT_MISSING_DOCUMENT' when b.meter is null then 'CONFLICT_MISSING_HISTORY' when s.meter is null then 'UPDATED' when s.v = i.v then 'UNCHANGED' else 'CONFLICT_DIFFERENT_VALUE' end as classification
from incoming i left join held h using (meter) left join stored s using (meter) left join (select meter from c where ym = '{BEFORE}') b using (meter)""")
def category_append(spark: SparkSession, folder: str) -> DataFrame:
    """Return flags as categories: stored for three months, and a new value for the last of them."""
    rows = purchases(spark, folder).select("meterNo", "ym", "l_returnflag")
    months = rows.where(F.col("ym").isin("1998-04", BEFORE, CUT)).groupBy("meterNo", "ym").agg(F.max("l_returnflag").alias("v"))
    history = months.groupBy("meterNo").agg(F.map_from_entries(F.collect_list(F.struct("ym", "v"))).alias("months"))
    return upsert.append_categories(history, rows.where(F.col("ym") <= CUT).groupBy("meterNo").agg(F.max("l_returnflag").alias("value")), CUT, [BEFORE])


@query(f"""with {METERS} select meter as "masterId", case when balance > 900000 then 'MISSING' when segment = 'BUILDING' then 'IDENTITY_CONFLICT' when balance < -50000 then 'NON_ADR_CONFLICT' when segment = 'MACHINERY' then 'UPDATE_MISSING_ADR' when segment = 'FURNITURE' then 'ADR_CONFLICT' else 'MATCHING' end as classification from meters""")
def address_alignment(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder)
    adr = lambda name: F.struct(F.lit("1").alias("strNo"), name.alias("strName"), F.lit("Street").alias("strType"))
    expected = known.select(F.col("meterNo").alias("masterId"), F.col("lmPcode").alias("identity"), F.lit("a").alias("other"), adr(F.col("name")).alias("adr"))
    stored = known.where("balanceC <= 900000").select(
        F.col("meterNo").alias("masterId"), F.when(F.col("segment") == "BUILDING", "X").otherwise(F.col("lmPcode")).alias("identity"), F.when(F.col("balanceC") < -50000, "b").otherwise("a").alias("other"),
        F.when(F.col("segment") != "MACHINERY", F.when(F.col("segment") == "FURNITURE", adr(F.lit("Other"))).otherwise(adr(F.col("name")))).alias("adr"),
    )
    return upsert.align_addresses(expected, stored)


@query(f"""with {METERS}, s as (select meter, case when segment = 'BUILDING' then 'HIDDEN' when balance > 0 then 'VISIBLE' else 'INVISIBLE' end as v from meters where segment <> 'MACHINERY')
select m.meter as "masterId", case when segment <> 'FURNITURE' and balance >= 0 then 'VISIBLE' else 'INVISIBLE' end as wanted, case when s.meter is null then 'SALES_MISSING' when v = 'HIDDEN' then 'INVALID_VISIBILITY'
  when v = (case when segment <> 'FURNITURE' and balance >= 0 then 'VISIBLE' else 'INVISIBLE' end) then 'UNCHANGED' else 'UPDATED' end as outcome from meters m left join s using (meter)""")
def visibility_pairs(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder)
    masters = known.select(F.col("meterNo").alias("masterId"), F.when(F.col("segment") != "FURNITURE", "ast").otherwise("").alias("astId"), F.when(F.col("balanceC") >= 0, F.col("meterNo")).alias("salesId"))
    sales = known.where("segment <> 'MACHINERY'").select(F.col("meterNo").alias("masterId"), F.when(F.col("segment") == "BUILDING", "HIDDEN").when(F.col("balanceC") > 0, "VISIBLE").otherwise("INVISIBLE").alias("visibility"))
    return upsert.reconcile_visibility(masters, sales)


@query(f"""with {METERS}, judged as (select meter as "masterId", segment, case when c_custkey % 50 = 8 then 'NOT_IN_PLAN' when c_custkey % 50 = 7 then 'BEFORE_IMAGE_MISSING' when c_custkey % 50 = 9 then 'CURRENT_STATE_MISSING' when segment = 'BUILDING' then 'CREATED_DOCUMENT_REQUIRES_MANUAL_REVIEW_NO_DELETE' when segment = 'HOUSEHOLD' then 'NOTHING_WRITTEN' when balance > 900000 then 'EXISTENCE_CHANGED'
  when balance < -50000 then 'BEFORE_IMAGE_VERSION_MISMATCH' when balance between 400000 and 700000 then 'OVERLAPPING_PATHS' when segment = 'FURNITURE' then 'CURRENT_STATE_DIFFERS_FROM_PLANNED_WRITE' else 'RESTORE' end as outcome from meters)
select "masterId", outcome, case when outcome = 'RESTORE' then 'lastMonth={BEFORE}' end as restore, case when outcome = 'RESTORE' then 'monthlyTotalsC.{CUT}' end as deletes, case when outcome like 'CURRENT_STATE_DIFFERS%' then 'monthlyTotalsC.{CUT}' end as paths from judged""")
def recovery_plan(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder).withColumnRenamed("meterNo", "masterId")
    text = lambda **kv: F.create_map(*(x for k, v in kv.items() for x in (F.lit(k.replace("__", ".").replace("MM", CUT)), v)))
    before = known.select("masterId", text(lastMonth=F.lit(BEFORE)).alias("fields"), F.when(F.col("balanceC") < -50000, "v0").otherwise("v1").alias("token"))
    kind = F.when(F.col("segment") == "BUILDING", "CREATED").when(F.col("segment") == "HOUSEHOLD", "UNCHANGED").otherwise("UPDATED")
    plain, over = text(lastMonth=F.lit(CUT), monthlyTotalsC__MM=F.lit("5")), text(lastMonth=F.lit(CUT), monthlyTotalsC__MM=F.lit("5"), monthlyTotalsC=F.lit("{}"))
    plan = known.select("masterId", kind.alias("classification"), F.lit("v1").alias("token"), F.when(F.col("balanceC").between(400000, 700000), over).otherwise(plain).alias("patch"), "c_custkey")
    now = text(lastMonth=F.lit(CUT), monthlyTotalsC__MM=F.when(F.col("segment") == "FURNITURE", "6").otherwise("5"))
    current = known.select("masterId", F.when(F.col("balanceC") <= 900000, now).alias("fields"))
    without = lambda df, rest: df.join(known.where(F.col("c_custkey") % 50 == rest).select("masterId"), "masterId", "left_anti")  # noqa: E731  each side lacks some ids
    found = upsert.recovery(without(before, 7), without(plan.drop("c_custkey"), 8), without(current, 9))
    restore = F.array_join(F.transform(F.array_sort(F.map_entries("restore")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return found.select("masterId", "outcome", restore.alias("restore"), F.array_join("deletes", "|").alias("deletes"), F.array_join("paths", "|").alias("paths"))


@query(f"""with {FACTS}, o as (select meter, sum(amount) as v from facts where ym < '{CUT}' group by meter), n as (select meter, sum(amount) as v from facts where ym <= '2000-01' and segment <> 'BUILDING' group by meter)
select count_if(o.meter is not null and n.meter is not null and o.v <> n.v) as changed, count_if(o.meter is null) as added, count_if(n.meter is null) as removed from o full outer join n using (meter)""")
def value_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = purchases(spark, folder)
    total = lambda df: df.groupBy("meterNo").agg(F.sum("amountTotalC").cast("bigint").alias("v"))
    return aggregates.value_changes(total(rows.where(F.col("ym") < CUT)), total(rows.where("ym <= '2000-01' and segment <> 'BUILDING'")), "meterNo", "v")


@query(f"""with {FACTS}, plan as (select meter, max(ym) as token from facts where ym < '{CUT}' group by meter), store as (select meter, max(ym) as token from facts where ym < '1999-01' group by meter)
select plan.meter as "meterNo", case when store.token <> plan.token then 'CONFLICT' else 'UPDATED' end as classification from plan left join store using (meter)""")
def version_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, folder)
    token = lambda df: df.groupBy("meterNo").agg(F.max("ym").alias("token"))
    plan = token(rows.where(F.col("ym") < CUT)).withColumn("classification", F.lit("UPDATED"))
    return upsert.check_versions(plan, token(rows.where("ym < '1999-01'")), "meterNo").select("meterNo", "classification")
