"""Queries from raw rows to atomic facts, monthly sales at three grains, month profiles and the meter master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.functions import scalars as S
from wattledger.operators import aggregates, entities, facts, reconcile, validate, wide
from wattledger.plans.registry import query
from wattledger.plans.tables import FACTS, GROUP_ID, GROUP_LABEL, METERS, MONTHLY, PROVIDER, meter_text, meters, purchases, table

YEAR = [f"1997-{m:02d}" for m in range(1, 13)]
AS_OF = "2001-12-31"


@query(f"""with {FACTS}, hashed as (select *, sha1(concat_ws('|', '{PROVIDER}', lm, meter, iso, amount, cost, vat)) as h from facts),
nth as (select *, row_number() over (partition by h order by l_orderkey) as nth from hashed)
select case when nth = 1 then h else h || '__' || nth end as "atomicId", lm as "lmPcode", meter as "meterNo", iso as "txAtISO", ms as "txAtMs", ym, cast(year(o_orderdate) as bigint) as y,
  cast(month(o_orderdate) as bigint) as m, amount as "amountTotalC", cost as "costC", vat as "vatC" from nth""")
def atomic_facts(spark: SparkSession, folder: str) -> DataFrame:
    rows = facts.with_atomic_ids(purchases(spark, folder), ["l_orderkey"])
    return rows.select("atomicId", "lmPcode", "meterNo", "txAtISO", "txAtMs", "ym", "y", "m", "amountTotalC", "costC", "vatC")


@query(f"""with {FACTS}, nth as (select *, sha1(concat_ws('|', lm, meter, ym)) as h, row_number() over (partition by lm, meter, ym order by ms, amount, cost) as nth from facts)
select case when nth = 1 then h else h || '__' || nth end as id, meter as "meterNo", iso as "txAtISO", amount as "amountTotalC", cost as "costC" from nth""")
def duplicate_suffix(spark: SparkSession, folder: str) -> DataFrame:
    rows = facts.with_atomic_ids(purchases(spark, folder), ["txAtMs", "amountTotalC", "costC"], ("lmPcode", "meterNo", "ym"))
    return rows.select(F.col("atomicId").alias("id"), "meterNo", "txAtISO", "amountTotalC", "costC")


@query(f"""with {FACTS} select ym, meter as "meterNo", amount as "amountTotalC" from facts where ym = '1998-06'""")
def month_query(spark: SparkSession, folder: str) -> DataFrame:
    """The month's filter reaches the scan as a range of order dates."""
    day = F.col("_t")
    rows = purchases(spark, folder).where((day >= F.lit("1998-06-01").cast("timestamp")) & (day < F.lit("1998-07-01").cast("timestamp")))
    return rows.select("ym", "meterNo", "amountTotalC")


_MONTHLY_OUT = """lm as "lmPcode", ym, cast(sum(n) as bigint) as "purchasesCount", cast(sum(amount) as bigint) as "amountTotalC", cast(sum(cost) as bigint) as "costC", cast(sum(vat) as bigint) as "vatC",
  min(first_ms) as "firstPurchaseMs", max(last_ms) as "lastPurchaseMs" """


@query(f"""with {MONTHLY} select lm || '__' || meter || '__' || ym as id, lm as "lmPcode", meter as "meterNo", ym, n as "purchasesCount", amount as "amountTotalC", cost as "costC", vat as "vatC",
  first_ms as "firstPurchaseMs", last_ms as "lastPurchaseMs", {GROUP_ID.format("amount")} as "salesGroupId", {GROUP_LABEL.format("amount")} as "salesGroupLabel",
  strftime(make_timestamp(first_ms * 1000), '%Y-%m-%dT%H:%M:%SZ') as "firstPurchaseISO", strftime(make_timestamp(last_ms * 1000), '%Y-%m-%dT%H:%M:%SZ') as "lastPurchaseISO" from monthly""")
def monthly_meter_sales(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_meters(purchases(spark, folder))


@query(f"""with {MONTHLY} select lm || '__' || ym as id, count(*) as "metersCount", {_MONTHLY_OUT} from monthly group by lm, ym""")
def monthly_lm_sales(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_municipalities(purchases(spark, folder))


@query(f"""with {MONTHLY}, g as (select *, {GROUP_ID.format("amount")} as gid, {GROUP_LABEL.format("amount")} as label from monthly)
select lm || '__' || ym || '__' || gid as id, gid as "salesGroupId", label as "salesGroupLabel", count(*) as "metersCount", {_MONTHLY_OUT} from g group by lm, ym, gid, label""")
def monthly_lm_groups(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_groups(aggregates.monthly_meters(purchases(spark, folder)))


@query(f"""with {MONTHLY} select {GROUP_ID.format("amount")} as "salesGroupId", count(*) as n from monthly group by 1""")
def segment_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.histogram(aggregates.monthly_meters(purchases(spark, folder)), "salesGroupId")


_DENSE = f"""{MONTHLY}, months as (select unnest({YEAR!r}) as ym),
dense as (select m.lm, m.meter, months.ym, coalesce(x.amount, 0) as amount from meters m cross join months left join monthly x on x.meter = m.meter and x.ym = months.ym)"""


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    monthly = aggregates.monthly_meters(purchases(spark, folder).where(F.col("ym").between(YEAR[0], YEAR[-1])))
    return wide.dense_months(meters(spark, folder), monthly, YEAR[0], YEAR[-1])


@query(f"""with {_DENSE} select meter as "meterNo", ym, amount as "amountTotalC" from dense""")
def densified_months(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder).select("meterNo", "ym", "amountTotalC")


def _source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Dense months as monthly-source rows: units are one tenth of the rand amount, with one decimal."""
    rows = _dense(spark, folder).join(meters(spark, folder).select("meterNo", "lmPcode"), "meterNo")
    return rows.withColumn("unitsTotal", F.round(F.col("amountTotalC").cast("decimal(18,0)") / 1000, 1).cast("decimal(18,1)"))


_UNITS = "cast(sum(cast((amount + 50) // 100 as bigint)) / 10.0 as decimal(28,1))"


@query(f"""with {_DENSE} select lm as "lmPcode", ym, count(*) as "metersCount", cast(sum(amount) as bigint) as "amountTotalC", {_UNITS} as "unitsTotal", count_if(amount = 0) as "zeroSalesMetersCount" from dense group by lm, ym""")
def zero_sales_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.source_municipalities(_source_rows(spark, folder))


@query(f"""with {_DENSE} select lm as "lmPcode", ym, {GROUP_ID.format("amount")} as "salesGroupId", {GROUP_LABEL.format("amount")} as "salesGroupLabel", count(*) as "metersCount", cast(sum(amount) as bigint) as "amountTotalC",
  {_UNITS} as "unitsTotal", count_if(amount = 0) as "zeroSalesMetersCount" from dense group by all""")
def source_group_rows(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.source_groups(_source_rows(spark, folder))


@query(f"""with {_DENSE} select ym, count_if(amount > 0) as purchasing, count_if(amount = 0) as not_purchasing, cast(sum(amount) as bigint) as "amountTotalC" from dense group by ym""")
def purchasing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder).groupBy("ym").agg(F.count_if(F.col("amountTotalC") > 0).alias("purchasing"), F.count_if(F.col("amountTotalC") == 0).alias("not_purchasing"), F.sum("amountTotalC").cast("bigint").alias("amountTotalC"))


@query(f"""with {FACTS}, c as (select lm, meter, ym, count(*) as k from facts group by all) select lm as "lmPcode", cast(sum(k) as bigint) as rows, cast(sum(k - 1) as bigint) as duplicate_rows from c group by lm""")
def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.duplicate_rows(purchases(spark, folder), ["lmPcode"], ["meterNo", "ym"])


@query(f"""with {FACTS} select meter as "meterNo", ym, count(*) as copies from facts group by all having count(*) > 1""")
def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.duplicate_groups(purchases(spark, folder), ["meterNo", "ym"])


@query("""select o_orderstatus as status, o_orderpriority as priority, count(*) as n from orders group by all""")
def status_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.histogram(table(spark, folder, "orders"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


# a portal export with faults that follow from the data
_RAW = f"""{FACTS}, money as (select *, printf('%d.%02d', amount // 100, amount % 100) as amount_t, printf('%d.%02d', cost // 100, cost % 100) as cost_t,
  printf('%d.%02d', vat // 100, vat % 100) as vat_t from facts),
judged as (select *, array_to_string(list_filter([
  case when l_returnflag = 'R' and l_linenumber = 1 then 'invalid_transaction_datetime' end,
  case when not (l_returnflag = 'R' and l_linenumber = 1) and ym <> strftime(l_shipdate, '%Y-%m') then 'transaction_month_mismatch' end,
  case when balance < 0 then 'blank_meter_number' end,
  case when l_linestatus = 'F' and balance < 0 then 'meter_group_mismatch' end,
  case when pct = 0 then 'invalid_vat' end,
  case when l_discount > 0.09 then 'non_zero_refund_requires_separate_design' end,
  case when pct <> 0 and l_quantity >= 49 then 'amount_cost_vat_reconciliation_failed' end], lambda x: x is not null), ';') as reason from money)"""


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    rand = lambda c: F.format_string("%d.%02d", F.expr(f"{c} div 100"), F.expr(f"{c} % 100"))
    rows = purchases(spark, folder)
    bad_time = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return rows.select(
        "l_orderkey", "l_linenumber", "meterNo", "lmPcode", S.month_of("l_shipdate").alias("_month"), "amountTotalC",
        F.when(bad_time, "no time").otherwise(F.date_format("_t", "d/M/yyyy H:mm")).alias("TransactionDateTime_2"),
        F.when(F.col("l_linestatus") == "F", F.col("meterNo")).otherwise("").alias("CDUToggle"), F.when(F.col("balanceC") >= 0, F.col("meterNo")).alias("VendingNo_3"),
        F.concat(F.lit("R "), rand("amountTotalC")).alias("Amount"), F.when(F.col("l_discount") > 0.09, "5").otherwise("0,00").alias("RefundAmount"),
        F.when(F.col("l_quantity") >= 49, rand("(costC + 100)")).otherwise(rand("costC")).alias("CostOfUnits_2"), F.when(F.expr("round(cast(l_tax as decimal(18,4)) * 100, 0) = 0"), "n/a").otherwise(rand("vatC")).alias("VAT"),
    )


@query(f"""with {_RAW} select l_orderkey as "orderKey", amount as "amountTotalC", reason as "rejectReason" from judged where reason <> ''""")
def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    bad = validate.split(_raw(spark, folder), validate.portal_rules(F.col("_month"))).rejected
    return bad.select(F.col("l_orderkey").alias("orderKey"), "amountTotalC", "rejectReason")


@query(f"""with {_RAW} select lm as "lmPcode", count(*) as rows, cast(sum(amount) as bigint) as "amountTotalC" from judged where reason = '' group by lm""")
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    good = validate.split(_raw(spark, folder), validate.portal_rules(F.col("_month"))).valid
    return good.groupBy("lmPcode").agg(F.count("*").alias("rows"), F.sum("amountTotalC").cast("bigint").alias("amountTotalC"))


@query(f"""with {FACTS} select cast(count_if(lm <> 'NATION_1') as bigint) as other_municipality, cast(count_if(ym <> '1998-06') as bigint) as other_month, cast(count_if(c_custkey % 5 = 0) as bigint) as parts_differ, cast(count_if(c_custkey % 7 = 0) as bigint) as time_differs,
  cast(count_if(c_custkey % 8 = 0) as bigint) as money_differs, cast(count_if(c_custkey % 8 = 0 and cost - amount - 1 < 0) as bigint) as negative, cast(count_if(c_custkey % 9 = 0) as bigint) as blank_meter from facts""")
def dataset_assertions(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with a fault of each kind, by the meter's number."""
    n = F.col("c_custkey")
    rows = purchases(spark, folder).withColumns({
        "y": F.when(n % 5 == 0, F.col("y") + 1).otherwise(F.col("y")), "txAtMs": F.when(n % 7 == 0, F.col("txAtMs") + 1).otherwise(F.col("txAtMs")), "costC": F.when(n % 8 == 0, F.col("costC") - F.col("amountTotalC") - 1).otherwise(F.col("costC")),
        "meterNo": F.when(n % 9 == 0, " ").otherwise(F.col("meterNo")),
    })
    return validate.assertions(rows, facts.fact_checks("NATION_1", "1998-06"))


@query(f"""with {FACTS}, c as (select meter, ym, count(*) as k from facts group by all) select cast(sum(k) as bigint) as rows, cast(sum(k - 1) as bigint) as duplicates, true as "vendingProviderId_constant", (select min(lm) = max(lm) from facts) as "lmPcode_constant" from c""")
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    return validate.profile(purchases(spark, folder), ["meterNo", "ym"], ["vendingProviderId", "lmPcode"])


_SALES_ALL = f"""{MONTHLY}, sums as (select meter, cast(sum(amount) as bigint) as total, max(ym) as last_month, max(last_ms) as last_ms from monthly where ym <= '1996-06' group by meter),
everyone as (select m.meter, coalesce(s.total, 0) as total, s.last_month, cast(make_timestamp(s.last_ms * 1000) as date) as day from meters m left join sums s using (meter))"""


def _sales_all(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    """Profiles from the sales until June 1996, so that some meters never bought."""
    monthly = aggregates.monthly_meters(purchases(spark, folder).where("ym <= '1996-06'"))
    return wide.sales_all(meters(spark, folder), monthly, as_of)


@query(f"""with {_SALES_ALL} select meter as "meterNo", total as "totalC", last_month as "lastMonth", strftime(day, '%Y-%m-%d') as "lastPurchaseDate", cast(date_diff('day', day, date '{AS_OF}') as integer) as "daysSinceLastPurchase" from everyone""")
def days_since_last_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return _sales_all(spark, folder, AS_OF).select("meterNo", "totalC", "lastMonth", "lastPurchaseDate", "daysSinceLastPurchase")


@query(f"""with {_SALES_ALL} select cast(count_if(total = 0 and cast(meter as bigint) % 3 = 0) as bigint) as recency_without_sales, cast(count_if(total > 0 and cast(meter as bigint) % 7 = 0) as bigint) as sales_without_recency,
  cast(count_if(total > 0 and (cast(meter as bigint) % 7 = 0 or cast(meter as bigint) % 11 = 0)) as bigint) as last_month_mismatch, cast(count_if(day > date '1996-01-01') as bigint) as negative_days from everyone""")
def recency_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Recency as of a day before the last purchases breaks the rule on negative days; the other rules are broken by the meter's number."""
    n, sold = F.col("c_custkey"), F.col("totalC") > 0
    rows = _sales_all(spark, folder, "1996-01-01").withColumns({
        "lastMonth": F.when(sold & (n % 7 == 0), None).when(sold & (n % 11 == 0), "1990-01").otherwise(F.col("lastMonth")), "daysSinceLastPurchase": F.when(~sold & (n % 3 == 0), 1).otherwise(F.col("daysSinceLastPurchase")),
    })
    positive = F.array_max(F.map_keys(F.map_filter("monthlyTotalsC", lambda k, v: v > 0)))
    rules = validate.recency_rules(F.col("totalC"), F.col("lastMonth"), positive, F.col("daysSinceLastPurchase"))
    return validate.assertions(rows, dict(rules))


@query(f"""with {_SALES_ALL} select meter as "meterNo", total as "mapTotalC", (select count(*) from monthly x where x.meter = everyone.meter and x.ym <= '1996-06') as months, total as "totalC" from everyone""")
def sales_all_map_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales_all(spark, folder, AS_OF)
    return rows.select("meterNo", M.map_total(F.col("monthlyTotalsC")).alias("mapTotalC"), F.size("monthlyTotalsC").cast("bigint").alias("months"), "totalC")


@query(f"""with {MONTHLY} select meter as "meterNo", {", ".join(f"cast(coalesce(sum(amount) filter (where ym = '{m}'), 0) as bigint) as {M.month_column(m)}" for m in YEAR)} from monthly group by meter""")
def sales_all_wide(spark: SparkSession, folder: str) -> DataFrame:
    return wide.pivot_months(aggregates.monthly_meters(purchases(spark, folder)), YEAR)


@query(f"""with {MONTHLY} select meter as "meterNo", ym, amount as "amountTotalC" from monthly""")
def unpivot_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months to maps and back to rows."""
    maps = wide.month_maps(aggregates.monthly_meters(purchases(spark, folder)))
    return M.unpivot(maps, ["meterNo"], {"monthlyTotalsC": "amountTotalC"})


@query(f"""with {MONTHLY}, a as (select lm, ym, sum(n) as n, count(*) as meters, sum(amount) as amount, sum(cost) as cost, sum(vat) as vat from monthly group by all),
b as (select lm, ym, count(*) as n, count(distinct meter) as meters, sum(amount) as amount, sum(cost) as cost, sum(vat) as vat from facts where vat > 0 group by all)
select lm as "lmPcode", ym, case when b.n is null then 'left_only' when a.n is null then 'right_only' else 'both' end as side,
  array_to_string(list_filter([case when a.n is distinct from b.n then 'purchasesCount' end, case when a.meters is distinct from b.meters then 'metersCount' end, case when a.amount is distinct from b.amount then 'amountTotalC' end,
  case when a.cost is distinct from b.cost then 'costC' end, case when a.vat is distinct from b.vat then 'vatC' end], lambda x: x is not null), ';') as differs
from a full outer join b using (lm, ym) where a.n is null or b.n is null or (a.n, a.meters, a.amount, a.cost, a.vat) is distinct from (b.n, b.meters, b.amount, b.cost, b.vat)""")
def rollup_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """All purchases by meter against municipality rows that lack the purchases without tax."""
    rows = purchases(spark, folder)
    left = reconcile._up(aggregates.monthly_meters(rows), F.count("*"))
    found = reconcile.compare(left, aggregates.monthly_municipalities(rows.where("vatC > 0")), ["lmPcode", "ym"], reconcile.MEASURES)
    return found.withColumn("differs", F.array_join("differs", ";"))


@query(f"""with {MONTHLY} select lm as "lmPcode", ym, 'groups' as against from monthly group by lm, ym having count_if({GROUP_ID.format("amount")} = 'GR5' and lm like '%1%') > 0""")
def rollup_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """The three grains of the same purchases agree but where group rows were taken out."""
    rows = purchases(spark, folder)
    monthly = aggregates.monthly_meters(rows)
    groups = aggregates.monthly_groups(monthly).where(~((F.col("salesGroupId") == "GR5") & F.col("lmPcode").contains("1")))
    return reconcile.rollup_differences(monthly, aggregates.monthly_municipalities(rows), groups).select("lmPcode", "ym", "against")


@query(f"""with {FACTS} select lm as "lmPcode", ym, count(*) as n, cast(sum(amount) as bigint) as "amountTotalC" from facts group by grouping sets ((lm, ym), (lm), ())""")
def grouping_sets_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return purchases(spark, folder).groupingSets([["lmPcode", "ym"], ["lmPcode"], []], "lmPcode", "ym").agg(F.count("*").alias("n"), F.sum("amountTotalC").cast("bigint").alias("amountTotalC"))


@query(f"""with {FACTS}, h as (select sha256({" || ".join(f"length({c}) || ':' || {c}" for c in ("lm", "meter", "iso", "cast(amount as varchar)"))}) as h from facts)
select count(*) as rows, concat_ws('-', {", ".join(f"cast(sum(cast(('0x' || substr(h, {8 * i + 1}, 8)) as bigint)) as varchar)" for i in range(8))}) as digest from h""")
def dataset_digest(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.digest(purchases(spark, folder), ["lmPcode", "meterNo", "txAtISO", "amountTotalC"])


_LISTED = """listed as (select lpad(cast(o_custkey as varchar), 11, '0') as meter, o_orderkey,
  case o_orderstatus when 'P' then lpad(cast(o_custkey as varchar), 11, '0') when 'F' then 'C' || o_custkey else 'C' || o_custkey || '-' || substr(o_orderpriority, 1, 1) end as customer,
  case substr(o_orderpriority, 1, 1) when '1' then 'ACTIVE' when '2' then 'BLOCK PURCHASES' else '' end as status, strftime(o_orderdate, '%Y-%m-%d') as day from orders)"""


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of a customer file that lists a meter several times, with placeholders and other numbers."""
    orders = table(spark, folder, "orders").withColumn("meterNo", meter_text("o_custkey"))
    kind = F.substring("o_orderpriority", 1, 1)
    plain = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    number = F.when(F.col("o_orderstatus") == "P", F.col("meterNo")).when(F.col("o_orderstatus") == "F", plain).otherwise(F.concat(plain, F.lit("-"), kind))
    return orders.select(
        "meterNo", F.col("meterNo").alias("meterNoRaw"), number.alias("customerNo"), number.alias("accountNo"), F.when(kind == "1", "ACTIVE").when(kind == "2", "BLOCK PURCHASES").otherwise("").alias("accountStatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastPurchaseDate"), F.col("o_orderkey").alias("sourceRow"),
    )


@query(f"""with recursive {_LISTED}, r as (select *, row_number() over (partition by meter order by o_orderkey) as rn from listed),
f as (select meter, rn, customer, status, day, 0 as p, 0 as a, 0 as l, 0 as e from r where rn = 1
  union all
  select meter, rn, case when rule like '%take' then customer2 else customer end, case when rule like '%take' then status2 else status end,
    case when rule like '%take' then day2 when rule = 'merged' and day2 > day then day2 else day end,
    p + cast(rule like 'placeholder%' as integer), a + cast(rule like 'active%' as integer), l + cast(rule like 'latest%' as integer), e + cast(rule = 'error' as integer)
  from (select f.meter, r.rn, f.customer, f.status, f.day, f.p, f.a, f.l, f.e, r.customer as customer2, r.status as status2, r.day as day2,
    case when f.customer = r.customer then 'merged' when f.customer = f.meter and r.customer <> f.meter then 'placeholder_take' when f.customer <> f.meter and r.customer = f.meter then 'placeholder_keep'
      when f.status = 'ACTIVE' and r.status = 'BLOCK PURCHASES' then 'active_keep' when f.status = 'BLOCK PURCHASES' and r.status = 'ACTIVE' then 'active_take'
      when f.day = r.day then 'error' when r.day > f.day then 'latest_take' else 'latest_keep' end as rule
    from f join r on r.meter = f.meter and r.rn = f.rn + 1))
select meter as "meterNo", customer as "customerNo", customer as "accountNo", status as "accountStatus", day as "lastPurchaseDate", cast(rn as integer) as listed, p as placeholder, a as active, l as latest, e as errors
from f qualify row_number() over (partition by meter order by rn desc) = 1""")
def duplicate_resolution(spark: SparkSession, folder: str) -> DataFrame:
    return entities.fold_customers(_listed(spark, folder)).select("meterNo", "customerNo", "accountNo", "accountStatus", "lastPurchaseDate", "listed", "placeholder", "active", "latest", "errors")


@query(f"""with {_LISTED} select case when customer = meter then 'METER_EQUALS_CUSTOMER_AND_ACCOUNT' else 'CUSTOMER_EQUALS_ACCOUNT_NOT_METER' end as pattern, count(*) as n from listed group by 1""")
def placeholder_precedence(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.histogram(_listed(spark, folder), entities.identity_pattern(F.col("customerNo"), F.col("accountNo"), F.col("meterNo")).alias("pattern"))


@query(f"""with {FACTS}, mo as (select distinct meter from facts where ym <= '1996-06'), cu as (select meter, 'C' || c_custkey as customer, case when balance >= 0 then 'A' || c_custkey else '' end as account from meters where segment in ('BUILDING', 'MACHINERY', 'FURNITURE')),
np as (select meter, 'N' || c_custkey as customer from meters where balance < 0), ids as (select meter from mo union select meter from cu union select meter from np)
select meter as "masterId", case when cu.meter is not null then ' ' || meter when mo.meter is not null then meter else '0' || meter end as "meterNoRaw", coalesce(cu.customer, np.customer, '') as "customerNo", coalesce(cu.account, '') as "accountNo",
  case when mo.meter is not null then meter else '' end as "salesId", mo.meter is not null as "inMonthly", cu.meter is not null as "inCustomers", np.meter is not null as "inNpr"
from ids left join mo using (meter) left join cu using (meter) left join np using (meter)""")
def meter_master_merge(spark: SparkSession, folder: str) -> DataFrame:
    known = meters(spark, folder)
    monthly = purchases(spark, folder).where("ym <= '1996-06'").select("meterNo").distinct().withColumn("meterNoRaw", F.col("meterNo"))
    number = F.col("c_custkey").cast("string")
    customers = known.where(F.col("segment").isin("BUILDING", "MACHINERY", "FURNITURE")).select("meterNo", F.concat(F.lit(" "), "meterNo").alias("meterNoRaw"), F.concat(F.lit("C"), number).alias("customerNo"), F.when(F.col("balanceC") >= 0, F.concat(F.lit("A"), number)).otherwise("").alias("accountNo"))
    npr = known.where("balanceC < 0").select("meterNo", F.concat(F.lit("0"), "meterNo").alias("meterNoRaw"), F.concat(F.lit("N"), number).alias("customerNo"))
    merged = entities.meter_master(monthly, customers, npr, "LM", PROVIDER)
    # texts are trimmed in the master; a blank in front shows which source won
    first = F.when(F.col("inCustomers"), F.concat(F.lit(" "), "meterNoRaw")).otherwise(F.col("meterNoRaw"))
    return merged.select("masterId", first.alias("meterNoRaw"), "customerNo", "accountNo", "salesId", "inMonthly", "inCustomers", "inNpr")
