"""Duplicate identities folded in file order, and the meter master merged from three sources.

Folding depends on order: each meter's rows are put in file order and folded pair by pair inside the JVM. A meter's
rows are the times it is listed in one file, which a supplier keeps near one. A pair that no rule decides leaves an
error in the result; ``require_resolved`` raises once, after all meters are folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError

PLACEHOLDER, DOMINANT = "METER_EQUALS_CUSTOMER_AND_ACCOUNT", "CUSTOMER_EQUALS_ACCOUNT_NOT_METER"


def identity_pattern(customer: Column, account: Column, meter: Column) -> Column:
    same = (customer != "") & (customer == account)
    return F.when(same & (customer == meter), PLACEHOLDER).when(same, DOMINANT).when((customer == "") | (account == ""), "INCOMPLETE").otherwise("MIXED_OR_OTHER")


_FIELDS = ("meterNoRaw", "customerNo", "accountNo", "accountStatus", "lastPurchaseDate", "sourceRow")


def _time(text: Column) -> Column:
    return F.when(text != "", text.try_cast("timestamp"))


def _later(new: Column, old: Column) -> Column:
    return new.isNotNull() & (old.isNull() | (new > old))


def _record(row: Column, **changes: Column) -> Column:
    return F.struct(*(changes.get(f, row[f]).alias(f) for f in _FIELDS))


def _filled(a: Column, b: Column) -> Column:
    """The first row with blanks taken from the second, and the later of the two dates."""
    first = lambda f: F.when(a[f] == "", b[f]).otherwise(a[f])
    late = _later(_time(b["lastPurchaseDate"]), _time(a["lastPurchaseDate"]))
    date = F.when(late, b["lastPurchaseDate"]).otherwise(a["lastPurchaseDate"])
    return _record(a, meterNoRaw=first("meterNoRaw"), customerNo=first("customerNo"), accountNo=first("accountNo"), lastPurchaseDate=date, sourceRow=F.when(late, b["sourceRow"]).otherwise(a["sourceRow"]))


def _by_date(a: Column, b: Column) -> tuple[Column, Column]:
    """(whether dates can't tell, whether the second wins)."""
    old, new = _time(a["lastPurchaseDate"]), _time(b["lastPurchaseDate"])
    return old.eqNullSafe(new), _later(new, old)


def _customer_step(acc: Column, row: Column) -> Column:
    meter, cur = acc["meter"], acc["cur"]
    clash = lambda f: (cur[f] != "") & (row[f] != "") & (cur[f] != row[f])
    differs = clash("customerNo") | clash("accountNo")
    old = identity_pattern(cur["customerNo"], cur["accountNo"], meter)
    new = identity_pattern(row["customerNo"], row["accountNo"], meter)
    status_old, status_new = F.upper(cur["accountStatus"]), F.upper(row["accountStatus"])
    statuses = F.array_sort(F.array(status_old, status_new)) == F.array(F.lit("ACTIVE"), F.lit("BLOCK PURCHASES"))
    undated, newer = _by_date(cur, row)
    rule = (
        F.when(~differs, "merged")
        .when((old == PLACEHOLDER) & (new == DOMINANT), "placeholder_take")
        .when((old == DOMINANT) & (new == PLACEHOLDER), "placeholder_keep")
        .when(statuses, F.when(status_old == "ACTIVE", "active_keep").otherwise("active_take"))
        .when((old == DOMINANT) & (new == DOMINANT) & ~undated, F.when(newer, "latest_take").otherwise("latest_keep"))
        .otherwise("error")
    )
    return _next(acc, row, rule)


def _npr_step(acc: Column, row: Column) -> Column:
    meter, cur = acc["meter"], acc["cur"]
    old, new = cur["customerNo"], row["customerNo"]
    undated, newer = _by_date(cur, row)
    rule = (
        F.when((old != "") & (new == ""), "ignored")  # a blank identity changes nothing, not even the date
        .when((old == "") | (old == new), "merged")
        .when((old == meter) & (new != meter), "placeholder_take")
        .when((old != meter) & (new == meter), "placeholder_keep")
        .when(~undated, F.when(newer, "latest_take").otherwise("latest_keep"))
        .otherwise("error")
    )
    return _next(acc, row, rule)


def _next(acc: Column, row: Column, rule: Column) -> Column:
    cur = F.when(rule == "merged", _filled(acc["cur"], row)).when(rule.endswith("_take"), _record(row)).otherwise(acc["cur"])
    count = lambda name: (acc[name] + F.when(rule.startswith(name), 1).otherwise(0)).cast("int").alias(name)
    return F.struct(acc["meter"].alias("meter"), cur.alias("cur"), count("placeholder"), count("active"), count("latest"), (acc["errors"] + F.when(rule == "error", 1).otherwise(0)).cast("int").alias("errors"))


def _fold(df: DataFrame, step) -> DataFrame:
    rows = df.groupBy("meterNo").agg(F.array_sort(F.collect_list(F.struct("sourceRow", *(f for f in _FIELDS if f != "sourceRow")))).alias("_rows"))
    zero = [F.lit(0).cast("int").alias(n) for n in ("placeholder", "active", "latest", "errors")]
    start = F.struct(F.col("meterNo").alias("meter"), _record(F.col("_rows")[0]).alias("cur"), *zero)
    folded = F.aggregate(F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(1))), start, step)
    out = rows.select("meterNo", F.size("_rows").alias("listed"), folded.alias("f"))
    return out.select("meterNo", "listed", "f.cur.*", "f.placeholder", "f.active", "f.latest", "f.errors")


def fold_customers(df: DataFrame) -> DataFrame:
    """One row for each meter of a customer file (meterNo, ``_FIELDS``), with how often each rule decided."""
    return _fold(df, _customer_step)


def fold_npr(df: DataFrame) -> DataFrame:
    """The same for a file of meters without recent purchases, which has no accounts."""
    for c in ("accountNo", "accountStatus"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    return _fold(df, _npr_step)


def require_resolved(folded: DataFrame) -> DataFrame:
    bad = folded.where("errors > 0").limit(5).collect()
    if bad:
        raise ContractError(f"unresolved duplicate meters, such as {[r['meterNo'] for r in bad]}")
    return folded


def meter_master(monthly: DataFrame, customers: DataFrame, npr: DataFrame, lm: str | Column, provider: str, meter_type: str = "prepaid") -> DataFrame:
    """A row for each meter that any source knows: (meterNo, …), customer values first, the third source only fills blanks.

    The sources hold a meter once each: monthly (meterNo, meterNoRaw), the others as folded.
    """
    m = monthly.select("meterNo", F.col("meterNoRaw").alias("_m_raw"), F.lit(True).alias("inMonthly"))
    c = customers.select("meterNo", F.col("meterNoRaw").alias("_c_raw"), F.col("customerNo").alias("_c_customer"), F.col("accountNo").alias("_c_account"), F.lit(True).alias("inCustomers"))
    n = npr.select("meterNo", F.col("meterNoRaw").alias("_n_raw"), F.col("customerNo").alias("_n_customer"), F.lit(True).alias("inNpr"))
    both = m.join(c, "meterNo", "full_outer").join(n, "meterNo", "full_outer")
    pick = lambda *names: F.coalesce(*(S.blank_to_null(x) for x in names), F.lit(""))
    there = lambda x: F.coalesce(x, F.lit(False)).alias(x)
    return both.select(
        F.col("meterNo").alias("masterId"), (F.lit(lm) if isinstance(lm, str) else lm).alias("lmPcode"), pick("_c_raw", "_m_raw", "_n_raw", "meterNo").alias("meterNoRaw"),
        F.col("meterNo").alias("meterNoNormalized"), F.lit(meter_type).alias("meterType"), pick("_c_customer", "_n_customer").alias("customerNo"), pick("_c_account").alias("accountNo"),
        F.when(F.coalesce("inMonthly", F.lit(False)), F.col("meterNo")).otherwise("").alias("salesId"), F.when(F.coalesce("inMonthly", F.lit(False)), F.lit(provider)).otherwise("").alias("salesProvider"),
        F.lit("").alias("astId"), there("inMonthly"), there("inCustomers"), there("inNpr"),
    )
