"""Supplier workbooks to the commercial baseline: extended histories, new records, and the accounts that must balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError

# fixed values: text headers of a supplier sheet, in order, and the fields of an address as it is given
HEADERS = (
    "Customer", "TariffInstance", "MeterNumber", "InstallationDate", "PreviousMeterNumber", "PreviousInstallationDate", "StandNumber", "Surname", "AddressLine1", "AddressLine2",
    "Town", "PostalAddress1", "PostalAddress2", "PostalAddressTown", "AccountNumber",
)
ADDRESS_FIELDS = ("addressLine1", "addressLine2", "town", "postalAddress1", "postalAddress2", "postalAddressTown", "standNumber")


def layout_errors(header: Sequence[str | int | float | None], text_headers: Sequence[str] = HEADERS) -> list[str]:
    """What is wrong with a sheet's header row: fixed text headers, a block of months, a spacer, the same block again."""
    errors = [] if tuple(map(str, header[: len(text_headers)])) == tuple(text_headers) else ["TEXT_HEADERS_DIFFER"]
    rest = list(header[len(text_headers) :])
    if None not in rest:
        return [*errors, "NO_SPACER"]
    at = rest.index(None)
    sales, units = rest[:at], rest[at + 1 :]
    if not sales or sales != units:
        errors.append("BLOCKS_DIFFER")
    months = [int(m) for m in sales if isinstance(m, int | float) and 20_000 <= m <= 80_000]
    if len(months) != len(sales):
        errors.append("NOT_A_MONTH")
    index = [(d.year * 12 + d.month) for d in map(_serial_date, months)]
    if index != list(range(index[0], index[0] + len(index))) if index else False:
        errors.append("MONTHS_NOT_CONTIGUOUS")
    return errors


def _serial_date(serial: int):
    from datetime import date, timedelta

    return date(1899, 12, 30) + timedelta(days=serial)


def raw_address(df: DataFrame, *keys: str) -> DataFrame:
    """The keys and the address as it is given."""
    return df.select(*keys, *ADDRESS_FIELDS)


def new_records(workbook: DataFrame, lm: str, provider: str, until: str, file_name: str) -> DataFrame:
    """Baseline records of new meters from workbook rows (headers, sourceRow, monthlySalesC, monthlyUnits).

    Only what the workbook tells is filled in; categories, risk and parcels start blank.
    """
    t = S.clean_text
    inside = lambda m: F.map_filter(m, lambda k, v: k <= until)
    sales, units = inside("monthlySalesC"), inside("monthlyUnits")
    blank, none = F.lit(""), F.array().cast("array<string>")
    total = F.aggregate(F.map_values(units), F.lit(0).cast("decimal(28,1)"), lambda a, x: (a + x).cast("decimal(28,1)"))
    return workbook.select(
        t("MeterNumber").alias("sourceDocumentId"), blank.alias("sourceDocumentPath"), F.col("sourceRow").alias("sourceEndRow"), t("MeterNumber").alias("meterNo"), S.meter_no("MeterNumber").alias("meterNoNormalized"), F.lit(provider).alias("provider"),
        F.lit(lm).alias("lmPcode"), *(t("AccountNumber").alias(c) for c in ("accountNo", "accountNumber", "accountNumberNormalized")), t("Customer").alias("customerNo"), *(t("Surname").alias(c) for c in ("customerName", "customerSurname")),
        F.lit(file_name).alias("sourceFileName"), F.col("sourceRow").alias("sourceRow"), t("AddressLine1").alias("addressLine1"), t("AddressLine2").alias("addressLine2"), t("Town").alias("town"), t("PostalAddress1").alias("postalAddress1"),
        t("PostalAddress2").alias("postalAddress2"), t("PostalAddressTown").alias("postalAddressTown"), t("StandNumber").alias("standNumber"), t("TariffInstance").alias("tariffInstance"), t("InstallationDate").alias("installationDate"),
        t("PreviousMeterNumber").alias("previousMeterNumber"), t("PreviousInstallationDate").alias("previousInstallationDate"), *(blank.alias(c) for c in ("leakageCategory", "riskTier", "riskScore")), F.array_min(F.map_keys(sales)).alias("salesPeriodFrom"),
        F.lit(until).alias("salesPeriodTo"), sales.alias("monthlySalesC"), units.alias("monthlyUnits"), M.map_total(sales).alias("totalSalesC"), total.alias("totalUnits"), F.lit(False).alias("elmAccountMatched"), none.alias("elmSourceRows"),
        F.lit(0).alias("erfCandidateCount"), *(none.alias(c) for c in ("erfCandidates", "erfNumbers", "missingErfNumbers")), blank.alias("gpsMatchStatus"), F.lit(False).alias("hasUsableGps"),
    )


def extend_baseline(baseline: DataFrame, workbook: DataFrame, until: str, key: str = "meterNo") -> DataFrame:
    """(key, state, conflicts, added, monthlySalesC, monthlyUnits, totalSalesC, salesPeriodTo) of each baseline record that the workbook lists.

    A month that both have must be equal in amount and units; later months until ``until`` are appended. CONFLICT leaves the
    record as it is; UNCHANGED adds no month.
    """
    old = baseline.select(key, F.col("monthlySalesC").alias("_os"), F.col("monthlyUnits").alias("_ou"), F.col("salesPeriodTo").alias("_to"))
    new = workbook.select(key, F.map_filter("monthlySalesC", lambda k, v: k <= until).alias("_ns"), F.map_filter("monthlyUnits", lambda k, v: k <= until).alias("_nu"))
    both = old.join(new, key)
    clash = lambda a, b: F.filter(F.map_keys(a), lambda k: F.map_contains_key(b, k) & ~F.element_at(b, k).eqNullSafe(F.element_at(a, k)))
    keys = F.col("_os"), F.col("_ns"), F.col("_ou"), F.col("_nu")
    wrong = F.array_sort(F.array_union(clash(keys[0], keys[1]), clash(keys[2], keys[3])))
    judged = both.withColumn("conflicts", F.when(~M.keys_equal(F.col("_os"), F.col("_ou")), F.array(F.lit("sales and units"))).otherwise(wrong))
    later = lambda m: F.map_filter(m, lambda k, v: k > F.col("_to"))
    ok = F.size("conflicts") == 0
    put = lambda a, b: F.when(ok, F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(a, M.new_entries(a, later(b))))))).otherwise(a)
    made = judged.select(key, "conflicts", F.when(ok, F.size(M.new_entries(F.col("_os"), later(F.col("_ns"))))).otherwise(0).alias("added"), put(F.col("_os"), F.col("_ns")).alias("monthlySalesC"), put(F.col("_ou"), F.col("_nu")).alias("monthlyUnits"), "_to")
    state = F.when(F.size("conflicts") > 0, "CONFLICT").when(F.col("added") > 0, "UPDATED").otherwise("UNCHANGED")
    return made.select(key, state.alias("state"), "conflicts", "added", "monthlySalesC", "monthlyUnits", M.map_total(F.col("monthlySalesC")).alias("totalSalesC"), F.when(F.col("added") > 0, F.lit(until)).otherwise(F.col("_to")).alias("salesPeriodTo"))


def population_accounts(cumulative: DataFrame, previous: DataFrame, current: DataFrame, pairs: DataFrame, key: str = "meterNo") -> DataFrame:
    """One row: sizes of the snapshots and their parts, and whether each identity between them holds. ``pairs``: (predecessor, successor)."""
    flag = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    every = flag(cumulative, "k").join(flag(previous, "p"), key, "full_outer").join(flag(current, "c"), key, "full_outer")
    every = every.join(pairs.select(F.col("predecessor").alias(key), F.lit(True).alias("r")).distinct(), key, "left").join(pairs.select(F.col("successor").alias(key), F.lit(True).alias("s")).distinct(), key, "left")
    is_ = lambda c: F.coalesce(F.col(c), F.lit(False))
    k, p, c, r, s = map(is_, "kpcrs")
    counts = every.agg(
        F.count_if(k).alias("cumulative"), F.count_if(p).alias("previous"), F.count_if(c).alias("current"), F.count_if(p & c).alias("unchanged"), F.count_if(c & ~p).alias("additions"), F.count_if(p & ~c).alias("missing"),
        F.count_if(c & ~k).alias("creates"), F.count_if(c & ~k & s).alias("replacementCreates"), F.count_if(c & ~k & ~s).alias("newCreates"), F.count_if(p & ~c & r).alias("replaced"), F.count_if(p & ~c & ~r).alias("removed"), F.count_if(k | c).alias("cumulativeAfter"),
    )
    return counts.withColumns({"createsHold" if name == "creates" else f"{name}Holds": F.expr(holds) for name, holds in IDENTITIES.items()})


IDENTITIES = {  # between the sizes of snapshots and their parts
    "cumulative": "cumulative + creates = cumulativeAfter", "current": "unchanged + additions = current", "previous": "unchanged + missing = previous", "creates": "replacementCreates + newCreates = creates", "outgoing": "replaced + removed = missing",
}
ACCOUNTS = ("cumulative", "previous", "current", "unchanged", "additions", "missing", "creates", "replacementCreates", "newCreates", "replaced", "removed", "cumulativeAfter")


def account_errors(declared: DataFrame, accounts: DataFrame, report: str = "report") -> DataFrame:
    """(report, code) of reports (report, and the numbers of ``ACCOUNTS`` that they declare): identities that their numbers break, and numbers that aren't those of ``accounts``, the one row that the populations give."""
    found = F.broadcast(accounts.select(*(F.col(c).alias(f"_{c}") for c in ACCOUNTS)))
    broken = [F.when(~F.coalesce(F.expr(holds), F.lit(False)), F.lit(f"{name}_IMBALANCE")) for name, holds in IDENTITIES.items()]
    other = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"{c}_DIFFERS")) for c in ACCOUNTS]
    return declared.join(found).select(report, F.explode(F.array_compact(F.array(*broken, *other))).alias("code"))


def source_differences(monthly: DataFrame, source: DataFrame, key: str = "meterNo") -> DataFrame:
    """(key, ym, monthlyC, sourceC): months where monthly rows and the source's month map differ, or where only one has a value that isn't 0."""
    rows = M.unpivot(source, [key], {"monthlySalesC": "sourceC"})
    both = monthly.select(key, "ym", F.col("amountTotalC").alias("monthlyC")).join(rows, [key, "ym"], "full_outer")
    return both.where(F.coalesce("monthlyC", F.lit(0)) != F.coalesce("sourceC", F.lit(0)))


def output_order(records: DataFrame, known: DataFrame, key: str = "meterNo", row: str = "sourceRow") -> DataFrame:
    """The records with ``isNew``: sorted, known ones come first by id, then new ones by their row in the sheet."""
    marked = records.join(known.select(key, F.lit(False).alias("_new")).distinct(), key, "left").withColumn("isNew", F.coalesce("_new", F.lit(True))).drop("_new")
    return marked.orderBy("isNew", F.when(F.col("isNew"), F.col(row)), key)


def source_evidence(df: DataFrame, month: str, lm: str) -> DataFrame:
    """One row of totals of a month's source rows (lmPcode, meterNo, ym, amountTotalC, unitsTotal), and how many rows break its contract."""
    bad = {"otherMunicipality": F.col("lmPcode") != lm, "otherMonth": F.col("ym") != month, "negative": F.least("amountTotalC", F.col("unitsTotal").cast("bigint")) < 0, "blankMeter": S.clean_text("meterNo") == ""}
    per_meter = df.groupBy("meterNo").agg(F.count("*").alias("_n"), F.sum("amountTotalC").alias("_a"), F.sum("unitsTotal").alias("_u"), *(F.count_if(b).alias(f"_{n}") for n, b in bad.items()))
    return per_meter.agg(
        F.count("*").alias("meters"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_a"), F.lit(0)).cast("bigint").alias("amountTotalC"), F.coalesce(F.sum("_u"), F.lit(0)).cast("decimal(28,1)").alias("unitsTotal"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeatedMeters"), *(F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(n) for n in bad),
    )


def require_layout(header: Sequence[str | int | float | None]) -> None:
    if errors := layout_errors(header):
        raise ContractError(f"the sheet's header isn't the contract's: {errors}")


def atomic_document(df: DataFrame) -> Column:
    """A purchase as a nested document."""
    return F.struct("atomicId", F.struct("lmPcode").alias("parents"), F.struct("meterNo").alias("meter"), F.struct("txAtISO", "txAtMs", "ym", "y", "m").alias("time"), F.struct("amountTotalC", "costC", "vatC").alias("money"))


def master_document(provider: str) -> Column:
    """A master row as a nested document."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.struct(
        "lmPcode", F.struct(F.col("meterNoRaw").alias("raw"), F.col("masterId").alias("normalized")).alias("meterNo"), "meterType", blank("customerNo").alias("customerNo"), blank("accountNo").alias("accountNo"),
        F.struct(F.struct(F.lit("").alias("id")).alias("asts"), F.struct(blank("salesId").alias("id"), F.when(blank("salesId") != "", provider).otherwise("").alias("provider")).alias("sales")).alias("refs"),
    )
