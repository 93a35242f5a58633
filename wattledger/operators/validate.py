"""Row rules with reasons, contracts of columns, and assertions over whole tables.

A rule is a code and a condition. A row gathers the codes of all rules that it breaks, in the order of the rules; rows
without any are valid. Pipelines fail closed: one rejected row blocks the write unless the caller asks otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import scalars as S


class ContractError(ValueError):
    """The input breaks a contract; nothing is written."""


Rules = Sequence[tuple[str, Column]]


def reasons(rules: Rules) -> Column:
    """Codes of the rules whose condition holds; a null condition is not held."""
    return F.array_compact(F.array(*(F.when(broken, F.lit(code)) for code, broken in rules)))


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame

    def require_clean(self) -> DataFrame:
        """The valid rows, if there are no others."""
        bad = self.rejected.limit(5).collect()
        if bad:
            raise ContractError(f"rejected rows block the output, such as {[r.asDict() for r in bad]}")
        return self.valid


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows with more columns, each evaluated once.

    A filter on them would else be pushed below, and every expression be evaluated again in it; a generator stands between.
    The first of them stands in a lambda, which keeps their projection out of a generated method too large to be compiled.
    """
    hidden = {f"_{name}": c for name, c in columns.items()}
    first = next(iter(hidden))
    hidden[first] = F.get(F.transform(F.array(hidden[first]), lambda x: x), F.lit(0))
    return df.withColumns(hidden).select(*df.columns, F.inline(F.array(F.struct(*(F.col(h).alias(name) for h, name in zip(hidden, columns, strict=True))))))


@dataclass(frozen=True)
class Contract:
    """Fields that are parsed once for each row, and rules that compare them."""

    fields: dict[str, Column]
    rules: Rules


def split(df: DataFrame, rules: Rules | Contract, name: str = "rejectReason", parsed: bool = False) -> Split:
    """Valid rows, and rejected ones with their codes joined by semicolons; with ``parsed``, the contract's fields stay."""
    fields = rules.fields if isinstance(rules, Contract) else {}
    given = computed(df, **fields) if fields else df
    judged = computed(given, _reasons=reasons(rules.rules if isinstance(rules, Contract) else rules))
    bad, extra = F.size("_reasons") > 0, ["_reasons", *([] if parsed else fields)]
    return Split(judged.where(~bad).drop(*extra), judged.where(bad).withColumn(name, F.array_join("_reasons", ";")).drop(*extra))


def require_columns(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """The frame, if its columns are the contract's, in order; with ``exact`` off, more may follow anywhere."""
    if (list(df.columns) != list(columns)) if exact else (set(columns) - set(df.columns)):
        raise ContractError(f"columns {df.columns} are not {list(columns)}")
    return df


def money_rules(amount: Column, cost: Column, vat: Column, name: str = "amount") -> list[tuple[str, Column]]:
    known = amount.isNotNull() & cost.isNotNull() & vat.isNotNull()
    return [
        (f"invalid_{name}", amount.isNull()),
        ("invalid_cost", cost.isNull()),
        ("invalid_vat", vat.isNull()),
        (f"negative_{name}", amount < 0),
        ("negative_cost", cost < 0),
        ("negative_vat", vat < 0),
        ("amount_cost_vat_reconciliation_failed", known & (amount != cost + vat)),
    ]


def portal_rules(month: str | Column) -> Contract:
    """The thirteen rules of a raw portal export, in their order; every field is parsed once."""
    month = F.lit(month) if isinstance(month, str) else month
    fields = {
        "_time": S.day_first_time("TransactionDateTime_2"), "_meter": S.raw_meter_no("VendingNo_3"), "_group": S.raw_meter_no("CDUToggle"),
        **{f"_{c}": S.money_cents(c) for c in ("Amount", "CostOfUnits_2", "VAT", "RefundAmount")},
    }
    time, meter, group, amount, cost, vat, refund = map(F.col, fields)
    money = dict(money_rules(amount, cost, vat))
    rules = [
        ("invalid_transaction_datetime", time.isNull()),
        ("transaction_month_mismatch", S.month_of(time) != month),
        ("blank_meter_number", meter == ""),
        ("meter_group_mismatch", (group != "") & (group != meter)),
        *((c, money[c]) for c in ("invalid_amount", "invalid_cost", "invalid_vat")),
        ("invalid_refund_amount", refund.isNull()),
        *((c, money[c]) for c in ("negative_amount", "negative_cost", "negative_vat")),
        ("non_zero_refund_requires_separate_design", refund != 0),
        ("amount_cost_vat_reconciliation_failed", money["amount_cost_vat_reconciliation_failed"]),
    ]
    return Contract(fields, rules)


def staging_rules(lm: str | Column, month: str | Column) -> Contract:
    """The thirteen rules of a staged file; a blank municipality breaks two of them."""
    lm, month = (F.lit(x) if isinstance(x, str) else x for x in (lm, month))
    fields = {"_place": S.clean_text("lmPcode"), "_time": S.day_first_time("txAt"), "_meter": S.raw_meter_no("meterNo"), **{f"_{c}": S.money_cents(c, drop_every_r=False) for c in ("amountTotalC", "costC", "vatC")}}
    place, time, meter, *sums = map(F.col, fields)
    money = money_rules(*sums, name="amountTotal")
    rules = [
        ("blank_lmPcode", place == ""),
        ("lmPcode_filename_or_argument_mismatch", place != lm),
        ("invalid_txAt", time.isNull()),
        ("txAt_month_mismatch", S.month_of(time) != month),
        ("blank_meterNo", meter == ""),
        ("invalid_meter_characters", (meter != "") & ~meter.rlike("^[A-Z0-9]+$")),
        *money,
    ]
    return Contract(fields, rules)


def assertions(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: how many rows break each check. ``checks`` are conditions that must not hold."""
    return df.agg(*(F.count_if(broken).cast("bigint").alias(name) for name, broken in checks.items()))


def sequence_errors(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """For each ``by``: rows, and how far the values of ``column`` are from being 1 to the number of rows: repeats and gaps."""
    counts = df.groupBy(*by, column).agg(F.count("*").alias("_n"))
    found = counts.groupBy(*by).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("repeated"), F.count_if(F.col(column).isNull() | (F.col(column) < 1)).alias("invalid"), F.max(column).alias("_last"), F.count(column).alias("_distinct"))
    return found.select(*by, "rows", "repeated", "invalid", (F.greatest("_last", F.lit(0)) - F.col("_distinct") + F.col("invalid")).cast("bigint").alias("missing"))


def require_all(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The frame, if no row breaks a check."""
    found = {k: v for k, v in assertions(df, checks).first().asDict().items() if v}
    if found:
        raise ContractError(f"checks fail: {found}")
    return df


def profile(df: DataFrame, unique: Sequence[str], constant: Sequence[str] = ()) -> DataFrame:
    """One row of counts: rows, rows beyond the first of each ``unique`` key, and the distinct values of constants."""
    ids = df.groupBy(*unique).agg(F.count("*").alias("_n"), *(F.min(c).alias(f"_lo_{c}") for c in constant), *(F.max(c).alias(f"_hi_{c}") for c in constant))
    spread = [(F.min(f"_lo_{c}").eqNullSafe(F.max(f"_hi_{c}"))).alias(f"{c}_constant") for c in constant]
    return ids.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"), *spread)


def recency_rules(total: Column, last_month: Column, last_positive: Column, days: Column) -> list[tuple[str, Column]]:
    """No sales means no recency; otherwise the last purchase falls in the latest month with sales, not after today."""
    return [
        ("recency_without_sales", (total == 0) & (last_month.isNotNull() | days.isNotNull())),
        ("sales_without_recency", (total > 0) & (last_month.isNull() | days.isNull())),
        ("last_month_mismatch", (total > 0) & ~last_month.eqNullSafe(last_positive)),
        ("negative_days", days < 0),
    ]


def purchase_month_rules(amount: Column, purchase: Column, month: Column, first: Column, last: Column) -> list[tuple[str, Column]]:
    """A month's row lies in the approved range; a positive amount has a purchase, and a purchase is of the row's month."""
    return [
        ("month_not_approved", ~F.coalesce(month.between(first, last), F.lit(False))),
        ("purchase_missing", (amount > 0) & purchase.isNull()),
        ("purchase_of_another_month", S.month_of(purchase) != month),
    ]


def history_valid(history: Column) -> Column:
    """Every month of a category history is well formed and holds a valid category."""
    return F.forall(F.map_entries(history), lambda e: e["key"].rlike(r"^\d{4}-(0[1-9]|1[0-2])$") & S.category_valid(e["value"]))


def forbidden_keys(json: Column, names: Sequence[str]) -> Column:
    """Those root keys of a JSON text that must not be there."""
    return F.array_intersect(F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")), F.array(*map(F.lit, names)))


def parcel_rules() -> list[tuple[str, Column]]:
    """Rules for parcel records (erfId, prclKey, erfNo, lmPcode, lat, lng, geometry)."""
    kind = F.get_json_object("geometry", "$.type")
    return [
        ("missing_erf_id", S.clean_text("erfId") == ""),
        ("missing_parcel_key", S.parcel_key("prclKey") == ""),
        ("missing_erf_number", S.parcel_no("erfNo") == ""),
        ("missing_municipality", S.clean_text("lmPcode") == ""),
        ("invalid_centroid", ~S.coordinate_valid("lat", "lng")),
        ("invalid_geometry", F.col("geometry").isNotNull() & ~F.coalesce(kind.isin("Polygon", "MultiPolygon"), F.lit(False))),
    ]


def require_same_ids(a: DataFrame, b: DataFrame, key: str) -> None:
    """Both frames hold the same set of ids, decided by two anti joins that stop at the first difference."""
    for one, other in ((a, b), (b, a)):
        extra = one.select(key).join(other.select(key), key, "left_anti").limit(5).collect()
        if extra:
            raise ContractError(f"ids differ, such as {[r[0] for r in extra]}")


def require_paths(updates: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """The plan, if each path that it patches has an allowed root."""
    outside = F.exists(F.map_keys(column), lambda k: ~F.element_at(F.split(k, r"\."), 1).isin(list(allowed)))
    return require_all(updates, {"path_outside_scope": F.coalesce(outside, F.lit(False))})
