"""Plans to change a store of documents: classify, patch as little as possible, gate, verify, recover.

The store is a table with a row for each document and a version token; a plan is a table too. One conflict stops the
whole plan before anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.operators.validate import ContractError

STATES = ("CREATED", "UPDATED", "UNCHANGED", "CONFLICT")


def _sides(expected: DataFrame, existing: DataFrame, key: str, how: str) -> DataFrame:
    old = existing.select(F.col(key), F.struct(*(c for c in existing.columns if c != key)).alias("old"))
    new = expected.select(F.col(key), F.struct(*(c for c in expected.columns if c != key)).alias("new"))
    return new.join(old, key, how)


def _differs(field: str) -> Column:
    return ~F.col(f"old.{field}").eqNullSafe(F.col(f"new.{field}"))


def classify(expected: DataFrame, existing: DataFrame, key: str, identity: Sequence[str], owned: Sequence[str], histories: Sequence[str], checks: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """(key, classification, reason, updates): what has to happen to each expected document.

    A stored identity field that is set and differs is a conflict, and so is a stored month that is gone or changed.
    ``checks`` are more conflicts, (reason, condition over ``old`` and ``new``), such as a value that is none of an enumeration.
    ``updates`` maps dotted paths to values as text: owned fields that differ, and new months only.
    """
    both = _sides(expected, existing, key, "left")
    lost = [F.when(F.size(M.changed_keys(F.col(f"old.{h}"), F.col(f"new.{h}"))) > 0, F.concat(F.lit(f"history {h}."), F.get(M.changed_keys(F.col(f"old.{h}"), F.col(f"new.{h}")), F.lit(0)))) for h in histories]
    other = [F.when(F.col(f"old.{f}").isNotNull() & (F.col(f"old.{f}").cast("string") != "") & _differs(f), F.lit(f"{f} differs")) for f in identity]
    none = F.lit(None).cast("string")
    more = [F.when(condition, F.lit(name)) for name, condition in checks]
    reason = F.when(F.col("old").isNotNull(), F.coalesce(*lost, *other, *more, none))
    fields = F.map_from_entries(F.array_compact(F.array(*(F.when(_differs(f), F.struct(F.lit(f).alias("key"), F.coalesce(F.col(f"new.{f}").cast("string"), F.lit("")).alias("value"))) for f in owned)))) if owned else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    updates = F.map_concat(fields, *(M.dotted_updates(h, F.col(f"old.{h}"), F.col(f"new.{h}")) for h in histories)) if histories else fields
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    judged = both.withColumn("reason", reason).withColumn("updates", F.when(F.col("old").isNotNull() & F.col("reason").isNull(), updates).otherwise(empty))
    state = F.when(F.col("old").isNull(), "CREATED").when(F.col("reason").isNotNull(), "CONFLICT").when(F.size("updates") > 0, "UPDATED").otherwise("UNCHANGED")
    return judged.select(key, state.alias("classification"), "reason", "updates")


def refresh_masters(incoming: DataFrame, existing: DataFrame, key: str = "masterId") -> DataFrame:
    """(key, classification, code, updates): changes to master rows; a blank incoming value keeps the stored one.

    Fields: meterNoRaw, lmPcode, meterType, customerNo, accountNo, salesId, salesProvider, and stored meterNoNormalized. A
    column ``stored_code`` of the stored rows, as ``documents.unfold_masters`` gives it, comes before all other conflicts.
    """
    both = _sides(incoming, existing, key, "left")
    text = lambda side, f: F.coalesce(F.col(f"{side}.{f}"), F.lit(""))
    old, new = (lambda f: text("old", f)), (lambda f: text("new", f))
    stored = F.col("old.stored_code") if "stored_code" in existing.columns else F.lit(None).cast("string")
    set_and_other = lambda f: (old(f) != "") & (old(f) != new(f))
    code = (
        F.when(F.col("old").isNull(), "MM_MISSING").when(stored.isNotNull(), stored)
        .when(old("meterNoNormalized") != F.col(key), "MM_NORMALIZED_IDENTITY_CONFLICT").when(F.trim(old("meterNoRaw")) == "", "MM_CANONICAL_FIELD_MISSING")
        .when(old("meterNoRaw") != new("meterNoRaw"), "MM_RAW_IDENTITY_CONFLICT").when(old("lmPcode") != new("lmPcode"), "MM_LM_CONFLICT").when(old("meterType") != new("meterType"), "MM_METER_TYPE_CONFLICT")
        .when(set_and_other("salesId"), "MM_SALES_REFERENCE_CONFLICT").when(set_and_other("salesProvider"), "MM_SALES_PROVIDER_CONFLICT")
        .when((old("salesId") == "") != (old("salesProvider") == ""), "MM_SALES_REFERENCE_PAIR_CONFLICT")
    )
    paths = {"customerNo": "customerNo", "accountNo": "accountNo", "refs.sales.id": "salesId", "refs.sales.provider": "salesProvider"}
    wanted = lambda f: F.when(new(f) != "", new(f)).otherwise(old(f))
    updates = F.map_from_entries(F.array_compact(F.array(*(F.when(wanted(f) != old(f), F.struct(F.lit(p).alias("key"), wanted(f).alias("value"))) for p, f in paths.items()))))
    judged = both.withColumn("code", code).withColumn("updates", F.when(F.col("code").isNull(), updates))
    state = F.when(F.col("code") == "MM_MISSING", "CREATED").when(F.col("code").isNotNull(), "CONFLICT").when(F.size("updates") > 0, "UPDATED").otherwise("UNCHANGED")
    named = F.coalesce("code", F.when(F.size("updates") > 0, "MM_SALES_FIELDS_UPDATED").otherwise("MM_VALUES_UNCHANGED"))
    return judged.select(key, state.alias("classification"), named.alias("code"), "updates")


def refresh_monthly(expected: DataFrame, existing: DataFrame, key: str, fixed: Sequence[str], mutable: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """(key, classification, fields): a changed fixed field is a conflict, changed mutable fields are the update.

    ``stored``, (key, stored_code, fields) of the stored documents as ``documents.stored_codes`` gives it, comes first: a
    document with another shape or other types is a conflict, whatever its values.
    """
    both = _sides(expected, existing, key, "left")
    if stored is not None:
        odd = stored.where("stored_code is not null").select(key, F.col("fields").alias("_odd"))
        first = refresh_monthly(expected, existing, key, fixed, mutable).join(odd, key, "left")
        broken = F.col("_odd").isNotNull() & (F.col("classification") != "CREATED")
        return first.select(key, F.when(broken, "CONFLICT").otherwise(F.col("classification")).alias("classification"), F.when(broken, F.col("_odd")).otherwise(F.col("fields")).alias("fields"))
    changed = lambda fields: F.array_compact(F.array(*(F.when(_differs(f), F.lit(f)) for f in fields)))
    judged = both.withColumn("_fixed", changed(fixed)).withColumn("_mutable", changed(mutable))
    state = F.when(F.col("old").isNull(), "CREATED").when(F.size("_fixed") > 0, "CONFLICT").when(F.size("_mutable") > 0, "UPDATED").otherwise("UNCHANGED")
    fields = F.when(F.col("old").isNull(), F.array().cast("array<string>")).when(F.size("_fixed") > 0, F.col("_fixed")).otherwise(F.col("_mutable"))
    return judged.select(key, state.alias("classification"), fields.alias("fields"))


def resume_state(expected: DataFrame, existing: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, state) with MATCHING, MISSING, CONFLICT or EXTRA for every id of either side."""
    both = _sides(expected.select(key, *columns), existing.select(key, *columns), key, "full_outer")
    state = F.when(F.col("new").isNull(), "EXTRA").when(F.col("old").isNull(), "MISSING").when(F.col("old").eqNullSafe(F.col("new")), "MATCHING").otherwise("CONFLICT")
    return both.select(key, state.alias("state"))


def deploy_state(expected: DataFrame, existing: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, state) of the expected ids alone: IDENTICAL, DIFFERENT or MISSING; only the missing may be written."""
    both = _sides(expected.select(key, *columns), existing.select(key, *columns), key, "left")
    return both.select(key, F.when(F.col("old").isNull(), "MISSING").when(F.col("old").eqNullSafe(F.col("new")), "IDENTICAL").otherwise("DIFFERENT").alias("state"))


def append_categories(history: DataFrame, month: DataFrame, ym: str, required: Sequence[str], key: str = "meterNo") -> DataFrame:
    """(key, classification): may the month's value join the history?

    history: (key, months map<string,string>); month: (key, value). A required month that is missing, or a stored
    value of the same month that differs, is a conflict.
    """
    both = month.join(history, key, "left")
    gaps = F.exists(F.array(*map(F.lit, required)), lambda m: ~F.map_contains_key("months", m)) if required else F.lit(False)
    stored = F.try_element_at("months", F.lit(ym))
    state = F.when(F.col("months").isNull(), "CONFLICT_MISSING_DOCUMENT").when(gaps, "CONFLICT_MISSING_HISTORY").when(stored.isNull(), "UPDATED").when(stored == F.col("value"), "UNCHANGED").otherwise("CONFLICT_DIFFERENT_VALUE")
    return both.select(key, state.alias("classification"))


ADDRESS = ("strNo", "strName", "strType")


def align_addresses(expected: DataFrame, existing: DataFrame, key: str = "masterId") -> DataFrame:
    """(key, classification): expected (key, identity, other, adr struct) against the store's same columns."""
    both = _sides(expected, existing, key, "left")
    state = (
        F.when(F.col("old").isNull(), "MISSING").when(_differs("identity"), "IDENTITY_CONFLICT").when(_differs("other"), "NON_ADR_CONFLICT")
        .when(F.col("old.adr").isNull() & F.col("new.adr").isNotNull(), "UPDATE_MISSING_ADR").when(~_differs("adr"), "MATCHING").otherwise("ADR_CONFLICT")
    )
    return both.select(key, state.alias("classification"))


def gate(plan: DataFrame, column: str = "classification") -> DataFrame:
    """One row: planned, each state's count, and whether the plan may be written: everything classified, no conflict."""
    counts = plan.agg(F.count("*").alias("planned"), *(F.count_if(F.col(column) == s).alias(s.lower()) for s in STATES))
    total = sum((F.col(s.lower()) for s in STATES[1:]), F.col(STATES[0].lower()))
    return counts.withColumn("may_write", (F.col("planned") == total) & (F.col("conflict") == 0))


def require_gate(plan: DataFrame) -> DataFrame:
    found = gate(plan).first()
    if not found["may_write"]:
        raise ContractError(f"the plan is blocked: {found.asDict()}")
    return plan


def apply_plan(plan: DataFrame, expected: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The store after the plan: created and updated documents as expected, all others as they are."""
    changed = plan.where(F.col("classification").isin("CREATED", "UPDATED")).select(key)
    kept = existing.join(changed, key, "left_anti")
    return kept.unionByName(expected.join(changed, key, "left_semi").select(*existing.columns))


def apply_patches(plan: DataFrame, expected: DataFrame, existing: DataFrame, key: str, owned: Sequence[str], histories: Sequence[str]) -> DataFrame:
    """The documents that a plan writes and no others: created ones as expected, updated ones with their owned fields and new months replaced and all else as stored."""
    todo = plan.where(F.col("classification").isin("CREATED", "UPDATED")).select(key, "classification")
    both = _sides(expected.select(*existing.columns), existing, key, "left").join(todo, key)
    patched = lambda c: F.map_concat(F.col(f"old.{c}"), M.new_entries(F.col(f"old.{c}"), F.col(f"new.{c}"))) if c in histories else F.col(f"new.{c}" if c in owned else f"old.{c}")
    return both.select(*(F.col(key) if c == key else F.when(F.col("classification") == "CREATED", F.col(f"new.{c}")).otherwise(patched(c)).alias(c) for c in existing.columns))


def comparable(df: DataFrame) -> DataFrame:
    """The same rows with maps as sorted entries, so that columns can be compared."""
    return df.select(*(F.array_sort(F.map_entries(c)).alias(c) if kind.startswith("map") else F.col(c) for c, kind in df.dtypes))


def verify(expected: DataFrame, written: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: expected rows, missing ones, differing ones, and the verdict."""
    both = _sides(expected.select(key, *columns), written.select(key, *columns), key, "left")
    missing = F.col("old").isNull()
    out = both.agg(F.count("*").alias("expected"), F.count_if(missing).alias("missing"), F.count_if(~missing & ~F.col("old").eqNullSafe(F.col("new"))).alias("different"))
    return out.withColumn("verdict", F.when((F.col("missing") == 0) & (F.col("different") == 0), "PASS").otherwise("FAIL"))


def visibility(ast_id: Column, sales_id: Column) -> Column:
    """VISIBLE if both references are set."""
    return F.when((F.coalesce(ast_id, F.lit("")) != "") & (F.coalesce(sales_id, F.lit("")) != ""), "VISIBLE").otherwise("INVISIBLE")


def reconcile_visibility(masters: DataFrame, sales: DataFrame, key: str = "masterId") -> DataFrame:
    """(key, wanted, outcome) of each master and its sales document.

    masters: (key, astId, salesId); sales: (key, visibility).
    """
    both = masters.withColumn("_m", F.lit(True)).join(sales.withColumn("_s", F.lit(True)), key, "full_outer")
    wanted = visibility(F.col("astId"), F.col("salesId"))
    outcome = F.when(F.col("_m").isNull(), "MASTER_MISSING").when(F.col("_s").isNull(), "SALES_MISSING").when(~F.coalesce(F.col("visibility").isin("VISIBLE", "INVISIBLE"), F.lit(False)), "INVALID_VISIBILITY").when(F.col("visibility") == wanted, "UNCHANGED").otherwise("UPDATED")
    return both.select(key, F.when(F.col("_m").isNotNull(), wanted).alias("wanted"), outcome.alias("outcome"))


def recovery(before: DataFrame, plan: DataFrame, current: DataFrame, key: str = "masterId") -> DataFrame:
    """(key, outcome, restore, deletes, paths): how to undo a written plan without touching later changes.

    before and current: (key, fields map of dotted path to text, token), no fields if the document isn't there;
    plan: (key, classification, token, patch). A field is restored if it still holds what the plan wrote, and deleted
    if it wasn't there before; one that differs blocks its document. Created documents are never deleted. The three must
    hold the same ids; one that any of them lacks has an outcome that says so, and ``require_recoverable`` refuses it.
    """
    there = F.lit(True)
    joined = plan.withColumn("_in_plan", there).join(before.select(key, F.col("fields").alias("_old"), F.col("token").alias("_old_token"), there.alias("_in_before")), key, "full_outer")
    joined = joined.join(current.select(key, F.col("fields").alias("_now"), there.alias("_in_current")), key, "full_outer")
    moved = F.array_sort(F.filter(F.map_keys("patch"), lambda p: ~F.try_element_at("_now", p).eqNullSafe(F.element_at("patch", p))))
    outcome = (
        F.when(F.col("_in_plan").isNull(), "NOT_IN_PLAN").when(F.col("_in_before").isNull(), "BEFORE_IMAGE_MISSING").when(F.col("_in_current").isNull(), "CURRENT_STATE_MISSING")
        .when(F.col("classification").isin("UNCHANGED", "CONFLICT"), "NOTHING_WRITTEN").when(F.col("classification") == "CREATED", "CREATED_DOCUMENT_REQUIRES_MANUAL_REVIEW_NO_DELETE")
        .when(F.col("_old").isNull() | F.col("_now").isNull(), "EXISTENCE_CHANGED").when(F.col("_old_token") != F.col("token"), "BEFORE_IMAGE_VERSION_MISMATCH")
        .when(M.overlapping_paths(F.map_keys("patch")), "OVERLAPPING_PATHS").when(F.size(moved) > 0, "CURRENT_STATE_DIFFERS_FROM_PLANNED_WRITE").otherwise("RESTORE")
    )
    restore = F.map_filter("_old", lambda k, v: F.map_contains_key("patch", k))
    deletes = F.array_sort(F.filter(F.map_keys("patch"), lambda p: ~F.map_contains_key("_old", p)))
    out = joined.withColumn("outcome", outcome)
    ok = F.col("outcome") == "RESTORE"
    return out.select(key, "outcome", F.when(ok, restore).alias("restore"), F.when(ok, deletes).alias("deletes"), F.when(F.col("outcome") == "CURRENT_STATE_DIFFERS_FROM_PLANNED_WRITE", moved).alias("paths"))


def require_recoverable(recovered: DataFrame) -> DataFrame:
    """The recovery plan, if before image, plan and current state hold the same ids."""
    lost = recovered.where(F.col("outcome").isin("NOT_IN_PLAN", "BEFORE_IMAGE_MISSING", "CURRENT_STATE_MISSING")).limit(5).collect()
    if lost:
        raise ContractError(f"ids that not all of before, plan and current hold: {[tuple(r)[:2] for r in lost]}")
    return recovered


def create_only(new: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """The new rows, if none of their ids is in the store."""
    there = new.select(key).join(store.select(key), key, "left_semi").limit(5).collect()
    if there:
        raise ContractError(f"documents exist already: {[r[0] for r in there]}")
    return new


def check_versions(plan: DataFrame, store: DataFrame, key: str, token: str = "token") -> DataFrame:
    """The plan's rows, CONFLICT where the store's version has moved since planning."""
    now = store.select(key, F.col(token).alias("_now"))
    return plan.join(now, key, "left").withColumn("classification", F.when(F.col("_now").isNotNull() & ~F.col("_now").eqNullSafe(F.col(token)), "CONFLICT").otherwise(F.col("classification"))).drop("_now")
