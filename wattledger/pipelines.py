"""Runs from end to end as plain functions over the operators: a month's refresh, an initial load, and a sweep over months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.operators import documents, evidence, execution, upsert
from wattledger.operators.validate import ContractError
from wattledger.scratch import keep
from wattledger.sources import sinks, store


def _preflight(expected: DataFrame, stored: DataFrame, key: str, identity: Sequence[str], owned: Sequence[str], histories: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(plan, counts): the written plan with the token of each stored document, gated and rehearsed. ``stored`` has a ``token``."""
    documents = stored.drop("token")
    classified = upsert.classify(expected, documents, key, identity, owned, histories)
    plan = keep(classified.join(stored.select(key, "token"), key, "left"), "plan")
    counts = upsert.gate(plan)
    upsert.require_gate(plan)
    safety = execution.rehearsal(plan, expected, documents, key, [*owned, *histories]).first()
    broken = [f for f in ("lost", "unplannedCreates", "otherFieldsChanged", "unplannedUpdates") if safety[f]]
    if broken:
        raise ContractError(f"the rehearsal breaks {broken}: {safety.asDict()}")
    return plan, counts.select("planned", "created", "updated", "unchanged")


def _require_waves(waves: DataFrame) -> None:
    failed = waves.where("state <> 'COMMITTED'").orderBy("wave").limit(3).collect()
    if failed:
        raise ContractError(f"waves failed, as documents have moved since the plan; the table is as it was: {[(r['wave'], r['state'], r['changed']) for r in failed]}")


def _with_content_token(rows: DataFrame) -> DataFrame:
    return rows.withColumn("token", F.sha2(F.to_json(F.struct(*rows.columns)).cast("binary"), 256))


def refresh(spark: SparkSession, path: str, expected: DataFrame, key: str, identity: Sequence[str], owned: Sequence[str], histories: Sequence[str] = (), preflight_only: bool = False, size: int = execution.WAVE) -> DataFrame:
    """Bring the guarded table at ``path`` to what is expected: plan, gate, rehearse, write, verify. One row of evidence.

    The plan is written before it is judged, so that what is gated is what is executed. A conflict, a broken safety rule in
    the rehearsal or a failed wave raises before the table's pointer moves. A document's token is the digest of its row. If
    another writer has committed since the plan, the plan goes over that writer's rows, and fails where one of its documents
    has moved; a commit that comes between that look and the write makes the write fail.
    """
    expected = keep(expected, "expected")
    plan, told = _preflight(expected, _with_content_token(sinks.read_table(spark, path)), key, identity, owned, histories)
    if preflight_only:
        return told.withColumns({"written": F.lit(False), "verdict": F.lit("PREFLIGHT_PASSED")})
    number, now = sinks.read_entry(spark, path)
    after, waves = execution.execute(plan, expected, _with_content_token(now), key, size)
    _require_waves(waves)
    sinks.guarded_write(after, path, replace=True, expected=number)
    written = sinks.read_table(spark, path)
    found = upsert.verify(upsert.comparable(expected), upsert.comparable(written), key, [c for c in expected.columns if c != key])
    return told.join(F.broadcast(found.select("verdict"))).withColumn("written", F.lit(True)).select("planned", "created", "updated", "unchanged", "written", "verdict")


def refresh_store(spark: SparkSession, path: str, expected: DataFrame, identity: Sequence[str], owned: Sequence[str], histories: Sequence[str] = (), preflight_only: bool = False, size: int = execution.WAVE) -> DataFrame:
    """The same for a versioned store: only the plan's documents are written, as patches of what is stored, in one commit.

    The verification reads the committed version again: planned documents against what was expected with their histories,
    and the fields that the plan doesn't own against the version before (``preserved`` counts documents where they changed).
    """
    expected = keep(expected, "expected")
    seen = store.version(spark, path)
    key = seen.key
    tokens = lambda v: store.read(spark, v, token=True).withColumnRenamed(store.TOKEN, "token")
    plan, told = _preflight(expected, tokens(seen), key, identity, owned, histories)
    shown = ["planned", "created", "updated", "unchanged", "written", "version", "differing", "preserved", "verdict"]
    if preflight_only:
        return told.withColumns({"written": F.lit(False), "version": F.lit(seen.number).cast("long"), "differing": F.lit(0).cast("long"), "preserved": F.lit(0).cast("long"), "verdict": F.lit("PREFLIGHT_PASSED")}).select(*shown)
    now = store.version(spark, path)
    stored = tokens(now)
    planned = execution.operations(plan, stored.select(key, "token"), key, size)
    _require_waves(execution.wave_evidence(planned, key))
    new = store.commit(now, upsert.apply_patches(plan, expected, stored.drop("token"), key, owned, histories))
    after, before = (upsert.comparable(store.read(spark, v)) for v in (new, now))
    checked = upsert.verify(upsert.comparable(expected), after, key, [c for c in expected.columns if c in (*identity, *owned, *histories)])
    others = [c for c in after.columns if c not in (key, *owned, *histories)]
    changed = before.select(key, F.struct(F.lit(1), *others).alias("_b")).join(after.select(key, F.struct(F.lit(1), *others).alias("_a")), key, "left").where(~F.col("_b").eqNullSafe(F.col("_a")))
    found = checked.select((F.col("missing") + F.col("different")).alias("differing")).join(F.broadcast(changed.agg(F.count("*").alias("preserved"))))
    verdict = F.when((F.col("differing") == 0) & (F.col("preserved") == 0), "PASS").otherwise("FAIL")
    return told.join(F.broadcast(found)).withColumns({"written": F.lit(True), "version": F.lit(new.number).cast("long"), "verdict": verdict}).select(*shown)


def migrate_store(spark: SparkSession, path: str, document: str, provider: str = "conlog", preflight_only: bool = False) -> DataFrame:
    """Bring the old master documents (JSON in the column ``document``) of a store to their canonical form. One row of evidence.

    Planned, gated, written in one commit of the changed documents, and verified by planning again: nothing may be left to
    change, and every other document must be as it was. One conflict stops everything before anything is written.
    """
    seen = store.version(spark, path)
    key = seen.key
    plan = keep(documents.migration_plan(store.read(spark, seen), document, key, provider), "migration")
    counts = upsert.gate(plan)
    told = counts.select("planned", "updated", "unchanged", "conflict")
    if preflight_only:
        return told.withColumns({"written": F.lit(False), "left": F.col("updated"), "touched": F.lit(0).cast("long"), "verdict": F.when(F.col("conflict") == 0, "PREFLIGHT_PASSED").otherwise("BLOCKED")})
    upsert.require_gate(plan)
    now = store.version(spark, path)
    stored = store.read(spark, now)
    todo = plan.where("classification = 'UPDATED'").select(key, "canonical")
    new = store.commit(seen, stored.join(todo, key).withColumn(document, F.col("canonical")).drop("canonical")) if now.number == seen.number else None
    if new is None:
        raise ContractError(f"planned on version {seen.number} of {path}, which is at {now.number}")
    after = store.read(spark, new)
    again = documents.migration_plan(after, document, key, provider).agg(F.count_if(F.col("classification") != "UNCHANGED").alias("left"))
    others = after.join(todo.select(key), key, "left_anti").select(key, F.col(document).alias("_now")).join(stored.select(key, F.col(document).alias("_then")), key, "full_outer").join(todo.select(key), key, "left_anti")
    touched = others.agg(F.count_if(~F.col("_now").eqNullSafe(F.col("_then"))).alias("touched"))
    checked = told.join(F.broadcast(again)).join(F.broadcast(touched))
    return checked.withColumns({"written": F.lit(True), "verdict": F.when((F.col("left") == 0) & (F.col("touched") == 0), "PASS").otherwise("FAIL")}).select("planned", "updated", "unchanged", "conflict", "written", "left", "touched", "verdict")


def initial_load(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]], folder: str) -> DataFrame:
    """Load tables, named with their keys, into an empty folder, all or none; a row of evidence for each, and a pointer that names them."""
    if sinks.pointer(spark, f"{folder}/current")[1] is not None:
        raise ContractError(f"{folder} has been loaded before")
    for name, (df, key) in tables.items():
        if not df.groupBy(key).count().where(f"count > 1 or {key} is null").isEmpty():
            raise ContractError(f"{name}: {key} isn't unique")
    version = sinks.publish({name: df for name, (df, _) in tables.items()}, folder, None)
    return sinks.run_summary({name: df for name, (df, _) in tables.items()}, version=version)


def sweep(plan: DataFrame, month: str = "ym") -> DataFrame:
    """(month, planned, conflicts, state) of a plan over many months, in one job: PASS until a month has a conflict, that month FAIL, later ones NOT_RUN."""
    counts = plan.groupBy(month).agg(F.count("*").alias("planned"), F.count_if(~F.col("classification").isin(*upsert.STATES) | (F.col("classification") == "CONFLICT")).alias("conflicts"))
    first = counts.agg(F.min(F.when(F.col("conflicts") > 0, F.col(month))).alias("_first"))
    state = F.when(F.col("_first").isNull() | (F.col(month) < F.col("_first")), "PASS").when(F.col(month) == F.col("_first"), "FAIL").otherwise("NOT_RUN")
    return counts.join(F.broadcast(first)).withColumn("state", state).drop("_first")


def require_report(report: DataFrame, stage: str, mode: str) -> DataFrame:
    """A child stage's report (stage, mode, status, fingerprint), if there is one row, it passed, and it is of this stage and mode."""
    rows = report.where(F.col("stage") == stage).limit(2).collect()
    if len(rows) != 1 or rows[0]["status"] != "PASS" or rows[0]["mode"] != mode:
        raise ContractError(f"no passed report of {stage} in mode {mode}: {[r.asDict() for r in rows]}")
    evidence.require_sha(rows[0]["fingerprint"])
    return report
