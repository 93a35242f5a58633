"""Writing a plan in waves: all of a wave or nothing, a stop at the first wave that fails, and exact evidence of what was written.

The store has a version token for each document. An operation fails if its document has moved since the plan was made: a
document to update whose token is another one or that is gone, or one to create that is there. Waves are numbered over
the whole sorted plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.numbering import waves
from wattledger.operators.upsert import apply_plan, require_gate

WAVE = 400


def operations(plan: DataFrame, store: DataFrame, key: str, size: int = WAVE) -> DataFrame:
    """(key, classification, wave, failed): what a plan (key, classification, token) writes, against the store (key, token) as it is now."""
    require_gate(plan)
    numbered = waves(plan.select(key, "classification", F.col("token").alias("_planned")), key, size)
    now = store.select(key, F.col("token").alias("_now"), F.lit(True).alias("_there"))
    met = numbered.where(F.col("classification").isin("CREATED", "UPDATED")).join(now, key, "left")
    there = F.col("_there").isNotNull()
    failed = F.when(F.col("classification") == "CREATED", there).otherwise(~there | ~F.col("_now").eqNullSafe(F.col("_planned")))
    return met.select(key, "classification", "wave", failed.alias("failed"))


def wave_evidence(planned: DataFrame, key: str) -> DataFrame:
    """A row for each wave with operations: counts, first and last id, the digest of its ids, and COMMITTED, FAILED or NOT_ATTEMPTED."""
    ids = F.sort_array(F.collect_list(F.col(key).cast("string")))  # of one wave
    told = planned.groupBy("wave").agg(
        F.count("*").alias("operations"), F.count_if(F.col("classification") == "CREATED").alias("created"), F.count_if(F.col("classification") == "UPDATED").alias("updated"), F.min(key).alias("firstId"), F.max(key).alias("lastId"),
        F.sha2(F.to_json(ids), 256).alias("idsSha256"), F.count_if("failed").alias("changed"),
    )
    first = told.agg(F.min(F.when(F.col("changed") > 0, F.col("wave"))).alias("_first"))
    state = F.when(F.col("_first").isNull() | (F.col("wave") < F.col("_first")), "COMMITTED").when(F.col("wave") == F.col("_first"), "FAILED").otherwise("NOT_ATTEMPTED")
    return told.join(F.broadcast(first)).withColumn("state", state).drop("_first")


def execute(plan: DataFrame, expected: DataFrame, store: DataFrame, key: str, size: int = WAVE) -> tuple[DataFrame, DataFrame]:
    """(the store's documents after the committed waves, the evidence). ``store``: documents with their ``token``."""
    planned = operations(plan, store, key, size)
    evidence = wave_evidence(planned, key)
    done = planned.join(evidence.where("state = 'COMMITTED'").select("wave"), "wave", "left_semi")
    return apply_plan(done, expected, store.drop("token"), key), evidence


def retry_outcomes(plan: DataFrame, store: DataFrame, key: str, size: int = WAVE) -> DataFrame:
    """(key, wave, outcome, attempts) of a run that tries a failed wave once more without what has changed, which becomes a CONFLICT.

    There is no writing document by document: what is left of a wave is written whole in its second attempt.
    """
    planned = operations(plan, store, key, size)
    broken = planned.groupBy("wave").agg(F.count_if("failed").alias("_failed"))
    outcome = F.when(F.col("failed"), "CONFLICT").otherwise("COMMITTED")
    return planned.join(broken, "wave").select(key, "wave", outcome.alias("outcome"), F.when(F.col("_failed") > 0, 2).otherwise(1).alias("attempts"))


def apply_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, key: str, size: int = 200) -> DataFrame:
    """(key, wave, outcome): updates of two stores that go together, both or neither.

    pairs: (key, leftToken, rightToken) as planned; left and right: (key, token) now. A wave is one transaction.
    """
    numbered = waves(pairs, key, size)
    met = numbered.join(left.select(key, F.col("token").alias("_l")), key, "left").join(right.select(key, F.col("token").alias("_r")), key, "left")
    state = F.when(F.col("_l").isNull() | F.col("_r").isNull(), "PAIR_INCOMPLETE").when((F.col("_l") != F.col("leftToken")) | (F.col("_r") != F.col("rightToken")), "PAIR_CHANGED").otherwise("READY")
    judged = met.select(key, "wave", state.alias("state"))
    bad = judged.groupBy("wave").agg(F.count_if(F.col("state") != "READY").alias("_bad"))
    outcome = F.when(F.col("_bad") == 0, "COMMITTED").when(F.col("state") == "READY", "ROLLED_BACK").otherwise(F.col("state"))
    return judged.join(bad, "wave").select(key, "wave", outcome.alias("outcome"))


def seed(new: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """The store with the new documents whose ids it lacks; what is there stays as it is."""
    return store.unionByName(new.join(store.select(key), key, "left_anti").select(*store.columns))


def bulk_get(keys: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Each distinct key with its document's columns and ``found``."""
    return keys.select(key).distinct().join(store.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def rehearsal(plan: DataFrame, expected: DataFrame, captured: DataFrame, key: str, owned: Sequence[str]) -> DataFrame:
    """One row: a plan tried on captured documents. What it would write, and what it must not do: change other fields, lose or add documents, or leave a difference."""
    after = apply_plan(plan, expected, captured, key)
    others = [c for c in captured.columns if c not in (key, *owned)]
    plain = lambda c, kind: F.array_sort(F.map_entries(c)).alias(c) if kind.startswith("map") else F.col(c)  # noqa: E731  maps can't be compared
    side = lambda df, name: df.select(key, F.struct(*(plain(c, kind) for c, kind in df.dtypes if c != key)).alias(name))
    both = side(captured, "old").join(side(after, "new"), key, "full_outer").join(plan.select(key, "classification"), key, "left").join(side(expected, "wanted"), key, "left")
    old, new, kind = F.col("old"), F.col("new"), F.col("classification")
    other = F.lit(False)
    for c in others:
        other = other | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    written = kind.isin("CREATED", "UPDATED")
    return both.agg(
        F.count("*").alias("documents"), F.count_if(written).alias("writes"), F.count_if(new.isNull()).alias("lost"), F.count_if(old.isNull() & ~F.coalesce(kind == "CREATED", F.lit(False))).alias("unplannedCreates"),
        F.count_if(old.isNotNull() & new.isNotNull() & other).alias("otherFieldsChanged"), F.count_if(old.isNotNull() & ~F.coalesce(written, F.lit(False)) & ~old.eqNullSafe(new)).alias("unplannedUpdates"),
        F.count_if(written & ~new.eqNullSafe(F.col("wanted"))).alias("residualDifferences"),
    )
