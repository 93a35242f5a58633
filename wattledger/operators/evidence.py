"""Evidence that a run rests on: manifests with fingerprints, chains of stages, admission of packages, and what a month needs to be published."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators.reconcile import digest
from wattledger.operators.validate import ContractError, Rules, computed, reasons

SHA = "^[0-9a-f]{64}$"
MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"


def require_month(month: str) -> str:
    if not re.fullmatch(MONTH.strip("^$"), month or ""):
        raise ContractError(f"{month!r} is no month")
    return month


def require_sha(value: str) -> str:
    if not re.fullmatch(SHA.strip("^$"), value or ""):
        raise ContractError(f"{value!r} is no SHA-256")
    return value


def require_scope(given: str, confirmed: str, allowed: Sequence[str]) -> str:
    """A target that is named twice alike and is an allowed one."""
    if given != confirmed or given not in allowed:
        raise ContractError(f"{given!r}, confirmed as {confirmed!r}, is none of {list(allowed)}")
    return given


def manifest(stage: str, output: DataFrame, inputs: DataFrame | None = None) -> DataFrame:
    """(stage, rows, digest, inputs, fingerprint) of a stage's output; ``inputs`` are the manifests it was built from."""
    made = digest(output, output.columns).select(F.lit(stage).alias("stage"), "rows", "digest")
    if inputs is None:
        told = made.withColumn("inputs", F.array().cast("array<struct<stage: string, digest: string>>"))
    else:
        used = inputs.agg(F.array_sort(F.collect_list(F.struct("stage", "digest"))).alias("inputs"))  # a row for each input
        told = made.join(F.broadcast(used))
    return told.withColumn("fingerprint", F.sha2(F.to_json(F.struct("stage", "rows", "digest", "inputs")), 256))


def chain_errors(manifests: DataFrame, order: Sequence[str]) -> DataFrame:
    """(stage, code, input) of what breaks a chain of manifests: a stage that is missing or there twice, a fingerprint that isn't its content's, an input that is unknown, later, or has another digest."""
    stages = manifests.sparkSession.createDataFrame([(s, i) for i, s in enumerate(order)], "stage string, place int")
    counts = stages.join(manifests.groupBy("stage").agg(F.count("*").alias("n")), "stage", "left")
    lost = counts.where(F.coalesce("n", F.lit(0)) != 1).select("stage", F.when(F.col("n").isNull(), "STAGE_MISSING").otherwise("STAGE_REPEATED").alias("code"), F.lit(None).cast("string").alias("input"))
    forged = manifests.where(F.col("fingerprint") != F.sha2(F.to_json(F.struct("stage", "rows", "digest", "inputs")), 256)).select("stage", F.lit("FINGERPRINT_MISMATCH").alias("code"), F.lit(None).cast("string").alias("input"))
    named = manifests.join(stages, "stage").select("stage", "place", F.explode("inputs").alias("i")).select("stage", "place", F.col("i.stage").alias("input"), F.col("i.digest").alias("wanted"))
    known = manifests.join(stages, "stage").select(F.col("stage").alias("input"), F.col("place").alias("_place"), F.col("digest").alias("_digest"))
    met = named.join(known, "input", "left")
    code = F.when(F.col("_digest").isNull(), "INPUT_UNKNOWN").when(F.col("_place") >= F.col("place"), "INPUT_NOT_EARLIER").when(F.col("_digest") != F.col("wanted"), "INPUT_DIGEST_MISMATCH")
    return lost.unionByName(forged).unionByName(met.withColumn("code", code).where("code is not null").select("stage", "code", "input"))


def require_chain(manifests: DataFrame, order: Sequence[str]) -> DataFrame:
    bad = chain_errors(manifests, order).limit(5).collect()
    if bad:
        raise ContractError(f"the chain of manifests is broken: {[tuple(r) for r in bad]}")
    return manifests


def resume_allowed(report: DataFrame, current: DataFrame) -> DataFrame:
    """(stage, state): may a run go on from a report? Only if it stopped halfway and its manifest is today's."""
    both = report.select("stage", F.col("fingerprint").alias("_then"), "status").join(current.select("stage", F.col("fingerprint").alias("_now")), "stage", "left")
    state = F.when(F.col("_now").isNull(), "UNKNOWN_STAGE").when(F.col("_then") != F.col("_now"), "FINGERPRINT_CHANGED").when(F.col("status") == "PASS", "ALREADY_COMPLETE").otherwise("MAY_RESUME")
    return both.select("stage", state.alias("state"))


def executed_month_rules() -> Rules:
    """What the report of an executed month must fulfil to be published, over the columns of ``executed_months``."""
    c = F.col
    sha = lambda name: ~F.coalesce(c(name), F.lit("")).rlike(SHA)
    writes = c("created") + c("updated")
    counts = ("rowsRead", "inspected", "created", "updated", "unchanged", "conflicts", "failures", "writeAttempts", "writeSuccesses", "wavesAttempted", "wavesCommitted")
    return [
        ("MONTH_INVALID", ~F.coalesce(c("month"), F.lit("")).rlike(MONTH)), ("SNAPSHOT_SHA_INVALID", sha("snapshotSha256")), ("SOURCE_SHA_INVALID", sha("sourceSha256")), ("MEMBERS_EMPTY", F.size("members") <= 0),
        ("MEMBERS_NOT_CANONICAL", F.exists("members", lambda m: ~m.rlike("^[A-Z0-9]+$"))), ("MEMBERS_NOT_SORTED_AND_UNIQUE", ~F.array_sort(F.array_distinct("members")).eqNullSafe(c("members"))),
        ("REPLACEMENT_NOT_TERMINAL", F.exists("replacements", lambda r: F.array_contains("members", r["predecessor"]) | ~F.array_contains("members", r["successor"]) | (r["predecessor"] == r["successor"]))),
        ("REPLACEMENT_NOT_ONE_TO_ONE", (F.size(F.array_distinct(F.transform("replacements", lambda r: r["predecessor"]))) < F.size("replacements")) | (F.size(F.array_distinct(F.transform("replacements", lambda r: r["successor"]))) < F.size("replacements"))),
        ("COMPLETENESS_NOT_ATTESTED", ~F.coalesce("complete", F.lit(False))), ("REPORT_NOT_PASSED", (c("status") != "PASS") | (c("result") != "REFRESH_VERIFIED")), ("PREFLIGHT_ONLY", F.coalesce("preflightOnly", F.lit(True))), ("GATE_NOT_PASSED", ~F.coalesce("gatePassed", F.lit(False))),
        ("REPORT_OF_ANOTHER_MONTH", ~c("governedMonth").eqNullSafe(c("month"))), ("REPORT_OF_ANOTHER_SNAPSHOT", ~c("populationSnapshotSha256").eqNullSafe(c("snapshotSha256"))), ("CATEGORY_PACKAGE_MISSING", sha("categoryPackageSha256")),
        ("COUNTER_INVALID", F.exists(F.array(*(c(n).cast("bigint") for n in counts)), lambda n: n.isNull() | (n < 0))), ("CLASSIFICATION_INCOMPLETE", (c("rowsRead") <= 0) | (c("inspected") != c("rowsRead"))),
        ("SCOPE_INCOMPLETE", ~F.array_sort(F.array_distinct("scope")).eqNullSafe(c("scope")) | (F.size("scope") != c("rowsRead"))), ("SCOPE_SHA_MISMATCH", ~c("scopeSha256").eqNullSafe(F.sha2(F.to_json("scope"), 256))),
        ("MEMBERS_OUTSIDE_SCOPE", F.size(F.array_except("members", "scope")) > 0), ("CONFLICTS_OR_FAILURES", (c("conflicts") != 0) | (c("failures") != 0)), ("ACCOUNTING_IMBALANCE", writes + c("unchanged") != c("rowsRead")),
        ("WRITE_IMBALANCE", (c("writeAttempts") != writes) | (c("writeSuccesses") != writes)), ("WAVES_PARTIAL", (c("wavesAttempted") != c("wavesCommitted")) | ((writes > 0) & ((c("wavesCommitted") < 1) | (writes > 400 * c("wavesCommitted")))) | ((writes == 0) & (c("wavesCommitted") != 0))),
        ("NOT_FULLY_VERIFIED", (c("verification") != "PASS") | (c("verified") != c("rowsRead"))), ("PRESERVATION_BROKEN", sha("preservedBefore") | ~c("preservedBefore").eqNullSafe(c("preservedAfter"))), ("RECOVERY_EVIDENCE_MISSING", sha("recoverySha256") | (c("recoveryRecords") != c("rowsRead"))),
        ("PLAN_EVIDENCE_MISSING", sha("planSha256") | (c("planRecords") != c("rowsRead"))),
    ]


def executed_month_issues(months: DataFrame) -> DataFrame:
    """(month, issues) of each executed month: codes of the rules that its snapshot and report break."""
    return months.select("month", reasons(executed_month_rules()).alias("issues"))


def publication(months: DataFrame, baseline: str) -> DataFrame:
    """(month, snapshotSha256, state) of months in order: PUBLISHED while every month before is sound, begins at the baseline, follows the month before and names its digest; BLOCKED from the first that doesn't on."""
    order = Window.orderBy("month")  # a row for each month
    judged = computed(months, issues=reasons(executed_month_rules()), before=F.lag("month").over(order), shaBefore=F.lag("snapshotSha256").over(order))
    follows = F.when(F.col("before").isNull(), (F.col("month") == baseline) & F.col("previousSnapshotSha256").isNull()).otherwise((S.next_month("before") == F.col("month")) & F.col("previousSnapshotSha256").eqNullSafe(F.col("shaBefore")))
    sound = (F.size("issues") == 0) & F.coalesce(follows, F.lit(False))
    bad = F.max((~sound).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return judged.select("month", "snapshotSha256", F.when(bad == 0, "PUBLISHED").otherwise("BLOCKED").alias("state"))


def admit_package(package: DataFrame, members: DataFrame, predecessor: DataFrame, month: str, key: str = "meterNo") -> DataFrame:
    """(key, code) of what keeps a month's category package out: ids the month's population lacks, members without a category or exception, ids listed twice, and values that aren't valid.

    package: (key, value, exception); members: (key) of the month; predecessor: (key, ym) of packages before. An exception
    may not have a value, and a member of the month before must have a history or an exception.
    """
    listed = package.groupBy(key).agg(F.count("*").alias("_n"), F.max("value").alias("_value"), F.max("exception").alias("_exception"))
    before = predecessor.where(F.col("ym") == S.next_month(F.lit(month), -1)).select(key, F.lit(True).alias("_before")).distinct()
    both = listed.join(members.select(key, F.lit(True).alias("_member")).distinct(), key, "full_outer").join(before, key, "left")
    code = (
        F.when(F.col("_member").isNull(), "NOT_A_MEMBER").when(F.col("_n").isNull(), "MEMBER_NOT_LISTED").when(F.col("_n") > 1, "LISTED_TWICE").when(F.col("_value").isNotNull() & F.col("_exception").isNotNull(), "VALUE_AND_EXCEPTION")
        .when(F.col("_value").isNull() & F.col("_exception").isNull(), "NEITHER_VALUE_NOR_EXCEPTION").when(F.col("_value").isNotNull() & (S.category_bucket("_value") == "OTHER"), "VALUE_INVALID").when(F.col("_value").isNotNull() & F.col("_before").isNull(), "NO_HISTORY")
    )
    return both.withColumn("code", code).where("code is not null").select(key, "code")


def released_months(members: DataFrame, sums: DataFrame, key: str = "meterNo") -> DataFrame:
    """What a release of several months holds: (month, members, added, removed, changed, packageSha256), each month against the one before.

    members and sums: (key, ym, value). ``packageSha256`` doesn't depend on the order of rows.
    """
    now = sums.select(key, "ym", "value")
    before = sums.select(key, S.next_month("ym").alias("ym"), F.col("value").alias("_old"))
    both = now.join(before, [key, "ym"], "full_outer")
    part = lambda i: F.sum(F.conv(F.substring(F.sha2(F.concat_ws("|", F.length(key), F.col(key), F.col("value").cast("string")), 256), 8 * i + 1, 8), 16, 10).cast("decimal(20,0)"))
    moved = both.groupBy("ym").agg(F.count("value").alias("members"), F.count_if(F.col("_old").isNull()).alias("added"), F.count_if(F.col("value").isNull()).alias("removed"), F.count_if(F.col("value") != F.col("_old")).alias("changed"), *(part(i).cast("string").alias(f"_p{i}") for i in range(4)))
    known = members.select("ym").distinct()
    return moved.join(known, "ym", "left_semi").select(F.col("ym").alias("month"), "members", "added", "removed", "changed", F.concat_ws("-", *(f"_p{i}" for i in range(4))).alias("packageSha256"))


def require_all_clear(issues: DataFrame, column: str = "issues") -> Column:
    """Raise for the first rows with issues."""
    bad = issues.where(F.size(column) > 0).limit(5).collect()
    if bad:
        raise ContractError(f"blocked: {[r.asDict() for r in bad]}")
    return F.lit(True)
