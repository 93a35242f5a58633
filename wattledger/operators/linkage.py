"""Meters to accounts, accounts to parcel keys, and parcel keys to parcels, with the reason where a hop fails.

Each right side is grouped by its join key before the join, so that a hop never multiplies rows; how many candidates a
key has is part of the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import scalars as S

RULES = ("EXACT_FORMAT", "APPEND_ONE_TRAILING_ZERO")


def resolve_keys(keys: DataFrame, lookup: DataFrame, key: str = "gisKey", parcel: str = "erfId") -> DataFrame:
    """(key, parcels, rule): the parcels whose key is equal, or equal after one appended zero.

    Two equi-joined forms of each key, not one join with an or.
    """
    forms = F.array(F.struct(F.col(key).alias("form"), F.lit(RULES[0]).alias("rule")), F.struct(F.concat(key, F.lit("0")).alias("form"), F.lit(RULES[1]).alias("rule")))
    tried = keys.select(key).distinct().select(key, F.explode(forms).alias("f")).select(key, "f.form", "f.rule")
    known = lookup.groupBy(F.col(key).alias("form")).agg(F.collect_set(parcel).alias("found"))
    hit = tried.join(known, "form", "left").groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("parcels"), F.collect_set(F.when(F.col("found").isNotNull(), F.col("rule"))).alias("rules"))
    rule = F.when(F.size("parcels") == 0, "NO_MATCH").when(F.size("rules") > 1, "MULTIPLE_COMPARISON_FORMATS").otherwise(F.get("rules", F.lit(0)))
    return hit.select(key, "parcels", rule.alias("rule"))


def link_meters(meters: DataFrame, bridge: DataFrame, lookup: DataFrame) -> DataFrame:
    """Meters (meterNo, accountNo) with their only parcel, a public status and a detail status.

    bridge: (accountNo, gisKey); lookup: (gisKey, erfId).
    """
    accounts = bridge.where(S.clean_text("accountNo") != "").groupBy("accountNo").agg(F.array_sort(F.collect_set(F.when(F.col("gisKey") != "", F.col("gisKey")))).alias("gisKeys"))
    single = accounts.select("accountNo", "gisKeys", F.when(F.size("gisKeys") == 1, F.col("gisKeys")[0]).alias("gisKey"))
    found = resolve_keys(single.where("gisKey is not null"), lookup)
    joined = meters.join(single, "accountNo", "left").join(found, "gisKey", "left")
    n_keys, n = F.size("gisKeys"), F.size("parcels")
    detail = (
        F.when(S.clean_text("accountNo") == "", "BLANK_ACCOUNT").when(F.col("gisKeys").isNull(), "ACCOUNT_NOT_IN_BRIDGE").when(n_keys == 0, "ACCOUNT_HAS_NO_GIS_KEY")
        .when(n_keys > 1, "ACCOUNT_MULTIPLE_GIS_KEYS").when(n == 0, "GIS_KEY_NOT_FOUND_IN_PIPELINE").when(n > 1, "GIS_KEY_MULTIPLE_ERFS").otherwise("EXACT_ONE_TO_ONE")
    )
    out = joined.withColumn("detailStatus", detail)
    return out.select("meterNo", "accountNo", F.when(F.col("detailStatus") == "EXACT_ONE_TO_ONE", F.col("parcels")[0]).alias("erfId"), public_status(F.col("detailStatus")).alias("status"), "detailStatus", F.coalesce("rule", F.lit("NONE")).alias("rule"))


def public_status(detail: Column) -> Column:
    return (
        F.when(detail == "BLANK_ACCOUNT", "BLANK_ACCOUNT_NUMBER").when(detail == "ACCOUNT_NOT_IN_BRIDGE", "ACCOUNT_NOT_FOUND_IN_ELM")
        .when(detail.isin("ACCOUNT_HAS_NO_GIS_KEY", "GIS_KEY_NOT_FOUND_IN_PIPELINE"), "ERF_NUMBER_NOT_FOUND_IN_PIPELINE_LOOKUP")
        .when(detail.isin("ACCOUNT_MULTIPLE_GIS_KEYS", "GIS_KEY_MULTIPLE_ERFS"), "PARTIAL_ERF_LOOKUP_MATCH").otherwise("MATCHED_SINGLE_GPS")
    )


def alias_join(given: DataFrame, canonical: DataFrame, key: str = "meterNo", aliases: bool = True) -> DataFrame:
    """(given, canonical, match): exact first, else the only canonical id that differs in leading zeros alone.

    match is EXACT, ALIASED, AMBIGUOUS or UNMATCHED; every given id keeps its row.
    """
    bare = lambda c: F.regexp_replace(c, "^0+", "")
    exact = given.select(F.col(key).alias("given")).join(canonical.select(F.col(key).alias("given"), F.col(key).alias("_exact")).distinct(), "given", "left")
    if not aliases:
        return exact.select("given", F.col("_exact").alias("canonical"), F.when(F.col("_exact").isNotNull(), "EXACT").otherwise("UNMATCHED").alias("match"))
    by_bare = canonical.select(key).distinct().groupBy(bare(F.col(key)).alias("_bare")).agg(F.min(key).alias("_only"), F.count("*").alias("_n"))
    joined = exact.withColumn("_bare", bare(F.col("given"))).join(by_bare, "_bare", "left")
    match = F.when(F.col("_exact").isNotNull(), "EXACT").when(F.col("_n") == 1, "ALIASED").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("UNMATCHED")
    return joined.withColumn("match", match).select("given", F.when(F.col("match") == "EXACT", F.col("_exact")).when(F.col("match") == "ALIASED", F.col("_only")).alias("canonical"), "match")


def parcel_evidence(rows: DataFrame, parcels: DataFrame, lm: str | Column) -> DataFrame:
    """(masterId, erfId, reason): rows with one usable candidate whose parcel the authority confirms; else why not.

    rows: (masterId, candidates array of (ErfId, ErfNumber, LmPcode), hasUsableGps); parcels: (erfId, parcelKey, erfNo).
    """
    lm = F.lit(lm) if isinstance(lm, str) else lm
    uses = parcels.where(F.col("parcelKey") != "").groupBy("parcelKey").agg(F.count("*").alias("_uses"))
    authority = parcels.join(uses, "parcelKey", "left").select(F.col("erfId").alias("_id"), F.col("parcelKey").alias("_key"), F.col("erfNo").alias("_no"), "_uses", F.lit(True).alias("_there"))
    one = rows.withColumn("_c", F.when(F.coalesce(F.size("candidates"), F.lit(0)) == 1, F.col("candidates")[0]))
    joined = one.join(authority, F.col("_c.ErfId") == F.col("_id"), "left")
    reason = (
        F.when(F.coalesce(F.size("candidates"), F.lit(0)) != 1, "NO_SINGLE_AUTHORITATIVE_CANDIDATE").when(F.col("_c").isNull(), "MALFORMED_CANDIDATE")
        .when(~F.coalesce("hasUsableGps", F.lit(False)), "SOURCE_GPS_NOT_VALIDATED").when(F.col("_there").isNull(), "CANDIDATE_NOT_IN_AUTHORITATIVE_ERF_SOURCE")
        .when((S.clean_text("_key") == "") | (S.clean_text("_no") == ""), "AUTHORITATIVE_PARCEL_FIELDS_INCOMPLETE").when(F.col("_uses") != 1, "AMBIGUOUS_AUTHORITATIVE_PARCEL_KEY")
        .when(~F.col("_c.LmPcode").eqNullSafe(lm), "CANDIDATE_LM_MISMATCH").when(S.clean_text("_c.ErfNumber") != S.clean_text("_no"), "CANDIDATE_ERF_NUMBER_MISMATCH")
    )
    return joined.withColumn("reason", reason).select("masterId", F.when(F.col("reason").isNull(), F.col("_id")).alias("erfId"), "reason")


def bridge_profile(bridge: DataFrame) -> DataFrame:
    """One row: rows, blank accounts, blank keys, distinct pairs, repeated rows, and accounts with several keys."""
    account, key = S.clean_text("accountNo"), S.clean_text("gisKey")
    pairs = bridge.groupBy(account.alias("a"), key.alias("k")).agg(F.count("*").alias("n"))
    accounts = pairs.groupBy("a").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("k") == "", F.col("n")).otherwise(0)).alias("blank_keys"), F.count_if(F.col("k") != "").alias("keys"), F.count("*").alias("pairs"))
    return accounts.agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("a") == "", F.col("n")).otherwise(0)).alias("blank_accounts"), F.sum("blank_keys").alias("blank_keys"),
        F.sum("pairs").alias("distinct_pairs"), F.sum(F.col("n") - F.col("pairs")).alias("repeated_rows"), F.count_if((F.col("a") != "") & (F.col("keys") > 1)).alias("accounts_with_several_keys"),
    )
