"""Which meters a month has, what changed since the month before, and chains of published snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError


def snapshot_delta(cumulative: DataFrame, previous: DataFrame, current: DataFrame, key: str = "meterNo") -> DataFrame:
    """(key, state) of each id in the previous or current snapshot.

    States: unchanged, created (never seen), known_addition (seen before, absent from the previous), missing.
    """
    flag = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    both = flag(previous, "_p").join(flag(current, "_c"), key, "full_outer").join(flag(cumulative, "_k"), key, "left")
    state = F.when(F.col("_p") & F.col("_c"), "unchanged").when(F.col("_p"), "missing").when(F.col("_k"), "known_addition").otherwise("created")
    return both.select(key, state.alias("state"))


def require_subset(part: DataFrame, whole: DataFrame, key: str = "meterNo") -> None:
    extra = part.select(key).join(whole.select(key), key, "left_anti").limit(5).collect()
    if extra:
        raise ContractError(f"not in the cumulative population: {[r[0] for r in extra]}")


def append_only(cumulative: DataFrame, current: DataFrame, key: str = "meterNo") -> DataFrame:
    """The cumulative rows, unchanged, and the current rows of ids that are new; nothing is ever deleted."""
    return cumulative.unionByName(current.join(cumulative.select(key), key, "left_anti").select(*cumulative.columns))


def movement(members: DataFrame, key: str = "meterNo") -> DataFrame:
    """For each month: members, those also in the month before, entered, exited, and known so far.

    Each member and month looks one month back and ahead by joining on the month's neighbour, so that no member's
    history and no month is gathered in one task.
    """
    seen = members.select(key, "ym").distinct()
    before = seen.select(key, S.next_month("ym").alias("ym"), F.lit(1).alias("_was"))
    first = seen.groupBy(key).agg(F.min("ym").alias("ym")).groupBy("ym").agg(F.count("*").alias("new_members"))
    both = seen.withColumn("_is", F.lit(1)).join(before, [key, "ym"], "full_outer")
    is_, was = F.col("_is").isNotNull(), F.col("_was").isNotNull()
    months = both.groupBy("ym").agg(F.count_if(is_).alias("members"), F.count_if(is_ & was).alias("continuing"), F.count_if(is_ & ~was).alias("entered"), F.count_if(~is_ & was).alias("exited"))
    out = months.where("members > 0").join(first, "ym", "left").na.fill(0, ["new_members"])
    return out.withColumn("known", F.sum("new_members").over(Window.orderBy("ym")))  # a row for each month


def replacements(created: DataFrame, cumulative: DataFrame, current: DataFrame, key: str = "meterNo", previous: str = "previousMeterNo") -> DataFrame:
    """(predecessor, successor): newly created meters that name a known meter which the current snapshot lacks."""
    named = created.where(S.clean_text(previous) != "").select(S.meter_no(previous).alias("predecessor"), F.col(key).alias("successor"))
    known = named.join(cumulative.select(F.col(key).alias("predecessor")).distinct(), "predecessor", "left_semi")
    return known.join(current.select(F.col(key).alias("predecessor")).distinct(), "predecessor", "left_anti")


def require_one_to_one(pairs: DataFrame) -> DataFrame:
    twice = pairs.groupBy("predecessor").count().where("count > 1").limit(5).collect()
    if twice:
        raise ContractError(f"replaced more than once: {[r[0] for r in twice]}")
    return pairs


def chain_errors(headers: DataFrame) -> DataFrame:
    """Header rows (ym, sha, previousSha) that don't follow the month before or don't name its digest.

    One row for each month, so the window over all of them is small.
    """
    order = Window.orderBy("ym")
    last_month, last_sha = F.lag("ym").over(order), F.lag("sha").over(order)
    error = F.when(last_month.isNull(), F.when(F.col("previousSha").isNotNull(), F.lit("FIRST_NAMES_PREDECESSOR"))).when(S.next_month(last_month) != F.col("ym"), "MONTH_GAP").when(~F.col("previousSha").eqNullSafe(last_sha), "BROKEN_CHAIN")
    return headers.withColumn("error", error).where("error is not null")


def replacement_errors(members: DataFrame, pairs: DataFrame, key: str = "meterNo") -> DataFrame:
    """Published pairs (ym, predecessor, successor) whose predecessor wasn't active the month before, or whose successor was seen earlier."""
    first = members.groupBy(F.col(key).alias("successor")).agg(F.min("ym").alias("_first"))
    active = members.select(F.col(key).alias("predecessor"), S.next_month("ym").alias("ym"), F.lit(True).alias("_active")).distinct()
    joined = pairs.join(active, ["predecessor", "ym"], "left").join(first, "successor", "left")
    error = F.when(F.col("_active").isNull(), "PREDECESSOR_NOT_ACTIVE").when(F.col("_first") < F.col("ym"), "SUCCESSOR_SEEN_BEFORE")
    return joined.withColumn("error", error).where("error is not null").select("ym", "predecessor", "successor", "error")


def history_membership(members: DataFrame, months: list[str], key: str = "meterNo") -> DataFrame:
    """For each id, in which of the named months it was, as one flag column each."""
    return members.groupBy(key).agg(*(F.max((F.col("ym") == m).cast("int")).alias(f"in_{m.replace('-', '_')}") for m in months))


def complete_exceptions(canonical: DataFrame, classified: DataFrame, covered: DataFrame, key: str = "meterNo") -> DataFrame:
    """Canonical ids that are neither classified nor excepted already."""
    return canonical.select(key).distinct().join(classified.select(key), key, "left_anti").join(covered.select(key), key, "left_anti")
