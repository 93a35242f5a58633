"""Samples that come out the same each time: by position, by turns, by stratum, by seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.functions.numbering import global_row_number


def first_middle_last(df: DataFrame, key: str) -> DataFrame:
    """The rows at the first, middle and last place of the order by ``key``."""
    numbered = global_row_number(df, key, "rn")
    total = numbered.agg(F.max("rn").alias("n"))
    return numbered.join(F.broadcast(total), F.col("rn").isin(1, F.floor(F.col("n") / 2) + 1, F.col("n"))).drop("n")


def evenly_spaced(df: DataFrame, key: str, count: int = 7) -> DataFrame:
    """``count`` rows at even distances from first to last, halves rounded to even."""
    numbered = global_row_number(df, key, "rn")
    total = numbered.agg(F.max("rn").alias("n"))
    places = total.select("n", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("i")).select((F.bround(F.col("i") * (F.col("n") - 1) / F.lit(max(1, count - 1)), 0) + 1).cast("bigint").alias("rn")).distinct()
    return numbered.join(F.broadcast(places), "rn")


def round_robin(df: DataFrame, stratum: str, key: str, most: int) -> DataFrame:
    """One row of each stratum in turn, lowest key first, until there are ``most``."""
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(key))
    return df.withColumn("turn", turn).where(F.col("turn") <= most).orderBy("turn", stratum).limit(most)


def _shuffled(key: str, seed: int) -> Column:
    return F.sha1(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))


def stratified(df: DataFrame, stratum: str | Column, key: str, each: int, seed: int) -> DataFrame:
    """``each`` rows of every stratum, in an order that the seed shuffles; fewer where there are fewer."""
    stratum = F.col(stratum) if isinstance(stratum, str) else stratum
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(_shuffled(key, seed), key))
    return df.withColumn("place", place).where(F.col("place") <= each)


def seeded(df: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    return df.orderBy(_shuffled(key, seed), key).limit(count)


def page(df: DataFrame, key: str, start, count: int) -> DataFrame:
    """The next ``count`` rows from ``start`` on; the bound reaches the scan."""
    return df.where(F.col(key) >= start).orderBy(key).limit(count)


def first_reason(df: DataFrame, key: str, priority: str) -> DataFrame:
    """One row for each id, that of the lowest priority number; the others' fields go."""
    others = [c for c in df.columns if c not in (key, priority)]
    best = df.groupBy(key).agg(F.min(F.struct(priority, *others)).alias("_b"))
    return best.select(key, "_b.*")


def merged_candidates(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, sources): ids of all parts with the names of the parts that hold them, sorted."""
    out = None
    for name, part in parts.items():
        named = part.select(key, F.lit(name).alias("source"))
        out = named if out is None else out.unionByName(named)
    return out.groupBy(key).agg(F.array_sort(F.collect_set("source")).alias("sources"))


def key_anchors(keys: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """(anchor): ``n`` keys of digits drawn by a seed between the least and the greatest of ``keys``, which need not hold them."""
    ends = keys.agg(F.min(key).alias("least"), F.max(key).alias("greatest"))
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 12), 16, 10).cast("bigint")
    least, greatest = (F.col(c).cast("bigint") for c in ("least", "greatest"))
    value = least + F.pmod(drawn, greatest - least + 1)
    return keys.sparkSession.range(n).join(F.broadcast(ends)).select(F.lpad(value.cast("string"), F.length("greatest"), F.lit("0")).alias("anchor"))
