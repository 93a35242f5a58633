"""The same measures from several grains must agree; datasets are compared by digest."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.operators.validate import ContractError


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys where the two sides differ: ``side`` tells one that is missing, ``differs`` the unequal measures."""
    a = left.select(*keys, F.lit(True).alias("_a"), *(F.col(m).alias(f"_a_{m}") for m in measures))
    b = right.select(*keys, F.lit(True).alias("_b"), *(F.col(m).alias(f"_b_{m}") for m in measures))
    both = a.join(b, list(keys), "full_outer")
    side = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").otherwise("both")
    differs = F.array_compact(F.array(*(F.when(~F.col(f"_a_{m}").eqNullSafe(F.col(f"_b_{m}")), F.lit(m)) for m in measures)))
    return both.select(*keys, side.alias("side"), differs.alias("differs")).where((F.col("side") != "both") | (F.size("differs") > 0))


MEASURES = ("purchasesCount", "metersCount", "amountTotalC", "costC", "vatC")


def _up(df: DataFrame, meters: Column) -> DataFrame:
    total = lambda c: F.sum(c).cast("bigint").alias(c)
    return df.groupBy("lmPcode", "ym").agg(total("purchasesCount"), meters.cast("bigint").alias("metersCount"), total("amountTotalC"), total("costC"), total("vatC"))


def rollup_differences(monthly: DataFrame, municipalities: DataFrame, groups: DataFrame) -> DataFrame:
    """Municipality months where meters, municipality rows or group rows give other sums."""
    meters = _up(monthly, F.count("*"))
    grouped = _up(groups, F.sum("metersCount"))
    out = [compare(meters, municipalities, ["lmPcode", "ym"], MEASURES).withColumn("against", F.lit("municipality")), compare(meters, grouped, ["lmPcode", "ym"], MEASURES).withColumn("against", F.lit("groups"))]
    return out[0].unionByName(out[1])


def require_equal_rollups(monthly: DataFrame, municipalities: DataFrame, groups: DataFrame) -> None:
    bad = rollup_differences(monthly, municipalities, groups).limit(5).collect()
    if bad:
        raise ContractError(f"roll-ups differ, such as {[r.asDict() for r in bad]}")


def _row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """One text for a row: each value with its length before it, so that no text can pass for two, and a null as a dash."""
    kinds = dict(df.dtypes)
    text = lambda c: F.to_json(F.struct(c)) if kinds[c].startswith(("array", "map", "struct")) else F.col(c).cast("string")
    return F.concat(*(F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in columns))


SPREAD = 1 << 16  # buckets in which parts of 32 bits are added as whole numbers: none overflows below 2^31 rows a bucket


def digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (rows, digest) that doesn't depend on the order of rows: sums of the eight parts of each row's SHA-256.

    Repeated rows count each time. Parts are added as whole numbers in some buckets first, which tasks do before anything is
    shuffled, and as decimals only over the buckets.
    """
    hashed = df.select(F.unhex(F.sha2(_row_text(df, columns).cast("binary"), 256)).alias("h"))
    part = lambda i: F.conv(F.hex(F.substring("h", 4 * i + 1, 4)), 16, 10).cast("bigint")
    names = [f"p{i}" for i in range(8)]
    small = hashed.select(F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("b"), *(part(i).alias(n) for i, n in enumerate(names))).groupBy("b").agg(F.count("*").alias("n"), *(F.sum(n).alias(n) for n in names))
    sums = small.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), *(F.coalesce(F.sum(F.col(n).cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)").alias(n) for n in names))
    return sums.select("rows", F.concat_ws("-", *(F.col(n).cast("string") for n in names)).alias("digest"))


FAN = 16  # branches of a node: a hexadecimal digit of the key's hash
LEAF_ROWS = 4096  # about so many ids below a branch that isn't split any more


def write_tree(df: DataFrame, path: str, key: str, columns: Sequence[str]) -> str:
    """Write a state's tree of digests to ``path``, which comes back.

    Ids are dealt by the hash of their key; each goes with the digest of its row. A branch is a prefix of the hash, as long as
    the table's size asks for; its ids stand in a folder of their own. The nodes above hold counts and sums of digests, so
    that one is made from those below it without the rows.
    """
    spark = df.sparkSession
    length = 1
    n = df.count()
    while FAN**length * LEAF_ROWS < n:
        length += 1
    hashed = F.sha2(F.col(key).cast("string").cast("binary"), 256)
    rows = df.select(F.col(key), F.sha2(_row_text(df, [key, *columns]).cast("binary"), 256).alias("digest"), F.substring(F.coalesce(hashed, F.lit("0" * length)), 1, length).alias("branch"))
    rows.repartition(F.col("branch")).sortWithinPartitions("branch").write.partitionBy("branch").parquet(f"{path}/ids")
    spark.createDataFrame([(length, rows.schema.json())], "levels int, schema string").coalesce(1).write.parquet(f"{path}/shape")
    written = spark.read.schema(rows.schema).parquet(f"{path}/ids")
    # two 60-bit halves of a digest in decimals, which can't overflow
    half = lambda i: F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)")
    leaves = written.groupBy("branch").agg(F.count("*").alias("rows"), *(F.sum(half(i)).cast("decimal(38,0)").alias(f"s{i}") for i in (0, 1)))
    leaves.write.parquet(f"{path}/levels/level={length}")
    for level in range(length - 1, -1, -1):
        below = spark.read.schema(leaves.schema).parquet(f"{path}/levels/level={level + 1}")
        below.groupBy(F.substring("branch", 1, level).alias("branch")).agg(F.sum("rows").alias("rows"), *(F.sum(f"s{i}").cast("decimal(38,0)").alias(f"s{i}") for i in (0, 1))).write.parquet(f"{path}/levels/level={level}")
    return path


def _shape(spark: SparkSession, path: str) -> tuple[int, T.StructType]:
    levels, schema = spark.read.schema("levels int, schema string").parquet(f"{path}/shape").first()
    return levels, T.StructType.fromJson(json.loads(schema))


def differing_branches(spark: SparkSession, left: str, right: str) -> list[str]:
    """The branches below which two trees differ, as long as the shorter tree has them; children are looked at only where their parents differ."""
    open_ = [""]
    for level in range(min(_shape(spark, p)[0] for p in (left, right)) + 1):
        a, b = (spark.read.schema("branch string, rows bigint, s0 decimal(38,0), s1 decimal(38,0)").parquet(f"{p}/levels/level={level}").where(F.substring("branch", 1, max(0, level - 1)).isin(*open_)) for p in (left, right))
        both = a.select("branch", F.struct("rows", "s0", "s1").alias("a")).join(b.select("branch", F.struct("rows", "s0", "s1").alias("b")), "branch", "full_outer")
        open_ = sorted(r[0] for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("branch").collect())  # as many as differ at this level
        if not open_:
            break
    return open_


def tree_differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(key, side) of the ids that differ between two trees: left_only, right_only or differs. Only branches that differ are read."""
    branches = differing_branches(spark, left, right)
    schema = _shape(spark, left)[1]
    key = schema.names[0]
    below = F.substring("branch", 1, len(branches[0])).isin(*branches) if branches else F.lit(False)
    a, b = (spark.read.schema(schema).parquet(f"{p}/ids").where(below) for p in (left, right))
    a, b = (d.groupBy(key).agg(F.array_sort(F.collect_list("digest")).alias(n)) for d, n in ((a, "_a"), (b, "_b")))  # one digest for each key, unless it is repeated
    side = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").otherwise("differs")
    both = a.withColumn("_k", F.struct(key)).drop(key).join(b.withColumn("_k", F.struct(key)).drop(key), "_k", "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(f"_k.{key}", side.alias("side"))


def sorted_id_digest(df: DataFrame, key: str) -> DataFrame:
    """One row (ids, sha256) of the sorted distinct ids as a compact JSON list, as small scopes are named in reports.

    The list is gathered: use ``digest`` for tables of more than some hundred thousand ids.
    """
    ids = F.sort_array(F.collect_set(F.col(key).cast("string")))
    return df.agg(ids.alias("_ids")).select(F.size("_ids").cast("bigint").alias("ids"), F.sha2(F.to_json("_ids"), 256).alias("sha256"))
