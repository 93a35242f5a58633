"""What JSON documents hold: paths, types and shapes, and which path holds known keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators import trees
from wattledger.operators.validate import reasons
from wattledger.scratch import keep


def paths(df: DataFrame, json: str, key: str) -> DataFrame:
    """(key, path, type, value) of every scalar, empty or nested field; list entries share the path ``a[]``.

    All levels of a document are unfolded in its row (``trees.unfold``); a name with dots or brackets stands as ``['name']``.
    """
    rows = trees.unfold(df.select(key, json), json).select(key, F.explode(F.filter("_nodes", lambda x: F.size(x["places"]) > 0)).alias("x"))
    return rows.select(key, trees.path_text(F.col("x.names")).alias("path"), F.col("x.kind").alias("type"), trees.plain_text(F.col("x")).alias("value"))


def field_inventory(df: DataFrame, json: str, key: str) -> DataFrame:
    """(path, documents, missing, nulls, types): how many documents hold each path, and its types.

    One pass over the documents counts their skeletons, which tasks add up before anything is shuffled; skeletons are
    unfolded, of which there are few unless documents are all unlike. A skeleton gives each of its distinct (path, type)
    pairs once, marked where the path is new.
    """
    valid = df.select(F.col(json).alias("json")).where(F.try_parse_json("json").isNotNull())
    counted = keep(valid.groupBy(trees.skeleton(F.col("json")).alias("json")).agg(F.count("*").alias("n")), "skeletons")
    pairs = F.array_sort(F.array_distinct(F.transform(F.filter("_nodes", lambda x: F.size(x["places"]) > 0), lambda x: F.struct(trees.path_text(x["names"]).alias("path"), x["kind"].alias("type")))))
    listed = trees.unfold(counted, "json").select("n", pairs.alias("pairs"))
    marked = F.transform("pairs", lambda x, i: F.struct(x["path"].alias("path"), x["type"].alias("type"), (~F.get("pairs", i - 1)["path"].eqNullSafe(x["path"]) | (i == 0)).alias("new")))
    rows = listed.select("n", F.explode(marked).alias("x")).select("n", "x.*")
    total = df.agg(F.count("*").alias("_all"))
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    grouped = rows.groupBy("path").agg(count(F.col("new")).alias("documents"), count(F.col("type") == "VOID").alias("nulls"), F.array_sort(F.collect_set("type")).alias("types"))
    return grouped.join(F.broadcast(total)).select("path", "documents", (F.col("_all") - F.col("documents")).alias("missing"), "nulls", "types")


def shape(json: Column) -> Column:
    """The sorted root keys of a JSON object, joined by bars; INVALID for anything else."""
    return F.coalesce(F.array_join(F.array_sort(F.json_object_keys(json)), "|"), F.lit("INVALID"))


def rank_key_paths(found: DataFrame, keys: DataFrame, key: str, most: int = 10) -> DataFrame:
    """The paths whose values best cover the known keys: (path, matched_keys, matched_rows), best first.

    found: (path, value) rows of ``paths``.
    """
    hit = found.where("value is not null").join(keys.select(F.col(key).cast("string").alias("value")).distinct(), "value", "left_semi")
    per_key = hit.groupBy("path", "value").agg(F.count("*").alias("n"))
    ranked = per_key.groupBy("path").agg(F.count("*").alias("matched_keys"), F.sum("n").alias("matched_rows"))
    return ranked.orderBy(F.desc("matched_keys"), F.desc("matched_rows"), "path").limit(most)


def issues(rules: list[tuple[str, Column]]) -> Column:
    """Issue codes of a document, in the order of the rules."""
    return reasons(rules)
