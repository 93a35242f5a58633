"""A store of documents with versions: a table of one row for each key, changed by commits that name the version they were planned on.

A version is a list of parts: a base, and for each commit since a delta with the rows that it wrote or deleted. Rows carry
the number of the commit that wrote them last, which is the document's token. Readers merge: a key's newest row wins.
Unchanged rows are never written again until ``compact`` makes a new base.

Beside the rows of a part stand two small tables, made in tasks from what was written: the fences (least and greatest key and
cluster values of each file) and Bloom filters of its keys, in blocks of 4 kB. Reads by key, by key range or by cluster values
choose files by them, so that only those are opened; the files that are left are read by Spark's own Parquet reader, with
its pushed filters and pruned columns.

What the driver holds: the entry of a version (a few lines for each part) and the names of the files that a read chose.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattledger.operators.validate import ContractError
from wattledger.scratch import keep
from wattledger.sources.sinks import _path, commit_pointer, exists, pointer, read_text

TOKEN = "_version"
DELETED = "_deleted"
ROWS_PER_FILE = 1_000_000
BLOCK_BITS = 1 << 15  # of a Bloom filter's block, as Spark's bitmap functions have them
KEYS_PER_BLOCK = 3000
PROBES = 7
MOST_POINTS = 10_000  # so many keys are looked up by file; more are joined with the whole store


@dataclass(frozen=True)
class Version:
    """One committed version of the store at ``path``."""

    path: str
    number: int
    entry: dict

    @property
    def key(self) -> str:
        return self.entry["key"]

    @property
    def parts(self) -> list[dict]:
        return self.entry["parts"]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.entry["schema"]))

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(TOKEN, T.LongType()), T.StructField(DELETED, T.BooleanType())])


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version, or the one of a number."""
    log = f"{path}/_entries"
    if number is None:
        number, entry = pointer(spark, log)
    else:
        entry = json.loads(read_text(spark, f"{log}/{number:08d}.json")) if exists(spark, f"{log}/{number:08d}.json") else None
    if entry is None or "parts" not in entry:
        raise ContractError(f"{path} holds no such version of a store")
    return Version(path, number, entry)


def _require_keys(df: DataFrame, key: str) -> None:
    bad = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).limit(5).collect()
    if bad:
        raise ContractError(f"keys that are null or repeated: {[r[0] for r in bad]}")


def _probes(key: str, blocks: Column) -> tuple[Column, Column]:
    """The block of a key in a filter of so many blocks, and its bits there."""
    return F.pmod(F.xxhash64(key), blocks).cast("int"), F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(1, PROBES + 1)))


def _write_part(df: DataFrame, path: str, key: str, cluster: Sequence[str], rows: int, rows_per_file: int) -> dict:
    """Write sorted ranges and then their fences and filters; the part as an entry names it."""
    spark = df.sparkSession
    folder = f"{path}/part-{uuid.uuid4().hex}"
    order = [*cluster, key]
    df.repartitionByRange(max(1, -(-rows // rows_per_file)), *order).sortWithinPartitions(*order).write.parquet(f"{folder}/rows")
    written = spark.read.schema(df.schema).parquet(f"{folder}/rows").select(*order, F.col("_metadata.file_path").alias("file"))
    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in order for f in (F.min, F.max)]
    fences = written.groupBy("file").agg(F.count("*").alias("rows"), *bounds)
    fences.withColumn("blocks", F.ceil(F.col("rows") / KEYS_PER_BLOCK).cast("int")).coalesce(1 if rows < rows_per_file * 10_000 else 16).write.parquet(f"{folder}/fences")
    fences = spark.read.parquet(f"{folder}/fences")
    block, bits = _probes(key, F.col("blocks"))
    probed = written.join(fences.select("file", "blocks"), "file").select("file", block.alias("block"), F.explode(bits).alias("bit"))
    probed.groupBy("file", "block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap")).write.parquet(f"{folder}/filters")
    return {"folder": folder, "rows": rows}


def _discard(spark: SparkSession, folder: str) -> None:
    files, where = _path(spark, folder)
    files.delete(where, True)


def create(df: DataFrame, path: str, key: str, cluster: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> Version:
    """Version 1 of a new store. ``cluster`` columns come before the key in the order of its files."""
    spark = df.sparkSession
    if pointer(spark, f"{path}/_entries")[0]:
        raise ContractError(f"{path} is there already")
    given = keep(df, "created")
    _require_keys(given, key)
    part = _write_part(given.withColumns({TOKEN: F.lit(1).cast("long"), DELETED: F.lit(False)}), path, key, cluster, given.count(), rows_per_file)
    entry = {"key": key, "cluster": list(cluster), "schema": df.schema.json(), "rows_per_file": rows_per_file, "parts": [part]}
    return _commit_entry(spark, path, 1, entry, part["folder"])


def _commit_entry(spark: SparkSession, path: str, number: int, entry: dict, folder: str | None) -> Version:
    try:
        commit_pointer(spark, f"{path}/_entries", number, entry)
    except ContractError:
        if folder:
            _discard(spark, folder)
        raise
    return Version(path, number, entry)


def commit(seen: Version, changed: DataFrame | None = None, deleted: DataFrame | None = None) -> Version:
    """The version after ``seen`` with rows written and keys deleted; an error if another commit came first.

    The new version is visible as a whole once its entry stands under its number, which only one of two writers can take.
    """
    spark = (changed if changed is not None else deleted).sparkSession
    now = pointer(spark, f"{seen.path}/_entries")[0]
    if now != seen.number:
        raise ContractError(f"planned on version {seen.number} of {seen.path}, which is at {now}")
    number = seen.number + 1
    rows = None
    if changed is not None:
        rows = changed.select(*seen.schema.names, F.lit(number).cast("long").alias(TOKEN), F.lit(False).alias(DELETED))
    if deleted is not None:
        gone = deleted.select(*(F.col(seen.key) if f.name == seen.key else F.lit(None).cast(f.dataType).alias(f.name) for f in seen.schema), F.lit(number).cast("long").alias(TOKEN), F.lit(True).alias(DELETED))
        rows = gone if rows is None else rows.unionByName(gone)
    rows = keep(rows, "delta")
    _require_keys(rows, seen.key)
    n = rows.count()
    part = _write_part(rows, seen.path, seen.key, seen.entry["cluster"], n, seen.entry["rows_per_file"]) if n else None
    return _commit_entry(spark, seen.path, number, seen.entry | {"parts": [*seen.parts, *([part] if part else [])]}, part and part["folder"])


def _rows(spark: SparkSession, seen: Version, files: Sequence[str]) -> DataFrame:
    return spark.read.schema(seen.stored).parquet(*files) if files else spark.createDataFrame([], seen.stored)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """The newest row of each key, deleted ones too."""
    others = F.struct(*(c for c in rows.columns if c != key))
    return rows.groupBy(key).agg(F.max_by(others, TOKEN).alias("_r")).select(key, "_r.*")


def _fences(spark: SparkSession, parts: Sequence[dict]) -> DataFrame:
    return spark.read.parquet(*(f"{p['folder']}/fences" for p in parts))


def _names(chosen: DataFrame) -> list[str]:
    return sorted(r[0] for r in chosen.select("file").distinct().collect())


def read(spark: SparkSession, seen: Version, where: Mapping[str, object] | None = None, columns: Sequence[str] | None = None, token: bool = False) -> DataFrame:
    """The rows of a version, with their tokens if asked for.

    ``where`` names values, or pairs of a least and a greatest one, of key or cluster columns: only files of the base whose
    fences admit them are opened. Of the deltas all keys are read, as a newer row can lie outside what is asked for.
    """
    fits = F.lit(True)
    inside = F.lit(True)
    for c, wanted in (where or {}).items():
        least, greatest = wanted if isinstance(wanted, tuple) else (wanted, wanted)
        inside = inside & F.col(c).between(least, greatest)
        fits = fits & (F.col(f"max_{c}") >= F.lit(least)) & (F.col(f"min_{c}") <= F.lit(greatest))
    shown = [*(columns or seen.schema.names), *([TOKEN] if token else [])]
    base, *deltas = seen.parts
    rows = _rows(spark, seen, _names(_fences(spark, [base]).where(fits)) if where else [f"{base['folder']}/rows"]).where(inside)
    if not deltas:
        return rows.where(~F.col(DELETED)).select(*shown)
    written = _rows(spark, seen, [f"{p['folder']}/rows" for p in deltas])
    kept = rows.join(written.select(seen.key), seen.key, "left_anti").where(~F.col(DELETED)).select(*shown)
    return kept.unionByName(_newest(written, seen.key).where(~F.col(DELETED) & inside).select(*shown))


def _candidates(spark: SparkSession, seen: Version, keys: DataFrame) -> DataFrame:
    """(file) of all parts that may hold one of a few keys: by the fences, then by the filters."""
    fences = _fences(spark, seen.parts).select("file", "blocks", F.col(f"min_{seen.key}").alias("_least"), F.col(f"max_{seen.key}").alias("_greatest"))
    between = (F.col(seen.key) >= F.col("_least")) & (F.col(seen.key) <= F.col("_greatest"))
    met = fences.join(F.broadcast(keys.select(seen.key)), between)  # MOST_POINTS keys at most
    block, bits = _probes(seen.key, F.col("blocks"))
    filters = spark.read.parquet(*(f"{p['folder']}/filters" for p in seen.parts))
    probed = met.select("file", block.alias("block"), bits.alias("bits")).join(filters, ["file", "block"])
    byte = lambda at: F.conv(F.hex(F.substr(F.col("bitmap"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.forall("bits", lambda at: F.call_function("shiftright", byte(at), at.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1)
    return probed.where(hit).select("file").distinct()


def get(spark: SparkSession, seen: Version, keys: DataFrame) -> DataFrame:
    """Each distinct key with its document's columns and ``found``.

    Up to ``MOST_POINTS`` keys open only the files that may hold them; more are joined with all rows, which then costs less.
    """
    wanted = keep(keys.select(seen.key).distinct(), "keys")
    if wanted.count() <= MOST_POINTS:
        files = _names(_candidates(spark, seen, wanted.where(F.col(seen.key).isNotNull())))
        rows = _newest(_rows(spark, seen, files).join(F.broadcast(wanted), seen.key, "left_semi"), seen.key).where(~F.col(DELETED)).drop(DELETED, TOKEN)
    else:
        rows = read(spark, seen)
    return wanted.join(rows.withColumn("found", F.lit(True)), seen.key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def windows(spark: SparkSession, seen: Version, anchors: DataFrame, limit: int) -> DataFrame:
    """(anchor, place, row): for each anchor of a short table the first ``limit`` documents in order from it on.

    Each anchor is met with the sorted fences; the files from there on are taken until they hold the limit and as many rows
    more as deltas could hide. For stores without cluster columns; in others a window can reach into every file.
    """
    key, hidden = seen.key, sum(p["rows"] for p in seen.parts[1:])
    base, *deltas = seen.parts
    starts = F.broadcast(keep(anchors.select("anchor").distinct().limit(MOST_POINTS + 1), "anchors"))
    if starts.count() > MOST_POINTS:
        raise ContractError(f"more than {MOST_POINTS} anchors")
    fences = _fences(spark, [base]).select("file", "rows", F.col(f"min_{key}").alias("_least"), F.col(f"max_{key}").alias("_greatest"))
    ahead = fences.join(starts, F.col("_greatest") >= F.col("anchor"))  # fences times a few anchors
    # rows of the files before this one, but for the first, which may hold only keys below the anchor
    order = Window.partitionBy("anchor").orderBy("_least", "_greatest", "file")
    before = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)) - F.first("rows").over(order), F.lit(0))
    more = F.lead("file").over(order).isNotNull()
    chosen = keep(ahead.withColumns({"before": before, "more": more}).where(F.col("before") < limit + hidden).select("anchor", "file", "_greatest", "more"), "chosen")
    base_rows = _rows(spark, seen, _names(chosen)).withColumn("file", F.col("_metadata.file_path")) if not chosen.isEmpty() else _rows(spark, seen, []).withColumn("file", F.lit(""))
    rows = base_rows.join(F.broadcast(chosen.select("anchor", "file")), "file").where(F.col(key) >= F.col("anchor")).drop("file")
    if deltas:
        written = _newest(_rows(spark, seen, [f"{p['folder']}/rows" for p in deltas]), key)
        # up to the last key that the base's files were chosen for, or without an end
        reach = chosen.groupBy("anchor").agg(F.when(F.bool_and("more"), F.max("_greatest")).alias("_reach"))
        wanted = F.broadcast(starts.join(reach, "anchor", "left"))
        near = written.join(wanted, (F.col(key) >= F.col("anchor")) & (F.col("_reach").isNull() | (F.col(key) <= F.col("_reach"))))
        rows = rows.join(written.select(key), key, "left_anti").unionByName(near.select(*rows.columns))
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(key))
    first = rows.where(~F.col(DELETED)).withColumn("place", place).where(F.col("place") <= limit)
    return first.select("anchor", "place", F.struct(*seen.schema.names).alias("row"))


def page(spark: SparkSession, seen: Version, start: object, limit: int) -> DataFrame:
    """The first ``limit`` documents from a key on, in order."""
    anchor = spark.range(1).select(F.lit(start).cast(seen.schema[seen.key].dataType).alias("anchor"))
    return windows(spark, seen, anchor, limit).select("row.*").orderBy(seen.key)


def compact(spark: SparkSession, seen: Version) -> Version:
    """A version with the same rows and tokens in one base."""
    rows = keep(read(spark, seen, token=True).withColumn(DELETED, F.lit(False)), "compacted")
    part = _write_part(rows, seen.path, seen.key, seen.entry["cluster"], rows.count(), seen.entry["rows_per_file"])
    return _commit_entry(spark, seen.path, seen.number + 1, seen.entry | {"parts": [part]}, part["folder"])
