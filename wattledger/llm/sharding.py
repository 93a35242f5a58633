"""Size-tiered compaction of a sharded table, with versions committed atomically.

A table is a folder: ``data/`` holds immutable Parquet shards, ``manifest/v00000001`` and so on hold one row for each
shard that is live in that version. An arrival is appended as small shards. Compaction sorts shards into tiers by
size; where a tier below the target size holds at least ``fanout`` shards, they are merged into files of the target
size. Neither step shuffles: rows go from the shards that a task reads to the file that it writes.

A version becomes visible by one rename of its finished manifest folder, which fails if another writer has taken the
number. Readers of older versions keep theirs until ``vacuum`` deletes the shards that only old versions name.

Defined results: rows are kept as they are, with nulls, long texts, repeated rows and any columns; an empty arrival
commits a version without new shards; an empty table reads as no rows with the table's schema.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 128 << 20
FANOUT = 4
LEAST_BYTES = 64 << 10  # sizes below this share the lowest tier

MANIFEST = "path string, bytes long, rows long, tier int, since int, schema string"


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one wanted."""


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> int:
    """The newest committed version; 0 for a table without any."""
    folder = _path(spark, f"{root}/manifest")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdecimal()), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(path, bytes, rows, tier, since) of the shards live in ``version``; the latest by default."""
    return _manifest(spark, root, version).where("path is not null").drop("schema")


def _manifest(spark: SparkSession, root: str, version: int | None) -> DataFrame:
    version = latest_version(spark, root) if version is None else version
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v{version:08d}")


def _tier(size, target: int, fanout: int):
    """0 for the smallest shards, one more for every ``fanout`` times that size, and -1 for shards of the target size."""
    grown = F.floor(F.log(F.greatest(size, F.lit(LEAST_BYTES)) / F.lit(LEAST_BYTES)) / F.log(F.lit(float(fanout))) + F.lit(1e-9))
    return F.when(size >= F.lit(target // 2), F.lit(-1)).otherwise(grown.cast("int"))


def _shards(spark: SparkSession, folder: str, since: int, target: int, fanout: int) -> DataFrame:
    """Manifest rows of the files in ``folder``; only footers and row counts are read."""
    found = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    counted = found.groupBy("path").agg(F.max("bytes").alias("bytes"), F.count("*").alias("rows"))
    return counted.select("path", "bytes", "rows", _tier(F.col("bytes"), target, fanout).alias("tier"), F.lit(since).alias("since"), F.lit(None).cast("string").alias("schema"))


def _commit(spark: SparkSession, root: str, version: int, rows: DataFrame) -> int:
    """Make ``rows`` the manifest of ``version`` by one rename that refuses to overwrite."""
    hidden, final = f"{root}/manifest/_{uuid.uuid4().hex}", f"{root}/manifest/v{version:08d}"
    rows.coalesce(1).write.parquet(hidden)
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, final).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, hidden), _path(spark, final), options)
    except Py4JJavaError as error:
        _files(spark, hidden).delete(_path(spark, hidden), True)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()) or _files(spark, final).exists(_path(spark, final)):
            raise CommitConflict(f"version {version} of {root} is taken") from error
        raise
    return version


def append(df: DataFrame, root: str, arrival=None, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT) -> int:
    """Commit the rows of ``df`` as new small shards; returns the version.

    ``arrival``, a column, keeps rows that arrived apart in shards of their own.
    """
    spark = df.sparkSession
    version = latest_version(spark, root)
    folder = f"{root}/data/append-{uuid.uuid4().hex}"
    writer = df.write
    if arrival is not None:
        name = "arrival"
        while name.lower() in {c.lower() for c in df.columns}:
            name = f"_{name}"
        writer = df.withColumn(name, arrival).write.partitionBy(name)
    writer.option("compression", "zstd").parquet(folder)
    added = _shards(spark, folder, version + 1, target_bytes, fanout)
    old = _manifest(spark, root, version) if version else spark.createDataFrame([(None, 0, 0, 0, 1, df.schema.json())], MANIFEST)
    return _commit(spark, root, version + 1, old.unionByName(added))


def compaction_plan(spark: SparkSession, root: str, fanout: int = FANOUT) -> DataFrame:
    """(tier, shards, bytes, paths): the runs of similarly sized shards that are worth a merge."""
    live = manifest(spark, root).where("tier >= 0")
    runs = live.groupBy("tier").agg(F.count("*").alias("shards"), F.sum("bytes").alias("bytes"), F.sort_array(F.collect_list("path")).alias("paths"))
    return runs.where(F.col("shards") >= fanout)


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT) -> int:
    """Merge each run of the plan into files of about ``target_bytes``; returns the version, the old one without a run."""
    version = latest_version(spark, root)
    plan, merged = compaction_plan(spark, root, fanout), []
    for run in plan.collect():  # a row for each tier, and paths of shards below the target
        folder = f"{root}/data/merge-{uuid.uuid4().hex}"
        rows = _read(spark, root, run["paths"])
        rows.coalesce(max(1, round(run["bytes"] / target_bytes))).write.option("compression", "zstd").parquet(folder)
        merged.append(_shards(spark, folder, version + 1, target_bytes, fanout))
    if not merged:
        return version
    gone = plan.select(F.explode("paths").alias("path"))
    rows = _manifest(spark, root, version).join(gone, "path", "left_anti").select(*_manifest(spark, root, version).columns)
    for more in merged:
        rows = rows.unionByName(more)
    return _commit(spark, root, version + 1, rows)


def schema(spark: SparkSession, root: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(_manifest(spark, root, None).where("path is null").first()["schema"]))


def _read(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    kind = schema(spark, root)
    return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, from the shards that its manifest names."""
    return _read(spark, root, [r["path"] for r in manifest(spark, root, version).select("path").collect()])


def vacuum(spark: SparkSession, root: str, keep_from: int) -> int:
    """Delete shards and manifests of versions before ``keep_from`` that no kept version needs; returns how many shards."""
    last = latest_version(spark, root)
    kept = {r["path"] for v in range(keep_from, last + 1) for r in manifest(spark, root, v).select("path").collect()}
    gone = set()
    for v in range(1, keep_from):
        place = _path(spark, f"{root}/manifest/v{v:08d}")
        if _files(spark, root).exists(place):
            gone |= {r["path"] for r in manifest(spark, root, v).select("path").collect()} - kept
            _files(spark, root).delete(place, True)
    for path in gone:
        _files(spark, path).delete(_path(spark, path), False)
    return len(gone)
