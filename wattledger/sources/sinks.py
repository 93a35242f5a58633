"""Writers that prove what they write: guarded, content-addressed, and published by a pointer that moves last."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.functions import scalars as S
from wattledger.operators.reconcile import digest
from wattledger.operators.validate import ContractError


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    files, path = _path(spark, name)
    return files.exists(path)


def read_text(spark: SparkSession, name: str) -> str:
    """A small file; manifests have hidden names, which Spark's readers pass over."""
    files, path = _path(spark, name)
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str, replace: bool = False) -> None:
    """A small text file; it is created whole, and fails if it is there unless ``replace``."""
    files, path = _path(spark, name)
    out = files.create(path, replace)
    out.write(bytearray(text.encode()))
    out.close()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source`` to ``target`` if nothing is there; False if something is. The one step that makes a change visible."""
    jvm = spark.sparkContext._jvm
    files, path = _path(spark, target)
    files.mkdirs(path.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, source)[1], path, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError:
        if files.exists(path):
            return False
        raise
    return True


def pointer(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The newest committed entry of ``folder`` and its number; (0, None) without any."""
    files, path = _path(spark, folder)
    if not files.exists(path):
        return 0, None
    names = [s.getPath().getName() for s in files.listStatus(path)]
    last = max((int(n[:8]) for n in names if n[8:] == ".json" and n[:8].isdecimal()), default=0)
    return last, json.loads(read_text(spark, f"{folder}/{last:08d}.json")) if last else None


def commit_pointer(spark: SparkSession, folder: str, number: int, entry: dict) -> None:
    """Make ``entry`` the one of this number; an error if another writer has taken it. Readers see all of it or nothing."""
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    write_text(spark, hidden, json.dumps(entry, sort_keys=True))
    if not move(spark, hidden, f"{folder}/{number:08d}.json"):
        _path(spark, hidden)[0].delete(_path(spark, hidden)[1], False)
        raise ContractError(f"another writer has committed {folder}/{number:08d}.json")


def table_state(df: DataFrame, path: str) -> tuple[str, dict]:
    """MISSING, IDENTICAL or DIFFERENT, by the digest that the table's newest entry holds."""
    found = digest(df, df.columns).first().asDict()
    manifest = {"columns": df.columns, "rows": found["rows"], "digest": found["digest"]}
    old = pointer(df.sparkSession, f"{path}/_entries")[1]
    if old is None:
        return "MISSING", manifest
    return ("IDENTICAL" if all(old.get(k) == v for k, v in manifest.items()) else "DIFFERENT"), manifest


def guarded_write(df: DataFrame, path: str, replace: bool = False, evidence: dict | None = None, expected: int | None = None) -> str:
    """Write a table once. The same content again is a no-op; other content is an error unless ``replace``.

    ``expected`` is the number of the entry that the rows were planned on: an error if the table has another one by now.

    Rows go to a folder of their own, the digest is taken of what was written, and then the table's next entry names that
    folder. The entry before stays until it is there, so a crash between two steps loses nothing, and of two writers one
    fails. ``read_table`` reads the newest entry.
    """
    spark = df.sparkSession
    number, _ = pointer(spark, f"{path}/_entries")
    if expected is not None and number != expected:
        raise ContractError(f"planned on entry {expected} of {path}, which is at {number}")
    folder = f"{path}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    state, manifest = table_state(spark.read.schema(df.schema).parquet(folder), path)
    if state == "IDENTICAL" or state == "DIFFERENT" and not replace:
        _path(spark, folder)[0].delete(_path(spark, folder)[1], True)
        if state == "DIFFERENT":
            raise ContractError(f"{path} holds other rows")
        return state
    commit_pointer(spark, f"{path}/_entries", number + 1, manifest | {"folder": folder, "schema": df.schema.json()} | (evidence or {}))
    return state


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``guarded_write`` has committed last."""
    return read_entry(spark, path)[1]


def read_entry(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """The newest entry's number and its rows, from one look at the log."""
    number, entry = pointer(spark, f"{path}/_entries")
    if entry is None:
        raise ContractError(f"{path} holds no committed table")
    return number, spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["folder"])


def write_json_lines(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Canonical compact JSON, a line for each row."""
    df.select(S.canonical_json(columns or df.columns).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Text columns with a header; arrays and maps go as JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string").alias(c) for c, t in df.dtypes]
    df.select(*flat).write.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_verified_csv(df: DataFrame, path: str) -> str:
    """Write CSV aside, read it back, compare digests, and move it into place, which fails if something is there. Returns the digest."""
    spark = df.sparkSession
    aside = f"{path}.{uuid.uuid4().hex}"
    write_csv(df, aside)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(T.StructType([T.StructField(c, T.StringType()) for c in df.columns])).csv(aside)
    blank = lambda d: d.select(*(F.coalesce(F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string"), F.lit("")).alias(c) for c, t in d.dtypes))  # noqa: E731  CSV knows no null
    wanted, found = (digest(blank(d), df.columns).first() for d in (df, back))
    if wanted != found or not move(spark, aside, path):
        _path(spark, aside)[0].delete(_path(spark, aside)[1], True)
        raise ContractError(f"{path} isn't what was to be written" if wanted != found else f"{path} is there already")
    return found["digest"]


def run_summary(outputs: dict[str, DataFrame], **facts: str) -> DataFrame:
    """One row for each output of a run: its name, rows and digest, with the facts of the run as JSON."""
    spark = next(iter(outputs.values())).sparkSession
    told = json.dumps(facts, sort_keys=True, separators=(",", ":"))
    parts = [digest(df, df.columns).select(F.lit(name).alias("output"), "rows", "digest", F.lit(told).alias("facts")) for name, df in outputs.items()]
    out = parts[0] if parts else spark.createDataFrame([], "output string, rows bigint, digest string, facts string")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_rejections(rejected: DataFrame, path: str, reason: str = "rejectReason") -> int:
    """Rejected rows with their reasons as CSV, if there are any; returns how many."""
    n = rejected.count()
    if n:
        write_verified_csv(rejected.select(reason, *(c for c in rejected.columns if c != reason)), path)
    return n


def write_content_addressed(spark: SparkSession, folder: str, value: dict) -> str:
    """A small document under its own digest; writing it again changes nothing. Returns the digest."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    name = hashlib.sha256(text.encode()).hexdigest()
    if not exists(spark, f"{folder}/{name}.json"):
        write_text(spark, f"{folder}/{name}.json", text)
    return name


def publish(tables: dict[str, DataFrame], folder: str, expected: str | None) -> str:
    """Write immutable tables, then commit the next pointer, if the last one names ``expected``. Returns the new version.

    Pointers are numbered and committed by a rename that doesn't overwrite: of two publishers that have seen the same
    pointer, one fails.
    """
    spark = next(iter(tables.values())).sparkSession
    number, now = pointer(spark, f"{folder}/current")
    if (now or {}).get("version") != expected:
        raise ContractError(f"the pointer names {(now or {}).get('version')}, not {expected}")
    entries = {}
    for name, df in tables.items():
        found = digest(df, df.columns).first()
        path = f"{folder}/blobs/{name}-{hashlib.sha256(found['digest'].encode()).hexdigest()}-{found['rows']}"
        guarded_write(df, path)
        entries[name] = path
    version = write_content_addressed(spark, f"{folder}/versions", entries)
    commit_pointer(spark, f"{folder}/current", number + 1, {"version": version})
    return version


def write_partitioned(df: DataFrame, path: str, month: str = "ym") -> None:
    """A fact table split by month, so that a month's query reads a month's files; one shuffle bounds the file count."""
    df.repartition(month, F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.partitionBy(month).mode("overwrite").parquet(path)
