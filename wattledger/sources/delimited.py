"""Text sources: CSV of strings with an encoding fallback, JSON lines in three degrees of strictness, file discovery."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError
from wattledger.scratch import keep

# fixed values: texts that stand for a missing value
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of each file, hashed where it is read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def file_traits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, encoding, broken, header) of each file, from one pass: UTF-8 if all its lines read as such, else Latin-1; whether a quoted field goes on over a line's end; and its first line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.is_valid_utf8("value").alias("utf8"), (quotes % 2 == 1).alias("odd"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    found = lines.groupBy("file").agg(F.bool_and("utf8").alias("utf8"), F.bool_or("odd").alias("broken"), F.min_by("line", "at").alias("first"))  # lines are kept as the bytes they are
    encoding = F.when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1")
    return found.select("file", encoding.alias("encoding"), "broken", F.when(F.col("utf8"), F.decode("first", "UTF-8")).otherwise(F.decode("first", "ISO-8859-1")).alias("header"))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field goes on over a line's end in some file."""
    return not file_traits(spark, path).where("broken").isEmpty()


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Number the rows (.., _file, _block, _at) of each file in file order, from 1, by the counts of the blocks that tasks read."""
    inside = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_at"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_file", "_block").agg(F.count("*").alias("_n")).select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.withColumn("_in", inside).join(starts, ["_file", "_block"]).withColumn(name, (F.col("_start") + F.col("_in")).cast("bigint")).drop("_in", "_start", "_block", "_at")


def _place() -> list:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")]


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, row_number: str | None = None) -> DataFrame:
    """All columns as text, headers cleaned, missing markers as null; ``columns`` is an exact contract.

    Each file is read in its own encoding: files of one encoding are read together, so there are four readers at most. Files
    are split over tasks, but for those in which a quoted field holds a line's end. ``row_number`` numbers the data rows of
    each file in file order. The driver holds the names of the files, as Spark's own listing does.
    """
    kinds: dict[tuple[str, bool], list[str]] = {}
    headers: dict[tuple[str, ...], str] = {}
    for r in file_traits(spark, path).collect():
        kinds.setdefault((r["encoding"], r["broken"]), []).append(r["file"])
        if r["header"].count('"') % 2 == 0:
            headers.setdefault(tuple(" ".join(c.replace("\ufeff", "").split()) for c in next(csv.reader([r["header"]]), [])), r["file"])
    if len(headers) > 1:
        raise ContractError(f"{path}: files with other columns than the rest: {headers}")
    parts: list[DataFrame] = []
    for (encoding, broken), files in sorted(kinds.items()) or [(("UTF-8", False), [])]:
        reader = spark.read.option("header", True).option("encoding", encoding).option("inferSchema", False).option("multiLine", broken).option("escape", '"')
        df = reader.csv(path if len(kinds) < 2 else sorted(files))
        df = df.toDF(*(S.clean_header(c) for c in df.columns))
        if columns is not None and list(df.columns) != list(columns):
            raise ContractError(f"{path}: columns {df.columns} are not {list(columns)}")
        parts.append(df.select(*(F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns), *(_place() if row_number else [])))
    named = reduce(DataFrame.unionAll, parts)
    return _numbered(named, row_number).drop("_file") if row_number else named


def snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(digests, rows) of small CSV files from one read of their bytes, so that the digest is that of the rows.

    digests: (path, bytes, sha256); rows: (path, row, record array<string>), the header being row 0. The bytes are kept
    once, and both are taken from there; a file is one task's.
    """
    bytes_ = keep(spark.read.format("binaryFile").load(path).select("path", "content"), "snapshot")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                try:
                    text = content.decode("utf-8-sig")
                except UnicodeDecodeError:
                    text = content.decode("latin-1")
                rows = list(csv.reader(io.StringIO(text, newline="")))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.string()))], ["path", "row", "record"])

    digests = bytes_.select("path", F.octet_length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return digests, bytes_.mapInArrow(records, "path string, row long, record array<string>")


def require_unchanged(spark: SparkSession, path: str, before: DataFrame) -> None:
    """The files still hold what they held when ``before``, the result of ``file_digests``, was taken."""
    now = file_digests(spark, path)
    changed = before.join(now, ["path", "sha256"], "left_anti").select("path").unionByName(now.join(before, ["path", "sha256"], "left_anti").select("path")).limit(5).collect()
    if changed:
        raise ContractError(f"changed while they were read: {sorted({r[0] for r in changed})}")


def file_identity(path: str = "_metadata.file_path") -> list:
    """Municipality and month columns from names such as ``sales__LM__2024-05__120.csv``."""
    parts = r"__([A-Za-z0-9]+)__(\d{4}-(?:0[1-9]|1[0-2]))(?:__\d+)?\.csv$"
    return [F.nullif(F.regexp_extract(path, parts, i), F.lit("")).alias(n) for i, n in ((1, "lmPcode"), (2, "ym"))]


def discover_months(spark: SparkSession, folder: str, first: str, last: str) -> DataFrame:
    """(ym, files) for every month of the range; a month without exactly one file is for the caller to refuse."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", *file_identity("path"))
    months = spark.range(1).select(F.explode(S.month_range(F.lit(first), F.lit(last))).alias("ym"))
    return months.join(found, "ym", "left").groupBy("ym").agg(F.count("path").alias("files"), F.min("path").alias("path"))


def require_complete(months: DataFrame) -> DataFrame:
    bad = months.where("files <> 1").orderBy("ym").limit(12).collect()
    if bad:
        raise ContractError(f"months without exactly one file: {[(r['ym'], r['files']) for r in bad]}")
    return months


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of text files with their numbers, from 1."""
    lines = spark.read.text(path).select("value", *_place())
    return _numbered(lines, "line").select(F.col("_file").alias("file"), "line", "value")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "strict") -> DataFrame:
    """JSON lines. ``strict`` fails on a blank or bad line, ``lenient`` skips blank lines and fails on bad ones; the error names file and line."""
    if mode not in ("strict", "lenient"):
        raise ValueError(mode)
    lines = numbered_lines(spark, path)
    blank = F.trim("value") == ""
    if mode == "lenient":
        lines = lines.where(~blank)
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    place = lambda what: F.raise_error(F.concat(F.col("file"), F.lit(" line "), F.col("line").cast("string"), F.lit(": " + what)))
    checked = lines.select(F.when(blank, place("blank line")).when(~is_object, place("not a JSON object")).otherwise(F.col("value")).alias("value"))
    return checked.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_r")).select("_r.*")


def split_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records, exceptions): lines that hold a JSON object, and the others with a code, the file they are in and their line."""
    known = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("_v", F.try_parse_json("value"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    good = known.where(is_object).select(F.from_json("value", schema).alias("_r")).select("_r.*")
    bad = known.where(~is_object).select("file", "line", "value", F.when(F.col("_v").isNull(), "INVALID_JSON").otherwise("NOT_AN_OBJECT").alias("code"))
    return good, bad


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON report with the digest of the bytes it was read from: (path, sha256, report variant)."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.parse_json(F.decode("content", "UTF-8")).alias("report"))


def verified(manifests: DataFrame, expected: DataFrame) -> DataFrame:
    """The manifests, if each has the digest that ``expected`` (path, sha256) names, and none is missing."""
    bad = expected.join(manifests.select("path", F.col("sha256").alias("_found")), "path", "left").where(~F.col("_found").eqNullSafe(F.col("sha256"))).limit(5).collect()
    if bad:
        raise ContractError(f"evidence that is missing or was changed: {[r['path'] for r in bad]}")
    return manifests.join(expected.select("path"), "path", "left_semi")
