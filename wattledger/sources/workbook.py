"""Spreadsheet workbooks: a row for each cell.

``read_workbooks`` reads any store that Spark can open, and one workbook in many tasks. A sheet is a compressed stream, which
can only be unpacked from its start: one task does that, a block at a time, and cuts the text behind ends of rows into pieces
of about ``PIECE`` bytes, which are written. Parsing, which is the work, is done piece by piece in as many tasks as there are
pieces. Shared strings are cut and parsed the same way, and meet the cells that name them in a join by file and number.

``WorkbookSource`` is a Spark data source for folders that all executors mount, one task for each file:

    spark.dataSource.register(WorkbookSource)
    spark.read.format("workbook").option("sheet", "END").option("columns", "A,C").load("/folder/with/*.xlsx")
"""

from __future__ import annotations

import glob
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from wattledger.functions import scalars as S
from wattledger.operators.validate import ContractError
from wattledger.scratch import keep

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
SCHEMA = "file string, row int, col int, type string, value string"


def column_number(ref: str) -> int:
    """A1-style reference to a column number from 1."""
    n = 0
    for letter in re.match("[A-Z]+", ref)[0]:
        n = 26 * n + ord(letter) - 64
    return n


def _sheet_part(book: zipfile.ZipFile, sheet: str | None) -> str:
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    wanted = next((s for s in sheets if sheet in (None, s.get("name"))), None)
    if wanted is None:
        raise ValueError(f"no sheet {sheet!r}")
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[wanted.get(_LINK)]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    for _, item in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
        if item.tag == f"{_MAIN}si":
            out.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
            item.clear()
    return out


def cells(content: bytes, sheet: str | None = None, columns: set[int] | None = None) -> Iterator[tuple[int, int, str, str]]:
    """(row, col, type, value) of the filled cells; types are text, number, bool and error."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _shared(book)
        for _, row in ElementTree.iterparse(book.open(_sheet_part(book, sheet))):
            if row.tag != f"{_MAIN}row":
                continue
            at = int(row.get("r"))
            for cell in row.iter(f"{_MAIN}c"):
                col = column_number(cell.get("r"))
                if columns and col not in columns:
                    continue
                kind, value = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
                if kind == "inlineStr":
                    kind, value = "str", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                if value is None:
                    continue
                if kind == "s":
                    value = strings[int(value)]
                yield at, col, {"s": "text", "str": "text", "n": "number", "b": "bool", "e": "error"}.get(kind, "text"), value
            row.clear()


def _columns(option: str | None) -> set[int] | None:
    return {column_number(c.strip()) for c in option.split(",")} if option else None


class _File(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.sheet, self.columns, self.pattern = options.get("sheet"), _columns(options.get("columns")), options.get("path")

    def partitions(self):
        return [_File(f) for f in sorted(glob.glob(self.pattern))]

    def read(self, partition):
        with open(partition.value, "rb") as file:
            content = file.read()
        for cell in cells(content, self.sheet, self.columns):
            yield (partition.value, *cell)


class WorkbookSource(DataSource):
    """For folders that all executors mount; ``read_workbooks`` reads any store."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


PIECE = 4 << 20
_BLOCK = 1 << 20
_PIECES = "file string, kind string, piece int, first long, xml binary"


def _pieces(stream, element: str, size: int) -> Iterator[tuple[int, bytes]]:
    """(elements before it, XML) of pieces of a part: whole elements below a copy of the part's root, so that each parses alone."""
    held, opened, close, count, most = b"", b"", b"", 0, size
    begin = re.compile(rb"<(?![?!])(?:([A-Za-z_][\w.-]*):)?[A-Za-z_][\w.-]*[^>]*>")
    while True:
        block = stream.read(_BLOCK)
        held += block
        if not opened:
            root = begin.search(held)
            if root is None or root[0].endswith(b"/>"):
                if not block:
                    return
                continue
            opened, prefix = root[0], (root[1] + b":") if root[1] else b""
            close = b"</" + re.match(rb"<([^\s/>]+)", opened)[1] + b">"
            name = prefix + element.encode()
            first, end = re.compile(b"<" + re.escape(name) + rb"(?=[\s/>])"), b"</" + name + b">"
            held = held[root.end() :]
        if len(held) < most and block:
            continue
        last, start = held.rfind(end), first.search(held)
        if last >= 0 and start is not None:
            body = held[start.start() : last + len(end)]
            yield count, opened + body + close
            count += sum(1 for _ in first.finditer(body))
            held, most = held[last + len(end) :], size
        else:
            most = len(held) + size  # one element longer than a piece, or nothing of interest yet
        if not block:
            return


def _unpack(batches, sheet: str | None, size: int):
    """The pieces of each workbook's sheet and of its shared strings."""
    import pyarrow as pa

    schema = pa.schema([("file", pa.string()), ("kind", pa.string()), ("piece", pa.int32()), ("first", pa.int64()), ("xml", pa.binary())])
    for batch in batches:
        for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as book:
                parts = [("cells", _sheet_part(book, sheet), "row")]
                if "xl/sharedStrings.xml" in book.namelist():
                    parts.append(("strings", "xl/sharedStrings.xml", "si"))
                for kind, part, element in parts:
                    with book.open(part) as stream:
                        for i, (before, xml) in enumerate(_pieces(stream, element, size)):
                            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((name, kind, i, before, xml), schema, strict=True)], schema=schema)


def _parse_cells(xml: bytes, columns: set[int] | None) -> Iterator[tuple[int, int, str, str]]:
    """(row, col, type, value) of a piece's cells; the type ``shared`` has a string's number for its value."""
    for row in ElementTree.fromstring(xml):
        if row.tag != f"{_MAIN}row":
            continue
        for cell in row.iter(f"{_MAIN}c"):
            col = column_number(cell.get("r"))
            if columns and col not in columns:
                continue
            kind, value = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
            if kind == "inlineStr":
                kind, value = "str", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
            if value is not None:
                yield int(row.get("r")), col, {"s": "shared", "str": "text", "n": "number", "b": "bool", "e": "error"}.get(kind, "text"), value


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None, columns: str | None = None, piece: int = PIECE) -> DataFrame:
    """(file, row, col, type, value) of every workbook under the path; types are text, number, bool and error."""
    import pyarrow as pa

    wanted = _columns(columns)
    books = spark.read.format("binaryFile").load(path).select("path", "content")
    unpacked = keep(books.mapInArrow(lambda batches: _unpack(batches, sheet, piece), _PIECES), "workbooks")

    def parse_cells(batches):
        for batch in batches:
            for name, xml in zip(batch["file"].to_pylist(), batch["xml"].to_pylist(), strict=True):
                found = list(_parse_cells(xml, wanted))
                columns_ = list(zip(*found, strict=True)) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), *(pa.array(c, t) for c, t in zip(columns_, (pa.int32(), pa.int32(), pa.string(), pa.string()), strict=True))], ["file", "row", "col", "type", "value"])

    def parse_strings(batches):
        for batch in batches:
            for name, first, xml in zip(*(batch[c].to_pylist() for c in ("file", "first", "xml")), strict=True):
                texts = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in ElementTree.fromstring(xml)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(texts), pa.string()), pa.array(range(first, first + len(texts)), pa.int64()), pa.array(texts, pa.string())], ["file", "number", "text"])

    def dealt(kind: str) -> DataFrame:
        """A kind's pieces, each for a task of its own."""
        rows = unpacked.where(F.col("kind") == kind)
        return rows.repartitionByRange(max(1, counts.get(kind, 0)), "file", "piece")

    counts = {r["kind"]: r["count"] for r in unpacked.groupBy("kind").count().collect()}
    cells_ = dealt("cells").select("file", "xml").mapInArrow(parse_cells, SCHEMA)
    if not counts.get("strings"):
        return cells_.withColumn("type", F.when(F.col("type") == "shared", "text").otherwise(F.col("type")))
    strings = keep(dealt("strings").select("file", "first", "xml").mapInArrow(parse_strings, "file string, number long, text string"), "strings")
    shared = F.col("type") == "shared"
    met = cells_.withColumn("number", F.when(shared, F.col("value").try_cast("long"))).join(strings, ["file", "number"], "left")
    return met.select("file", "row", "col", F.when(shared, "text").otherwise(F.col("type")).alias("type"), F.when(shared, F.col("text")).otherwise(F.col("value")).alias("value"))


def month_blocks(cells: DataFrame) -> DataFrame:
    """(file, col, ym, block): the runs of neighbouring date headers in row 1, numbered from 1: sales first, units second."""
    head = cells.where("row = 1 and type = 'number'").select("file", "col", S.serial_month(F.col("value").try_cast("double").cast("int")).alias("ym")).where("ym is not null")
    by_file = Window.partitionBy("file").orderBy("col")
    islands = head.withColumn("_island", F.col("col") - F.row_number().over(by_file))
    return islands.withColumn("block", F.dense_rank().over(Window.partitionBy("file").orderBy("_island"))).drop("_island")


def records(cells: DataFrame, text: dict[str, int]) -> DataFrame:
    """Rows below the header: the named text columns, and maps monthlySalesC and monthlyUnits of the two month blocks."""
    months = month_blocks(cells)
    body = cells.where("row > 1").join(months, ["file", "col"], "left")

    def block(n: int, value: Column) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("block") == n, F.struct("ym", value)))))

    named = [F.max(F.when(F.col("col") == c, F.col("value"))).alias(n) for n, c in text.items()]
    return body.groupBy("file", "row").agg(*named, block(1, S.workbook_cents("value")).alias("monthlySalesC"), block(2, S.workbook_units("value")).alias("monthlyUnits"))


def headers(cells: DataFrame) -> DataFrame:
    """(file, header): the first row of each sheet up to its last filled column, gaps as nulls; numbers are date serials."""
    head = cells.where("row = 1").select("file", "col", F.struct(F.when(F.col("type") == "number", F.col("value").try_cast("double")).alias("number"), F.when(F.col("type") != "number", S.clean_text("value")).alias("text")).alias("cell"))
    placed = head.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("col", "cell"))).alias("_c"), F.max("col").alias("_last"), F.min("col").alias("_first"))
    return placed.select("file", F.transform(F.sequence("_first", "_last"), lambda i: F.try_element_at("_c", i)).alias("header"))


def require_layout(cells: DataFrame, check) -> DataFrame:
    """The cells, if ``check``, which gives the errors of a header row, finds none in any sheet; a row for each sheet comes to the driver."""
    bad = {r["file"]: errors for r in headers(cells).collect() if (errors := check([None if c is None else c["text"] if c["number"] is None else c["number"] for c in r["header"]]))}
    if bad:
        raise ContractError(f"sheets whose header isn't the contract's: {bad}")
    return cells


def category_header_errors(header: list, label: str) -> list[str]:
    """What is wrong with the header of a category sheet: one of two names for the meter, the month's category, tier and score."""
    names = [str(h) for h in header if h is not None]
    meters = [n for n in names if n in ("MeterNumber", "CorrectedMeterNumber")]
    errors = [] if meters else ["NO_METER_COLUMN"]
    errors += [f"MISSING_{n}" for n in (f"{label}_Category", "Risk_Tier", "Risk_Score") if n not in names]
    return errors + (["REPEATED_COLUMN"] if len(set(names)) < len(names) else [])


def categories(cells: DataFrame, label: str) -> DataFrame:
    """(file, row, meterNo, value) of category sheets: ``value`` is (leakageCategory, riskTier, riskScore); a corrected meter number comes before the given one."""
    checked = require_layout(cells, lambda header: category_header_errors(header, label))
    names = checked.where("row = 1").select("file", "col", S.clean_text("value").alias("name"))
    body = checked.where("row > 1").join(F.broadcast(names), ["file", "col"]).groupBy("file", "row")  # a name for each column of each sheet
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    wide = body.agg(pick("CorrectedMeterNumber").alias("_c"), pick("MeterNumber").alias("_m"), pick(f"{label}_Category").alias("_k"), pick("Risk_Tier").alias("_t"), pick("Risk_Score").alias("_s"))
    meter = F.coalesce(F.nullif(S.raw_meter_no("_c"), F.lit("")), S.raw_meter_no("_m"))
    value = F.struct(S.clean_text("_k").alias("leakageCategory"), S.clean_text("_t").alias("riskTier"), S.strict_int(F.regexp_replace(S.clean_text("_s"), r"\.0+$", "")).cast("int").alias("riskScore"))
    return wide.select("file", "row", meter.alias("meterNo"), value.alias("value"))
