"""Workbooks read in pieces: the same cells as by one parser, in many tasks."""

import random
import tracemalloc
import zipfile

import pytest

from wattledger.sources import workbook

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def make(path, rows, prefix="", strings=True):
    """A workbook whose texts are shared strings, with empty rows and cells between."""
    p, known = f"{prefix}:" if prefix else "", {}
    tag = f' xmlns:{prefix}="{MAIN}"' if prefix else f' xmlns="{MAIN}"'
    body = []
    for r, cells in enumerate(rows, 1):
        inner = ""
        for c, value in enumerate(cells):
            ref = f"{chr(65 + c)}{r}"
            if isinstance(value, str) and strings:
                inner += f'<{p}c r="{ref}" t="s"><{p}v>{known.setdefault(value, len(known))}</{p}v></{p}c>'
            elif isinstance(value, str):
                inner += f'<{p}c r="{ref}" t="inlineStr"><{p}is><{p}t>{value}</{p}t></{p}is></{p}c>'
            elif value is not None:
                inner += f'<{p}c r="{ref}"><{p}v>{value}</{p}v></{p}c>'
        body.append(f'<{p}row r="{r}">{inner}</{p}row>' if inner else f'<{p}row r="{r}"/>')
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets><sheet name="END" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        book.writestr("xl/worksheets/s.xml", f'<?xml version="1.0"?>\n<{p}worksheet{tag}><{p}cols/><{p}sheetData>{"".join(body)}</{p}sheetData><{p}pageMargins left="1"/></{p}worksheet>')
        if strings:
            book.writestr("xl/sharedStrings.xml", f'<{p}sst{tag}>' + "".join(f"<{p}si><{p}t>{t}</{p}t></{p}si>" for t in known) + f"</{p}sst>")


@pytest.mark.parametrize(("prefix", "strings"), [("", True), ("x", True), ("", False)])
@pytest.mark.parametrize("piece", [200, 3000, 1 << 20])
def test_pieces_give_the_cells_of_the_whole_sheet(spark, tmp_path, prefix, strings, piece):
    rng = random.Random(2)
    files = {}
    for name in ("a", "b"):
        rows = [[rng.choice([None, f"text {rng.randrange(50)}", rng.randrange(1000), 1.5]) for _ in range(rng.randrange(6))] for _ in range(200)]
        make(tmp_path / f"{name}.xlsx", rows, prefix, strings)
        files[name] = rows
    found = workbook.read_workbooks(spark, f"file://{tmp_path}/*.xlsx", "END", piece=piece)
    wanted = []
    for name in files:
        wanted += [(name, *c) for c in workbook.cells((tmp_path / f"{name}.xlsx").read_bytes(), "END")]
    assert sorted((r["file"][-6], r["row"], r["col"], r["type"], r["value"]) for r in found.collect()) == sorted(wanted)
    some = workbook.read_workbooks(spark, f"file://{tmp_path}/a.xlsx", "END", "B,D", piece)
    assert sorted(tuple(r)[1:] for r in some.collect()) == sorted(w[1:] for w in wanted if w[0] == "a" and w[2] in (2, 4))


def test_a_large_sheet_is_cut_in_bounded_memory(spark, tmp_path):
    path = tmp_path / "large.xlsx"
    make(path, [[f"id {i}", i, i / 2, "same"] for i in range(120_000)])
    with zipfile.ZipFile(path) as book:
        size = book.getinfo("xl/worksheets/s.xml").file_size
        tracemalloc.start()
        with book.open("xl/worksheets/s.xml") as stream:
            n = sum(1 for _ in workbook._pieces(stream, "row", 1 << 20))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert size > 15 << 20 and n > 8 and most < 12 << 20
    cells = workbook.read_workbooks(spark, f"file://{path}", piece=1 << 20)
    assert cells.where("col = 4 and value = 'same' and type = 'text'").count() == 120_000 and cells.where("col = 1").selectExpr("count(distinct value)").first()[0] == 120_000


def test_empty_sheets_have_no_cells(spark, tmp_path):
    make(tmp_path / "none.xlsx", [])
    assert workbook.read_workbooks(spark, f"file://{tmp_path}/none.xlsx").collect() == []
