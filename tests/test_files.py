"""Streams over landed files: gzip, catalogue XML and workbooks."""

import gzip
import os
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from marketlake.functions import periods as P
from marketlake.operators import filters as FL
from marketlake.sources import files
from marketlake.sources import landed as L


def lines(data: bytes, piece: int = 1000) -> list[str]:
    p = files.GzipLines("f")
    out = [r for i in range(0, len(data), piece) for r in p.feed(data[i:i + piece])]
    return [line for _, line in [*out, *p.close()]]


def test_gzip_lines_of_any_cut():
    body = b"\n".join(b"line %d \xff\xc3\xa9" % i for i in range(5000))
    want = [f"line {i} \u00e9" for i in range(5000)]
    for piece in (1, 7, 4096):
        assert lines(gzip.compress(body), piece) == want
        assert lines(body, piece) == want
    assert lines(gzip.compress(body) + b"\n") == want                                     # the line feed a reader adds
    assert lines(gzip.compress(body[:30000]) + gzip.compress(body[30000:])) == want        # two members
    assert lines(b"") == [] and lines(b"x") == ["x"] and lines(gzip.compress(b"")) == []
    for broken, why in ((gzip.compress(body)[:-9], "cut short"), (b"\x1f\x8bnothing like gzip at all", "broken")):
        with pytest.raises(ValueError, match=why):
            lines(broken)


def test_gzip_is_unzipped_in_bounded_memory():
    row = b"1000|ACME CORP|10-K|2020-01-02|edgar/data/1000/x.txt\n"
    data = gzip.compress(row * (300 * (1 << 20) // len(row)))         # 300 MB of lines
    parser, n = files.GzipLines("f"), 0
    tracemalloc.start()
    for i in range(0, len(data), 1 << 16):
        n += sum(1 for _ in parser.feed(data[i:i + (1 << 16)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 300 * (1 << 20) // len(row) and peak < 60 << 20


def test_files_keep_their_line_order_over_splits(spark, tmp):
    folder = os.path.join(tmp, "raw")
    os.makedirs(folder)
    body = "\n".join(f"{i}" for i in range(60_000)).encode()
    for name, data in (("a", gzip.compress(body, 0)), ("b", body), ("c.gz", gzip.compress(body)), ("empty", b"")):
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.parse_files(spark, folder, files.GzipLines, "path string, line string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name in ("a", "b", "c.gz"):
        assert [int(r.line) for r in got if r.path.endswith("/" + name)] == list(range(60_000))


def test_catalogue_of_two_node_kinds(spark, tmp):
    xml = """<?xml version="1.0"?>
<m:Structure xmlns:m="urn:m" xmlns:s="urn:s">
  <s:Dataflow id="F1" version="2"><s:Name>Flow</s:Name><s:Annotation value="note"/></s:Dataflow>
  <group><dataset><code> D1 </code><downloadLink href="http://x/d1"/></dataset>
    <m:dataset code="D2" title="Two"><dataset id="D3"/></m:dataset></group>
  <dataset><title>without a code</title></dataset>
</m:Structure>"""
    with open(os.path.join(tmp, "toc.xml"), "w") as fh:
        fh.write(xml)
    got = {r.code: r.asDict() for r in L.read_catalogue_xml(spark, os.path.join(tmp, "toc.xml")).collect()}
    assert set(got) == {"F1", "D1", "D2", "D3"}
    assert got["F1"] == {"node": "Dataflow", "code": "F1", "title": "Flow", "description": "note", "link": None, "version": "2"}
    assert got["D1"]["title"] == "D1" and got["D1"]["link"] == "http://x/d1" and got["D2"]["title"] == "Two"
    assert [r.code for r in L.read_catalogue_xml(spark, os.path.join(tmp, "toc.xml"), ("dataset",), limit=2).collect()] == ["D1", "D2"]


def workbook(path, sheets, shared=()):
    """A workbook by hand: {sheet name: rows of (cell type, value)}."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for r, cells in enumerate(rows, 1):
                body += f'<row r="{r}">'
                for c, cell in enumerate(cells):
                    if cell is None:
                        continue
                    kind, v = cell
                    ref = f'r="{chr(65 + c)}{r}"'
                    body += (f'<c {ref} t="inlineStr"><is><t>{v}</t></is></c>' if kind == "inline"
                             else f'<c {ref} t="{kind}"><v>{v}</v></c>')
                body += "</row>"
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
        items = "".join(f"<si>{s}</si>" for s in shared)
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')


def test_workbooks_with_their_own_columns(spark, tmp):
    shared = ["<t>Name</t>", "<r><t>Micro</t></r><r><t>soft</t></r>", "<t>Weight</t>"]
    workbook(os.path.join(tmp, "IVV_20240131.xlsx"), {
        "Overview": [[("inline", "nothing")]],
        "Fund Holdings": [[], [("s", 0), ("s", 2), ("s", 0)], [("s", 1), ("n", "7.25"), None], [None, ("e", "#N/A"), None],
                          [("inline", "Apple"), None, ("b", "1")]],
        "Holdings too": [[("inline", "X")], [("inline", "wrong sheet")]],
        "historical": [[("inline", "As Of"), ("inline", "NAV")], [("inline", "Jan 02, 2024"), ("n", "470.1")]]}, shared)
    workbook(os.path.join(tmp, "AGG_20240201.xlsx"), {"HOLDINGS": [[("inline", "Sector")], [("inline", "Bonds")]]})
    rows = files.read_workbooks(spark, tmp).collect()
    got = sorted((r.ticker, r.data_date, r.row, r.fields) for r in rows)
    assert got == [("AGG", "2024-02-01", 0, {"Sector": "Bonds"}),
                   ("IVV", "2024-01-31", 0, {"Name": "Microsoft", "Weight": "7.25"}),
                   ("IVV", "2024-01-31", 1, {"Name": "Apple", "Name.1": "True"})]
    past = files.read_workbooks(spark, tmp, "historical").collect()
    assert [(r.ticker, r.fields) for r in past] == [("IVV", {"As Of": "Jan 02, 2024", "NAV": "470.1"})]


def test_filings_hook_looks_at_the_schema(spark):
    rows = [("b.txt", "1"), ("a.txt", "2"), ("a.txt", "3")]
    spark.createDataFrame(rows, "filename string, cik string").createOrReplaceTempView("hook_files")
    for text in ("select t.* from hook_files t", "SELECT  *  FROM hook_files",
                 "select filename from (select * from hook_files order by cik) x", "select cik, filename from hook_files ORDER BY cik"):
        assert [r.filename for r in FL.filings_from_sql(spark, text).collect()] == ["a.txt", "b.txt"]
    both = FL.filings_from_sql(spark, "select * from hook_files", keep=["cik"]).collect()
    assert [tuple(r) for r in both] == [("a.txt", "2"), ("a.txt", "3"), ("b.txt", "1")]
    with pytest.raises(ValueError, match="filename"):
        FL.filings_from_sql(spark, "select cik from hook_files")


def test_periods_with_trailing_text_are_none(spark):
    texts = ["2020-01-15", "2020-01-15T10:30:00Z", "2020-01-15xyz", "2020Q1", "2020Q1xyz", "2020M02", "2020M021", "2020-W05x",
             "2020-Q1", "2020-Q12", "2020-02", "2020-02-xx"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    eu = {r.s: str(r.d) for r in df.select("s", P.european_period_date("s").alias("d")).collect()}
    bis = {r.s: str(r.d) for r in df.select("s", P.banking_period_date(F.col("s")).alias("d")).collect()}
    assert {k for k, v in eu.items() if v != "None"} == {"2020-01-15", "2020-01-15T10:30:00Z", "2020Q1", "2020M02", "2020-02"}
    assert {k for k, v in bis.items() if v != "None"} == {"2020-01-15", "2020-01-15T10:30:00Z", "2020-Q1", "2020-02"}
