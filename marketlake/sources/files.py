"""Landed files read as streams: bytes in order, bounded memory.

Spark's text reader cuts the raw bytes of any file into pieces at line feeds,
whatever the file holds and wherever it is stored.  The pieces of a file meet
in one task, sorted by their place (Spark spills the sort), and a parser takes
them a piece at a time.  No file is ever held whole, compressed or not; files
are spread over the tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from typing import Protocol
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship_package

PIECE = 1 << 20           # bytes decompressed at once
OUT_ROWS = 5_000          # rows of an output batch
OUT_CHARS = 4 << 20       # or characters


class Parser(Protocol):
    """Made with the path of a file; gives rows as tuples."""

    def feed(self, data: bytes) -> Iterator[tuple]: ...

    def close(self) -> Iterator[tuple]: ...


def ordered_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): the bytes of every file, cut after each line feed (which
    is left out); a file's rows in order in one partition.  Files that Spark
    knows as compressed by their extension come decompressed."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))
    return rows.repartition("path").sortWithinPartitions("path", "start", "at").select("path", "value")


def parse_files(spark: SparkSession, path: str, parser: type[Parser], schema: T.StructType | str, *args) -> DataFrame:
    """Rows of ``parser(path, *args)`` over every file of ``path``."""
    ship_package(spark)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _in_batches(_all_rows(batches, parser, args))
        for some in rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), out)], schema=out)
    return ordered_bytes(spark, path).mapInArrow(run, schema)


def _all_rows(batches, parser, args) -> Iterator[tuple]:
    now, at = None, None
    for batch in batches:
        for path, value in zip(batch.column("path"), batch.column("value")):
            path = path.as_py()
            if path != at:
                if now is not None:
                    yield from now.close()
                now, at = parser(path, *args), path
            yield from now.feed(value.as_py() + b"\n")
    if now is not None:
        yield from now.close()


def _in_batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= OUT_ROWS or size >= OUT_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


# --------------------------------------------------------------------- SRC-2
class GzipLines:
    """(path, line) of a gzip or plain text file, told apart by its first two
    bytes; bytes that are no UTF-8 are dropped.  Decompressed a piece at a
    time; a line cut by a piece's end is carried to the next.  A gzip file that
    is broken or cut short is an error."""

    def __init__(self, path: str):
        self.path, self.head, self.zip, self.rest = path, b"", None, b""
        self.plain = False

    def _lines(self, data: bytes) -> Iterator[tuple]:
        *lines, self.rest = (self.rest + data).split(b"\n")
        for line in lines:
            yield self.path, line.decode("utf-8", errors="ignore")

    def feed(self, data: bytes) -> Iterator[tuple]:
        if self.zip is None and not self.plain:
            self.head += data
            if len(self.head) < 2:
                return
            data, self.head = self.head, b""
            self.plain = data[:2] != b"\x1f\x8b"
            self.zip = None if self.plain else zlib.decompressobj(31)
        if self.plain:
            yield from self._lines(data)
            return
        while data:
            if self.zip.eof:      # another member, or the line feed after the last
                data = data.lstrip(b"\x00\n")
                if not data:
                    return
                self.zip = zlib.decompressobj(31)
            try:
                out = self.zip.decompress(data, PIECE)
            except zlib.error as e:
                raise ValueError(f"broken gzip file {self.path}: {e}") from e
            yield from self._lines(out)
            data = self.zip.unused_data if self.zip.eof else self.zip.unconsumed_tail

    def close(self) -> Iterator[tuple]:
        if self.zip is not None and not self.zip.eof:
            raise ValueError(f"gzip file {self.path} is cut short")
        yield from self._lines(self.head)
        if self.rest:
            yield self.path, self.rest.decode("utf-8", errors="ignore")


# --------------------------------------------------------------------- SRC-7
# The elements that are data sets, and where their fields stand:
# attributes first, then child elements, in this order.
CATALOGUE_TAGS = ("dataflow", "dataset", "series", "item")
CATALOGUE_FIELDS = {
    "code": (("id", "code", "agencyID", "dataflow", "dataset"), ("id", "code", "dataflow", "dataset", "series")),
    "title": (("name", "title", "label"), ("name", "title", "label")),
    "description": (("description",), ("description", "annotation", "note", "shortDescription")),
    "link": (("downloadLink", "downloadlink", "href", "url", "link", "download", "uri"),
             ("downloadLink", "download_link", "link", "url", "href", "uri", "download")),
    "version": (("version", "ver"), ("version", "lastUpdate")),
}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


class Catalogue:
    """(path, node, code, title, description, link, version) of every element
    whose local name is one of ``tags``, in any namespace, as the file goes by:
    an element that has ended is let go of.  The title falls back to the code;
    elements without a code are left out."""

    def __init__(self, path: str, tags: tuple[str, ...] = CATALOGUE_TAGS):
        self.path, self.tags = path, {t.lower() for t in tags}
        self.events = ElementTree.XMLPullParser(("start", "end"))
        self.open: list = []
        self.inside = 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.events.feed(data)
        for event, element in self.events.read_events():
            is_node = _local(element.tag).lower() in self.tags
            if event == "start":
                self.open.append(element)
                self.inside += is_node
                continue
            self.open.pop()
            self.inside -= is_node
            if is_node:
                found = {f: self._field(element, *where) for f, where in CATALOGUE_FIELDS.items()}
                if found["code"]:
                    found["title"] = found["title"] or found["code"]
                    yield self.path, _local(element.tag), *found.values()
            if self.open and (is_node or not self.inside):
                self.open[-1].remove(element)

    @staticmethod
    def _field(element, attributes, children) -> str | None:
        for a in attributes:
            if (element.get(a) or "").strip():
                return element.get(a).strip()
        for name in children:
            for child in element:
                if _local(child.tag).lower() == name.lower():
                    for v in (child.text, child.get("value"), child.get("href"), child.get("id")):
                        if (v or "").strip():
                            return v.strip()
        return None

    def close(self) -> Iterator[tuple]:
        self.events.close()
        return iter(())


# -------------------------------------------------------------------- SRC-12
WORKBOOK_NAME = re.compile(r"([^/]+?)_(\d{8})\.xlsx$")


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _texts(node) -> str:
    """The text of a string item: its runs joined, phonetic hints left out."""
    return "".join("".join(t.text or "" for t in part.iter() if _local(t.tag) == "t")
                   for part in ([node] if _local(node.tag) == "t" else node) if _local(part.tag) in ("t", "r"))


def sheet_rows(content: bytes, wanted: str) -> Iterator[list[str | None]]:
    """Cells as text of the first sheet of an .xlsx workbook whose name holds
    ``wanted`` (any case), row by row; no such sheet, no rows.  The sheet's XML
    is read as a stream; the workbook's compressed bytes and its shared
    strings are what is held."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        relation = next((next(v for k, v in s.attrib.items() if _local(k) == "id" and k != "id") for s in book.iter()
                         if _local(s.tag) == "sheet" and wanted.lower() in s.get("name", "").lower()), None)
        if relation is None:
            return
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[relation].lstrip("/")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as f:
                for _, node in ElementTree.iterparse(f):
                    if _local(node.tag) == "si":
                        shared.append(_texts(node))
                        node.clear()
        with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
            for _, node in ElementTree.iterparse(f):
                if _local(node.tag) != "row":
                    continue
                cells: list[str | None] = []
                for cell in node:
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = _cell(cell, shared)
                node.clear()
                yield cells


def _cell(cell, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        value = "".join(_texts(c) for c in cell if _local(c.tag) == "is")
    else:
        value = next((c.text for c in cell if _local(c.tag) == "v"), None)
        if value is not None and kind == "s":
            value = shared[int(value)]
        elif value is not None and kind == "b":
            value = "True" if value == "1" else "False"
        elif kind == "e":
            value = None
    return None if value is None or value.strip() in ("", "NaN") else value


WORKBOOK_SCHEMA = "ticker string, data_date string, excel_file string, row long, fields map<string,string>"


def read_workbooks(spark: SparkSession, path: str, wanted: str = "holding") -> DataFrame:
    """SRC-12: rows of one sheet of every workbook ``<ticker>_<yyyymmdd>.xlsx``
    under ``path``: the first whose name holds ``wanted`` (``holding``,
    ``historical``).  Ticker and date are those of the file name; the first row
    with cells names the file's own columns (a second column of a name gets
    ``.1``, as spreadsheets readers do); every value is text, empty cells are
    left out of ``fields``.  Workbooks are spread over the tasks; one is read by
    one task (see ``sheet_rows``)."""
    ship_package(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true")
             .load(path).select("path", "content"))
    schema = T._parse_datatype_string(WORKBOOK_SCHEMA)
    out = to_arrow_schema(schema)

    def rows(batches) -> Iterator[tuple]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                name = WORKBOOK_NAME.search(file.as_py())
                ticker, day = name.groups() if name else (None, None)
                date = f"{day[:4]}-{day[4:6]}-{day[6:]}" if day else None
                columns, n = None, 0
                for cells in sheet_rows(content.as_py(), wanted):
                    if not any(c is not None for c in cells):
                        continue
                    if columns is None:
                        columns = _unique(cells)
                        continue
                    yield ticker, date, file.as_py(), n, [(c, v) for c, v in zip(columns, cells) if c and v is not None]
                    n += 1

    def run(batches):
        for some in _in_batches(rows(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), out)], schema=out)
    return files.mapInArrow(run, schema)


def _unique(names: list[str | None]) -> list[str | None]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n is not None:
            seen[n] = seen.get(n, -1) + 1
            n = f"{n}.{seen[n]}" if seen[n] else n
        out.append(n)
    return out
