"""Excel workbooks as a Spark data source, read and written with the standard library alone.

A workbook reads as cells, ``spark.read.format("workbook").load(path)`` giving (sheet, row, col,
value, is_text), one task a sheet. A row's index starts at 1 under the header (row 0). The sink is
``write_workbook``: a workbook is one file, so it is written in one place, streaming row by row.
"""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from adsieve.schemas import CELL

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _letters(column: int) -> str:
    out = ""
    column += 1
    while column:
        column, k = divmod(column - 1, 26)
        out = chr(65 + k) + out
    return out


def sheets(path: str) -> list[tuple[str, str]]:
    """(name, part) of each sheet in order."""
    with zipfile.ZipFile(path) as book:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        found = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        return [(s.get("name"), "xl/" + targets[s.get(f"{_REL}id")].removeprefix("/xl/")) for s in found]


def cells(path: str, name: str, part: str) -> Iterator[tuple]:
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        with book.open(part) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                for c in row.iter(f"{_MAIN}c"):
                    kind, value = c.get("t"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is None:
                        continue
                    else:
                        text = shared[int(value.text)] if kind == "s" else value.text
                    yield name, int(row.get("r")) - 1, _column(c.get("r")), text, kind in ("s", "str", "inlineStr")
                row.clear()


class _Sheet(InputPartition):
    def __init__(self, name: str, part: str) -> None:
        self.name, self.part = name, part


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self):
        return [_Sheet(*s) for s in sheets(self.path)]

    def read(self, partition):
        return cells(self.path, partition.name, partition.part)


class Workbook(DataSource):
    """The source; a missing file raises FileNotFoundError."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self):
        return CELL

    def reader(self, schema):
        path = self.options["path"]
        if not os.path.exists(path):
            raise FileNotFoundError(f"Input file not found: {path}")
        return _Reader(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(Workbook)
    return spark.read.format("workbook").load(path)


def write_workbook(table: DataFrame, path: str, names: list[str]) -> None:
    """S3: cells to one workbook, sheet by sheet in the order of ``names``, rows streaming through the driver."""
    rows = {n: table.where(F.col("sheet") == n).orderBy("row", "col").toLocalIterator() for n in names}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        book.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        rel = "http://schemas.openxmlformats.org/package/2006/relationships"
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{rel}">' + "".join(f'<Relationship Id="rId{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1)) + "</Relationships>")
        book.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1)) + "</sheets></workbook>")
        for k, name in enumerate(names, 1):
            with book.open(f"xl/worksheets/sheet{k}.xml", "w") as out:
                out.write(f'<?xml version="1.0"?><worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                at = None
                for c in rows[name]:
                    if c["row"] != at:
                        out.write((b"</row>" if at is not None else b"") + f'<row r="{c["row"] + 1}">'.encode())
                        at = c["row"]
                    where = f"{_letters(c['col'])}{c['row'] + 1}"
                    if c["is_text"]:
                        out.write(f'<c r="{where}" t="inlineStr"><is><t xml:space="preserve">{escape(c["value"] or "")}</t></is></c>'.encode())
                    elif c["value"] is not None:
                        out.write(f'<c r="{where}"><v>{escape(c["value"])}</v></c>'.encode())
                out.write((b"</row>" if at is not None else b"") + b"</sheetData></worksheet>")
