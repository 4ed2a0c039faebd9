"""Workbooks and PDF files as tables, from files read as bytes."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CELL = re.compile(r"([A-Z]+)([0-9]+)")
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SCHEMA = "file string, sheet string, row int, col int, kind string, value string, formula string"


def workbook_cells(content: bytes) -> Iterator[tuple[str, int, int, str, str | None, str | None]]:
    """``sheet, row, col, kind, value, formula`` of each cell that holds something."""
    from stemma.functions.unicode import column_number

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        there = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in there:
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[s.get(f"{_REL}id")].lstrip("/")
            path = target if target in there else f"xl/{target}"
            for _, c in ET.iterparse(z.open(path)):
                if c.tag != f"{_MAIN}c":
                    continue
                letters, digits = _CELL.match(c.get("r")).groups()
                kind = c.get("t", "n")
                v, f = c.find(f"{_MAIN}v"), c.find(f"{_MAIN}f")
                text = v.text if v is not None else None
                if kind == "s" and text is not None:
                    text, kind = shared[int(text)], "string"
                elif kind == "inlineStr":
                    text, kind = "".join(t.text or "" for t in c.iter(f"{_MAIN}t")), "string"
                else:
                    kind = {"n": "number", "b": "bool", "str": "string", "e": "error", "d": "date"}.get(kind, kind)
                if text is not None or f is not None:
                    yield s.get("name"), int(digits), column_number(letters), kind, text, f.text if f is not None else None
                c.clear()


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """``file, sheet, row, col, kind, value, formula``: one row a cell. A file that is no workbook has one row of kind ``unreadable``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                try:
                    rows = [(file, *c) for c in workbook_cells(bytes(content))]
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    rows = [(file, None, 0, 0, "unreadable", None, None)]
                yield pd.DataFrame(rows, columns=["file", "sheet", "row", "col", "kind", "value", "formula"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(run, SCHEMA)


def sheet_rows(cells: DataFrame) -> DataFrame:
    """``file, sheet, row, cells``: each row's values in order of their columns, gaps as nulls."""
    m = F.map_from_entries(F.collect_list(F.struct("col", "value")))
    rows = cells.where("row > 0").groupBy("file", "sheet", "row").agg(m.alias("m"), F.max("col").alias("w"))
    return rows.select("file", "sheet", "row", F.transform(F.sequence(F.lit(1), F.col("w")), lambda i: F.try_element_at(F.col("m"), i)).alias("cells"))


def read_pdf_text(spark: SparkSession, path: str) -> DataFrame:
    """``file, page, text`` of PDF files, by whichever PDF library is installed; none is an error."""
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("reading PDF text needs the pypdf library") from e

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                pages = PdfReader(io.BytesIO(bytes(content))).pages
                yield pd.DataFrame([(file, i, p.extract_text()) for i, p in enumerate(pages, 1)], columns=["file", "page", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(path)
    return files.select("path", "content").mapInPandas(run, "file string, page int, text string")
