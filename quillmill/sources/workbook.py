"""Workbooks (xlsx): a reader that gives all cells as text, and a writer, on the standard library.

An xlsx file is a zip of XML parts. Dates are numbers with a date format; they are given
as ISO text. A workbook is one file, read whole by one task, so it is for reports and
sheets of the size that people keep in them.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that show dates.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 27, 30, 36, 45, 46, 47, 50, 57}
SHEET_ROW = "file string, sheet string, sheet_no int, row_no int, cells array<string>"


def column_number(reference: str) -> int:
    """0 for `A1`, 26 for `AA7`."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_name(number: int) -> str:
    out = ""
    number += 1
    while number:
        number, rest = divmod(number - 1, 26)
        out = chr(65 + rest) + out
    return out


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {
        int(f.get("numFmtId")) for f in root.iter(f"{_MAIN}numFmt")
        if re.search("[dy]", re.sub(r'\\[[^\\]]*\\]|"[^"]*"', "", f.get("formatCode", "").lower()))
    }
    formats = root.find(f"{_MAIN}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", 0)) in DATE_FORMATS | own}


def _shown(value: str, is_date: bool) -> str:
    """A number as text: whole ones without a point, dates in ISO form."""
    number = float(value)
    if is_date:
        moment = dt.datetime(1899, 12, 30) + dt.timedelta(days=number)
        return moment.date().isoformat() if number == int(number) else moment.isoformat(sep=" ", timespec="seconds")
    return str(int(number)) if number == int(number) and abs(number) < 1e15 else repr(number)


def read_sheets(data: bytes) -> Iterator[tuple[str, list[list[str | None]]]]:
    """name and rows of each sheet, in order; rows as long as their last cell, blank cells null."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = [_text(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        dates = _date_styles(book)
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            rows: list[list[str | None]] = []
            for row in ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_MAIN}row"):
                number = int(row.get("r", len(rows) + 1))
                rows.extend([] for _ in range(number - len(rows) - 1))
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = column_number(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend(None for _ in range(at - len(cells)))
                    value, kind = cell.find(f"{_MAIN}v"), cell.get("t", "n")
                    if kind == "inlineStr":
                        cells.append(_text(cell))
                    elif value is None or value.text is None:
                        cells.append(None)
                    elif kind == "s":
                        cells.append(shared[int(value.text)])
                    elif kind == "n":
                        cells.append(_shown(value.text, int(cell.get("s", 0)) in dates))
                    elif kind == "b":
                        cells.append("True" if value.text == "1" else "False")
                    else:
                        cells.append(value.text)
                rows.append(cells)
            yield sheet.get("name"), rows


def _part(path: str, kind: str) -> str:
    return f'<Override PartName="{path}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{kind}+xml"/>'


def sheet_xml(rows: list[list[object]]) -> str:
    """A sheet of numbers and inline strings, its first row frozen."""
    out = []
    for i, row in enumerate(rows, 1):
        cells = []
        for j, value in enumerate(row):
            at = f"{column_name(j)}{i}"
            if value is None:
                continue
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            else:
                text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))  # no character of XML
                cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
        out.append(f'<row r="{i}">{"".join(cells)}</row>')
    view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN[1:-1]}">{view}<sheetData>{"".join(out)}</sheetData></worksheet>'


def workbook_bytes(sheets: dict[str, list[list[object]]]) -> bytes:
    """An xlsx file of these sheets (rows of cells); `No Data` if there is none."""
    sheets = sheets or {"No Data": []}
    names, taken = [], set()
    for name in sheets:  # at most 31 characters, none of []:*?/\\, each once
        short = re.sub(r"[\[\]:*?/\\\\]", "_", name)[:31] or "Sheet"
        while short.lower() in taken:
            short = f"{short[:28]}~{len(taken)}"
        taken.add(short.lower())
        names.append(short)
    types = _part("/xl/workbook.xml", "sheet.main") + "".join(_part(f"/xl/worksheets/sheet{i}.xml", "worksheet") for i in range(1, len(names) + 1))
    rels = "http://schemas.openxmlformats.org/package/2006/relationships"
    office = _REL[1:-1]
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{types}</Types>')
        book.writestr("_rels/.rels", f'{head}<Relationships xmlns="{rels}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{rels}">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", sheet_xml(rows))
    return out.getvalue()


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, sheet_no, row_no, cells of all workbooks below a path; `No Data` sheets are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)

    def sheets(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                for number, (sheet, rows) in enumerate(read_sheets(content)):
                    if sheet != "No Data":
                        yield pd.DataFrame({"file": name, "sheet": sheet, "sheet_no": number, "row_no": range(len(rows)), "cells": rows})

    return files.select("path", "content").mapInPandas(sheets, SHEET_ROW)


def sheet_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """file, sheet, row_no and these columns of sheets whose first row names them; text trimmed, blanks and lacking columns empty."""
    heads = rows.filter("row_no = 0").select("file", "sheet", F.col("cells").alias("_heads"))
    body = rows.filter("row_no > 0").join(heads, ["file", "sheet"])
    cell = lambda c: F.get("cells", (F.array_position("_heads", F.lit(c)) - 1).cast("int"))
    found = lambda c: F.when(F.array_position("_heads", F.lit(c)) > 0, F.trim(cell(c)))
    return body.select("file", "sheet", "row_no", *[F.coalesce(found(c), F.lit("")).alias(c) for c in columns])
