"""Scans: documents, pages, items and index sheets."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.sources.workbook import read_workbooks, sheet_table

#: Name parts of files a review scan leaves out.
DERIVED = ("_field_mapping", "_mapping_review", "_combined")
#: Keys that precomputed sections need.
SECTION_KEYS = ("section_name", "section_type", "start_page", "end_page")


def parse_page_range(text: str) -> tuple[int, int]:
    """`7` or `5-20`; a start below 1 or an end before the start is an error."""
    found = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", text)
    if not found:
        raise ValueError(f"no page range: {text!r}")
    start, end = int(found[1]), int(found[2] or found[1])
    if start < 1 or end < start:
        raise ValueError(f"no page range: {text!r}")
    return start, end


def page_range(pages: DataFrame, start: int, end: int, document: str = "document_id", page: str = "page_number") -> DataFrame:
    """The pages of a range, numbered anew from 1; the old number stays in _original_page_number."""
    w = Window.partitionBy(document).orderBy(page)
    kept = pages.filter(F.col(page).between(max(1, start), end)).withColumn("_original_page_number", F.col(page))
    return kept.withColumn(page, F.row_number().over(w))


def read_json_documents(spark: SparkSession, paths: list[str], suffix: str = "*.json", derived: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents, errors): file, json (whole text); files that hold no JSON go to errors.

    derived=False leaves out reports that earlier steps wrote beside the documents.
    """
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", suffix).text(paths)
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("json"))
    if not derived:
        rows = rows.filter(~F.col("file").rlike("|".join(DERIVED)))
    parsed = rows.withColumn("ok", F.try_parse_json("json").isNotNull())
    return parsed.filter("ok").drop("ok"), parsed.filter("not ok").select("file", F.substring("json", 1, 200).alias("begins"))


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """The paths in a list file: one a line, comments and blank lines left out."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("p")).filter("p <> ''")
    return [r["p"] for r in lines.collect()]


def read_pdf_pages(spark: SparkSession, path: str, dpi: int = 150) -> DataFrame:
    """document_id, page_number, image, width, height, text; needs PyMuPDF on the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(path)

    def pages(batches: Iterator) -> Iterator:
        import fitz
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with fitz.open(stream=content, filetype="pdf") as pdf:
                    rows = []
                    for number, page in enumerate(pdf, 1):
                        image = page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72))
                        rows.append((name.rsplit("/", 1)[-1], number, image.tobytes("png"), image.width, image.height, page.get_text()))
                yield pd.DataFrame(rows, columns=["document_id", "page_number", "image", "width", "height", "text"])

    return files.select("path", "content").mapInPandas(pages, "document_id string, page_number int, image binary, width int, height int, text string")


def _named(df: DataFrame, columns: list[str], path: Column, required: tuple[str, ...]) -> DataFrame:
    """Trimmed text, blanks empty, and FILE_NAME; missing required columns are an error."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(_pricing)?\.[^.]+$", "")
    return df.select(*[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in columns], F.concat(name, F.lit(".pdf")).alias("FILE_NAME"))


def read_text_table(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Items as a table of trimmed strings, blanks empty, with FILE_NAME: CSV, JSON (arrays of objects) or workbooks, by the path's ending.

    A path without one of these endings is read as CSV. Of workbooks the columns are those of all first rows.
    """
    if path.endswith(".json"):
        df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
        return _named(df, df.columns, F.col("_metadata.file_path"), required)
    if path.endswith(".xlsx"):
        rows = read_workbooks(spark, path)
        heads = rows.filter("row_no = 0").select(F.explode("cells").alias("c")).filter("c is not null").distinct()
        columns = sorted(r["c"] for r in heads.collect())  # names of columns
        return _named(sheet_table(rows, columns), columns, F.col("file"), required)
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _named(df, df.columns, F.input_file_name(), required)


#: Rows of an index sheet among which its first date is looked for, and the sheet that is taken if there is one of the name.
INDEX_ROWS, INDEX_SHEET = 20, "Data1"


def _date(text: Column) -> Column:
    return F.coalesce(*[F.try_to_date(F.trim(text), f) for f in ("yyyy-M-d", "d/M/yyyy", "MMM-yyyy", "MMM yyyy")])


def index_rows(rows: DataFrame) -> DataFrame:
    """series, date, value, pos out of a sheet (row_no, cells): names in the first row (series_<i> where blank), rows from the
    first date on, undated ones left out, numbers that are none null. No date among the first INDEX_ROWS rows is an error."""
    dated = rows.withColumn("date", _date(F.get("cells", F.lit(0))))
    first = dated.filter(F.col("date").isNotNull() & (F.col("row_no") < INDEX_ROWS)).agg(F.min("row_no")).first()[0]
    if first is None:
        raise ValueError(f"no date among the first {INDEX_ROWS} rows")
    names = rows.filter("row_no = 0").first()["cells"][1:]
    names += [None] * (rows.agg(F.max(F.size("cells"))).first()[0] - 1 - len(names))
    entries = F.array(
        *[F.struct(F.lit((n or "").strip() or f"series_{i}").alias("series"), F.lit(i).alias("pos"), F.get("cells", F.lit(i)).try_cast("double").alias("value")) for i, n in enumerate(names, 1)]
    )
    return dated.filter((F.col("row_no") >= first) & F.col("date").isNotNull()).select("date", F.inline(entries)).select("series", "date", "value", "pos")


def read_index_sheet(spark: SparkSession, path: str) -> DataFrame:
    """series, date, value, pos out of a wide index sheet: CSV, or the sheet Data1 (else the first) of a workbook."""
    if path.endswith(".xlsx"):
        rows = read_workbooks(spark, path)
        best = rows.agg(F.min(F.struct((F.col("sheet") != INDEX_SHEET).alias("other"), "sheet_no"))).first()[0]
        return index_rows(rows.filter(F.col("sheet_no") == best["sheet_no"]))
    text = spark.read.option("wholetext", True).text(path)  # an index is a row a month
    lines = text.select(F.posexplode(F.split("value", "\r?\n")).alias("row_no", "line")).filter("line <> ''")
    width = spark.read.option("header", False).option("inferSchema", False).csv(path).columns
    parsed = F.from_csv("line", F.lit(", ".join(f"{c} string" for c in width)))
    return index_rows(lines.select("row_no", F.array(*[parsed[c] for c in width]).alias("cells")))


def series_names(index: DataFrame) -> DataFrame:
    return index.filter(F.col("series").contains("Index Numbers")).select("series").distinct()


def locate_reports(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """document_id, file, report: by the document id, else by the file's stem, else by the stem without its ending."""
    stem = F.regexp_replace(F.regexp_extract("file", r"([^/]+)$", 1), r"\.[^.]+$", "")
    keys = F.array(F.col("document_id"), stem, F.regexp_replace(stem, "_(extracted|output|final)$", ""))
    asked = documents.select("document_id", "file", F.posexplode(keys).alias("rank", "key"))
    found = asked.join(reports.select(F.col("document_id").alias("key"), "report"), "key")
    best = found.groupBy("document_id", "file").agg(F.min_by("report", "rank").alias("report"))
    return documents.select("document_id", "file").join(best, ["document_id", "file"], "left")


def check_sections(sections: DataFrame) -> DataFrame:
    """Precomputed sections; a missing key is an error."""
    missing = [k for k in SECTION_KEYS if k not in sections.columns]
    if missing:
        raise ValueError(f"missing keys: {missing}")
    return sections
