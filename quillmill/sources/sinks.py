"""Sinks: JSON, tables, report frames and the validation queue.

Workbooks are several frames; write_workbook() is for reports of a size a person reads,
write_frames() writes the same frames as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import safe_name
from quillmill.operators.mapping import ordered_columns
from quillmill.sources.workbook import workbook_bytes


def write_json(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).json(path)


def write_frames(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_workbook(frames: dict[str, DataFrame], path: str, rows: int = 100_000) -> None:
    """A workbook on the driver with a sheet for each frame, `No Data` if there is none; a frame of more than `rows` rows is refused."""
    sheets = {}
    for name, df in frames.items():
        listed = df.limit(rows + 1).collect()
        if len(listed) > rows:
            raise ValueError(f"{name} has more than {rows} rows")
        sheets[name] = [df.columns, *([x if isinstance(x, (int, float, str)) or x is None else str(x) for x in r] for r in listed)]
    with open(path, "wb") as out:
        out.write(workbook_bytes(sheets))


#: Columns of a price list.
PRICE_COLUMNS = (
    "CONTRACT_ID", "VALID_FROM", "VALID_TO", "COMPANY_CODE", "CURRENCY", "MATERIAL_ID", "ITEM_DESCRIPTION", "ORDER_UOM",
    "TARGET_QUANTITY", "MIN_RATE", "MAX_RATE", "PRICE_UNIT_UOM", "NET_PRICE", "CLAUSE_DESCRIPTION",
)


def in_order(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """These columns as text, empty where they lack or are null."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def pricing_frames(items: DataFrame, tables: DataFrame) -> dict[str, DataFrame]:
    """Pricing Data, and Source Tables: where the prices were read. tables: document_id, ord, section, caption, headers, rows."""
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("ord"))
    source = tables.select(
        "document_id", number.alias("#"), F.col("section").alias("Section"), F.col("caption").alias("Caption"),
        F.array_join("headers", " | ", "").alias("Headers"), F.size("rows").alias("Rows"),
    )
    return {"Pricing Data": in_order(items, PRICE_COLUMNS), "Source Tables": source}


def target_frames(rows: dict[str, DataFrame], schema: dict[str, tuple[str, ...]]) -> dict[str, DataFrame]:
    """A frame for each target table, its columns in the schema's order, then references, originals and trace."""
    return {name: ordered_columns(df, schema[name]) for name, df in rows.items()}


def mapping_review_frames(reviews: DataFrame, stats: DataFrame) -> dict[str, DataFrame]:
    """Summary, Classification, Mappings and Values of mapping reviews, failed tables left out of the details."""
    done, key = reviews.filter(F.col("error").isNull()), ["document_id", "table_id"]
    listed = lambda c: done.select(*key, F.posexplode(c).alias("nth", "verdict"))
    return {
        "Summary": stats,
        "Classification": done.select(*key, F.col("classification_verdict").alias("verdict"), "overall_accuracy_pct"),
        "Mappings": listed("mapping_verdicts"),
        "Values": listed("value_verdicts"),
    }


def verification_frames(items: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """Verification with verdict and reasoning last, and Summary: one row a document, also as JSON text."""
    last = [c for c in ("verdict", "reasoning") if c in items.columns]
    shown = items.select(*[c for c in items.columns if c not in last], *last)
    return {"Verification": shown, "Summary": summary.withColumn("json", F.to_json(F.struct(*summary.columns)))}


def with_file_name(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("file_name", safe_name(F.col(column)))


def document_frames(blocks: DataFrame, headers: DataFrame) -> dict[str, DataFrame]:
    """Document, Header and Tables of a flattened document; the text is indented by its depth."""
    shown = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.coalesce("heading", "text", "caption"))
    origin = F.when(F.col("under").isNotNull(), F.concat(F.lit(" (from "), "under", F.lit(")")))
    label = F.concat_ws("", F.lit("Table "), (F.row_number().over(_in_order())).cast("string"), F.lit(": "), F.coalesce("caption", F.lit("")), origin)
    return {
        "Document": blocks.select("document_id", "path", "depth", "block_type", shown.alias("text")),
        "Header": headers,
        "Tables": blocks.filter("block_type = 'table'").select("document_id", "path", label.alias("label"), "headers", "rows"),
    }


def _in_order():
    return Window.partitionBy("document_id").orderBy("path")


def review_frames(pages: DataFrame) -> dict[str, DataFrame]:
    """pages, missed, errors: the arrays of a page review as rows of their own."""
    key = ["document_id", "page_number"]
    return {
        "pages": pages.drop("missed_content", "incorrect_content"),
        "missed": pages.select(*key, F.explode("missed_content").alias("m")).select(*key, "m.*"),
        "errors": pages.select(*key, F.explode("incorrect_content").alias("m")).select(*key, "m.*"),
    }


def combine(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def set_status(queue: DataFrame, decisions: DataFrame, key: str = "document_id") -> DataFrame:
    """The validation queue with new statuses (approved, rejected) where there is a decision."""
    new = decisions.select(key, F.col("status").alias("_new"))
    return queue.join(new, key, "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")
