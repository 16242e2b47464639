"""From raw cells of tables to the rows of the target tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import dates, money
from quillmill.functions.text import SUMMARY_LABELS, blank_to_null
from quillmill.session import maybe_broadcast

#: Columns of the target tables.
INVOICE = (
    "vendor_name", "invoice_number", "invoice_date", "due_date", "currency", "net_amount", "gst", "gross_amount",
    "description", "pricing_type", "primary_invoice_flag", "discount_rebate", "pr_number", "quantity", "uom", "unit_price",
    "amount", "item_description",
)
TIMESHEET = (
    "vendor_name", "period_start", "period_end", "work_date", "staff_equipment_name", "quantity", "uom", "shift_type", "rate",
    "charge", "position_make", "location", "approved_date", "unique_identifier", "item_description", "employee_number",
    "trade", "pay_type", "cost_centre", "task_description", "work_place",
)
REFERENCES = ("contract_number", "po_number", "ses_number", "sap_invoice_reference")


def occurrence(df: DataFrame, keys: list[str], order: str, out: str = "occ") -> DataFrame:
    """Numbers the tables that share an id, in order."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def transform(value: Column, hint: Column, target: Column) -> Column:
    """The value by its transform hint: currency, date, or none; numeric targets lose their commas."""
    return (
        F.when(hint == "currency", money.parse_currency(value))
        .when(hint == "date", dates.parse_date(value))
        .when(target.isin(*money.NUMERIC_TARGETS), money.numeric_cleanup(value))
        .otherwise(F.trim(value))
    )


def apply_mappings(
    cells: DataFrame, mappings: DataFrame, row_keys: list[str], schema: dict[str, tuple[str, ...]], table_keys: tuple[str, ...] = ("table_id", "occ")
) -> DataFrame:
    """row keys and the target columns that any table of `schema` has.

    cells: row_keys, table_id, occ, header, col_idx, value. mappings: table_id, occ,
    target_table, source, target, hint, ord. occ numbers the tables, and the proposals,
    that share an id (occurrence()): the first proposal is for the first of them. Targets
    outside their table's schema are dropped; of several mappings to a target the last
    column wins, then the last mapping. No pivot over data: the targets are known, so
    each is one conditional maximum.
    """
    allowed = mappings.filter(
        F.concat_ws(".", "target_table", "target").isin([f"{t}.{c}" for t, columns in schema.items() for c in columns])
    )
    own = maybe_broadcast(allowed.withColumnRenamed("source", "header"))
    mapped = cells.join(own, [*table_keys, "header"])
    valued = mapped.withColumn("_value", transform(F.col("value"), F.col("hint"), F.col("target")))
    targets = list(dict.fromkeys(c for columns in schema.values() for c in columns))
    last = lambda t: F.max_by(F.when(F.col("target") == t, F.col("_value")), F.when(F.col("target") == t, F.struct("col_idx", "ord")))
    return valued.groupBy(*row_keys).agg(*[last(t).alias(t) for t in targets])


def coalesce_headers(value: Column, section: Column, document: Column) -> Column:
    """A column's value, else the section's header value, else the document's."""
    return F.coalesce(blank_to_null(value), blank_to_null(section), document)


def looks_like_header(row: Column, headers: Column) -> Column:
    """At least half of the row's filled cells, within the header's width, repeat their header."""
    zipped = F.arrays_zip(F.slice(row, F.lit(1), F.size(headers)).alias("r"), headers.alias("h"))
    filled = F.filter(zipped, lambda x: F.coalesce(F.trim(x["r"]), F.lit("")) != "")
    same = F.filter(filled, lambda x: F.lower(F.trim(x["r"])) == F.lower(F.trim(x["h"])))
    return (F.size(filled) > 0) & (2 * F.size(same) >= F.size(filled))


def nothing(value: Column) -> Column:
    """Blank, a text for nothing, or zero."""
    return blank_to_null(value.cast("string")).isNull() | F.coalesce(value.cast("string").try_cast("double") == 0, F.lit(False))


def filter_timesheet_rows(df: DataFrame, name: str, quantity: str, rate: str, charge: str, item: str) -> DataFrame:
    """Rows without quantity, rate and charge go, and total rows; a name that is a rate code becomes the item description."""
    code = F.col(name).rlike(r"^\d+(\.\d+)?$")
    kept = df.filter(~(nothing(F.col(quantity)) & nothing(F.col(rate)) & nothing(F.col(charge))))
    kept = kept.filter(F.coalesce(~F.lower(F.trim(name)).isin(*SUMMARY_LABELS), F.lit(True)))
    return kept.withColumns({item: F.when(code, F.col(name)).otherwise(F.col(item)), name: F.when(~F.coalesce(code, F.lit(False)), F.col(name))})


def primary_flag(section_type: Column, title: Column) -> Column:
    """1 for sections whose type begins with invoice and whose title is no draft, else 0 (as text)."""
    invoice = F.coalesce(F.lower(section_type).startswith("invoice"), F.lit(False))
    return F.when(invoice & ~F.coalesce(F.lower(title).contains("draft"), F.lit(False)), "1").otherwise("0")


def keep_primary(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(F.coalesce(F.col(flag) != "0", F.lit(True)))


def drop_drafts(df: DataFrame, title: str) -> DataFrame:
    return df.filter(~F.coalesce(F.lower(title).contains("draft"), F.lit(False)))


def drop_total_rows(df: DataFrame, row_type: str) -> DataFrame:
    return df.filter(F.col(row_type).isNull() | (F.col(row_type) == "data"))


def ordered_columns(df: DataFrame, table: tuple[str, ...], trace: tuple[str, ...] = ("_source_table", "_source_file")) -> DataFrame:
    """Schema columns, references, originals and confidences, trace, then what else there is."""
    have = df.columns
    kept = [c for c in (*table, *REFERENCES) if c in have]
    kept += sorted(c for c in have if c.startswith("orig_") or c.endswith("_norm_confidence"))
    kept += [c for c in trace if c in have]
    return df.select(*kept, *[c for c in have if c not in kept])


def replace_by_match(df: DataFrame, column: str, matches: DataFrame, least: float = 0.75) -> DataFrame:
    """Values by a match table (value, matched, confidence): replaced from `least` on, the confidence recorded always."""
    m = maybe_broadcast(matches.select(F.col("value").alias("_v"), "matched", F.col("confidence").alias(f"{column}_norm_confidence")))
    out = df.join(m, F.trim(column) == F.col("_v"), "left")
    better = F.col(f"{column}_norm_confidence") >= least
    return out.withColumns({f"orig_{column}": F.col(column), column: F.when(better, F.col("matched")).otherwise(F.col(column))}).drop("_v", "matched")


def reference_fields(rows: DataFrame, info: DataFrame, key: str = "document_id") -> DataFrame:
    """rows with the reference fields that the extraction info of their document has (filled ones) in place of their own."""
    given = info.select(key, *[F.col(c).alias(f"_{c}") for c in REFERENCES])
    own = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in REFERENCES}
    joined = rows.join(maybe_broadcast(given), key, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.trim(f"_{c}"), F.lit("")), own[c]) for c in REFERENCES}).drop(*[f"_{c}" for c in REFERENCES])


def skip_sections(df: DataFrame, section_type: str, skipped: tuple[str, ...]) -> DataFrame:
    """Rows of sections whose type is not among the skipped ones."""
    return df.filter(F.coalesce(~F.lower(section_type).isin(*skipped), F.lit(True))) if skipped else df


def reference_overlap(values: Column, references: Column) -> Column:
    """True if the texts of two arrays share a word of four letters or more."""
    words = lambda a: F.flatten(
        F.transform(a, lambda t: F.filter(F.split(F.regexp_replace(F.lower(t), "[^a-z0-9]+", " "), " "), lambda w: F.length(w) >= 4))
    )
    return F.coalesce(F.arrays_overlap(words(values), words(references)), F.lit(False))


def note_fields(notes: Column) -> dict[str, Column]:
    """Name, date and trade out of a notes text; null where it does not say."""
    found = lambda p: F.when(notes.rlike(p), F.trim(F.regexp_extract(notes, p, 1)))
    return {
        "staff_equipment_name": found(r"(?i)\bname\s*[:\-]\s*([^;,\n]+)"),
        "work_date": found(r"(?i)\bdate\s*[:\-]\s*([0-9./\-]+)"),
        "trade": found(r"(?i)\btrade\s*[:\-]\s*([^;,\n]+)"),
    }
