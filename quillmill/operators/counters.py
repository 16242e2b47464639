"""Counters of runs: what was mapped, adjusted and reconciled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile_counters(maps: DataFrame, raw: str = "raw", cleaned: str = "cleaned", merged: str = "merged", final: str = "final") -> DataFrame:
    """One row of counters over a row for each description that was given: how many values each step left, and how many each changed."""
    changed = lambda a, b: F.countDistinct(F.when(F.col(a) != F.col(b), F.col(a)))
    return maps.agg(
        F.count(raw).alias("total_rows"), F.countDistinct(raw).alias("distinct_original"), F.countDistinct(cleaned).alias("distinct_after_cleaning"),
        F.countDistinct(merged).alias("distinct_after_normalisation"), F.countDistinct(final).alias("distinct_reconciled"),
        changed(raw, cleaned).alias("cleaning_mappings"), changed(cleaned, merged).alias("duplicate_mappings"),
        changed(merged, final).alias("verification_mappings"), changed(raw, final).alias("total_mappings"),
    )


def distinct_units(rows: DataFrame, unit: str) -> DataFrame:
    """unit, n: the units that rows have, trimmed; blank ones left out."""
    return rows.filter(F.trim(unit) != "").groupBy(F.trim(unit).alias(unit)).agg(F.count(F.lit(1)).alias("n"))


def units_by_code(rows: DataFrame, raw: str, code: str) -> DataFrame:
    """code, spellings, n: what units are written like, for display; a null code is what is not known."""
    counted = rows.groupBy(code, raw).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(code).agg(F.array_join(F.array_sort(F.collect_list(raw)), ", ").alias("spellings"), F.sum("n").alias("n"))


def page_mapping_coverage(entries: DataFrame, page: str, group: list[str]) -> DataFrame:
    """group, entries, mapped, pct: how many entries of a table of contents found their page."""
    out = entries.groupBy(*group).agg(F.count(F.lit(1)).alias("entries"), F.count(page).alias("mapped"))
    return out.withColumn("pct", F.round(100.0 * F.col("mapped") / F.col("entries"), 2))


def adjustment_counters(prices: DataFrame, adjusted: DataFrame) -> DataFrame:
    """One row: original, adjusted and all rows, and the periods used."""
    tagged = prices.select(F.lit("original").alias("kind"), F.lit(None).cast("string").alias("period")).unionByName(
        adjusted.select(F.lit("adjusted").alias("kind"), F.col("period_id").cast("string").alias("period"))
    )
    return tagged.agg(
        F.count_if(F.col("kind") == "original").alias("original_rows"), F.count_if(F.col("kind") == "adjusted").alias("adjusted_rows"),
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct("period").alias("formulas"),
    )


def table_sizes(cells: DataFrame, table: list[str], row: str, column: str) -> DataFrame:
    """table, row_count, column_count."""
    return cells.groupBy(*table).agg(F.countDistinct(row).alias("row_count"), F.countDistinct(column).alias("column_count"))


def rows_by_source(rows: DataFrame, tables: DataFrame, source: str = "_source_table", key: str = "table_id") -> DataFrame:
    """Every source table with the number of rows made from it."""
    made = rows.groupBy(F.col(source).alias(key)).agg(F.count(F.lit(1)).alias("rows_made"))
    return tables.join(made, key, "left").fillna({"rows_made": 0})


def by_known_order(df: DataFrame, name: str, known: DataFrame, order: str, missing: int = 9999) -> DataFrame:
    """df with the order of its names; unknown names come last."""
    return df.join(known.select(name, order), name, "left").fillna({order: missing})


def first_filled(*values: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*[F.when(F.trim(v) != "", v) for v in values])


def normalise_formula(js: Column) -> dict[str, Column]:
    """Fields of a clause's reply under their several names; none-like targets mean all rows, a list of series its first."""
    get = lambda *names: F.coalesce(*[F.get_json_object(js, f"$.{n}") for n in names])
    blank = lambda c: F.when(~F.lower(F.trim(c)).isin("", "none", "null", "n/a"), F.trim(c))
    return {
        "series": blank(F.split(get("cpi_series", "series", "index"), r"\|")[0]),
        "applies_to": F.coalesce(blank(get("applies_to", "items")), F.lit("all")),
        "frequency": F.lower(blank(get("adjustment_frequency", "frequency"))),
        "base_price": get("base_price", "Po").try_cast("double"),
        "base_index": get("base_cpi", "CPIo").try_cast("double"),
    }
