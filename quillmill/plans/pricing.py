"""From content blocks to dated price rows: find pricing tables, read them, fill what cells do not say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import pricing_text
from quillmill.operators import reshape, tree, validity


def pricing_items(tables: DataFrame, defaults: DataFrame) -> DataFrame:
    """document_id, table_id, contract_id, item_description, net_price, currency, valid_from, valid_to, price_unit.

    tables: document_id, table_id, ord, section, caption, context (text around), headers,
    rows. defaults: document_id, contract_id, currency, valid_from, valid_to. A cell
    comes before the table's context, the context before the document's defaults.
    """
    whole = tree.repair_headers(tree.inherit_headers(tables.withColumn("width", F.size(F.get("rows", F.lit(0)))), ["document_id"], ["ord"], "headers", "width"))
    priced = whole.filter(tree.is_pricing_table(F.col("caption"), F.col("headers"), F.col("section"), F.col("rows")))
    around = F.concat_ws("\n", "section", "caption", "context")
    unit = lambda text: F.nullif(pricing_text.detect_unit(F.lower(text)), F.lit(""))
    context = priced.select(
        "document_id", "table_id", "headers", F.posexplode("rows").alias("row_ord", "row"),
        F.nullif(pricing_text.detect_currency(around), F.lit("")).alias("c_currency"),
        pricing_text.detect_date(around, "valid_from").alias("c_from"), pricing_text.detect_date(around, "valid_to").alias("c_to"),
        F.coalesce(unit(F.array_join("headers", " ")), unit(around)).alias("price_unit"),
    )
    ids = ["document_id", "table_id", "row_ord", "c_currency", "c_from", "c_to", "price_unit"]
    rows = reshape.price_rows(context, ids)
    known = defaults.toDF(*[c if c == "document_id" else f"d_{c}" for c in defaults.columns])
    filled: dict[str, Column] = {
        "currency": F.coalesce(F.nullif("currency", F.lit("")), "c_currency", "d_currency"),
        "valid_from": F.coalesce("c_from", "d_valid_from"),
        "valid_to": F.coalesce("c_to", "d_valid_to"),
    }
    return rows.join(known, "document_id", "left").select(
        "document_id", "table_id", F.col("d_contract_id").alias("contract_id"), F.col("description").alias("item_description"),
        F.col("price").alias("net_price"), *[c.alias(n) for n, c in filled.items()], "price_unit",
    )


def dated_prices(items: DataFrame, as_of: Column) -> DataFrame:
    """Items with typed dates, each valid until the day before the item's next price."""
    from quillmill.functions.dates import parse_day_first

    typed = items.withColumns({"valid_from": parse_day_first(F.col("valid_from")), "valid_to": parse_day_first(F.col("valid_to"))})
    return validity.chain_valid_to(typed, "item_description", "valid_from", "valid_to", ["document_id", "table_id", "net_price"], as_of)
