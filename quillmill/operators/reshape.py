"""Wide to long and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import pricing_text


def unpivot_prices(df: DataFrame, ids: list[str], prices: dict[str, Column]) -> DataFrame:
    """ids, qualifier, price, ord: a row for each price that is not null, in the order given."""
    entries = F.array(
        *[F.struct(F.lit(i).alias("ord"), F.lit(q).alias("qualifier"), c.alias("price")) for i, (q, c) in enumerate(prices.items())]
    )
    return (
        df.select(*ids, F.explode(F.filter(entries, lambda e: e["price"].isNotNull())).alias("e"))
        .select(*ids, "e.ord", "e.qualifier", "e.price")
    )


def price_rows(tables: DataFrame, ids: list[str], headers: str = "headers", row: str = "row") -> DataFrame:
    """ids, description, price, currency, ord: the rows of tables with dynamic headers (arrays of text).

    Several price columns: a row for each that is not blank, the qualifier behind the
    description. One: a row even if blank. None: the first cell that is a number.
    """
    cells = F.transform(
        F.arrays_zip(F.col(headers).alias("h"), F.col(row).alias("c")),
        lambda x: F.struct(F.coalesce(x["h"], F.lit("")).alias("h"), F.coalesce(x["c"], F.lit("")).alias("c")),
    )
    priced = F.filter("cells", lambda x: pricing_text.is_price_header(x["h"]))
    described = F.coalesce(
        F.get(F.filter("cells", lambda x: pricing_text.header_field(x["h"]) == "ITEM_DESCRIPTION"), F.lit(0))["c"],
        F.get(F.filter("cells", lambda x: ~pricing_text.is_price_header(x["h"]) & ~x["h"].rlike("^[0-9$€£]")), F.lit(0))["c"],
        F.lit(""),
    )
    number = F.filter("cells", lambda x: x["c"].rlike(r"^[\s$€£]*-?[\d,]+(\.\d+)?\s*$"))
    wanted = (
        F.when(F.size("priced") > 1, F.filter("priced", lambda x: F.trim(x["c"]) != ""))
        .when(F.size("priced") == 1, F.col("priced"))
        .otherwise(F.slice(number, F.lit(1), F.lit(1)))
    )
    out = tables.select(*ids, cells.alias("cells")).select(*ids, "cells", priced.alias("priced"), described.alias("described"))
    qualifier = F.when(F.size("priced") > 1, pricing_text.price_qualifier(F.col("e.h"))).otherwise(F.lit(""))
    return out.select(*ids, "priced", "described", F.posexplode(wanted).alias("ord", "e")).select(
        *ids,
        F.concat_ws(" - ", F.when(F.col("described") != "", F.col("described")), F.when(qualifier != "", qualifier)).alias("description"),
        F.trim(F.col("e.c")).alias("price"),
        pricing_text.header_currency(F.col("e.h")).alias("currency"),
        "ord",
    )


def day_rows(df: DataFrame, ids: list[str], days: dict[str, Column], hours: str = "hours") -> DataFrame:
    """ids, day, day_idx, hours: a row for each day cell that is neither blank nor zero; text that is no number stays."""
    entries = F.array(
        *[F.struct(F.lit(i).alias("day_idx"), F.lit(d).alias("day"), c.cast("string").alias("cell")) for i, (d, c) in enumerate(days.items())]
    )
    kept = F.filter(
        entries, lambda e: (F.coalesce(F.trim(e["cell"]), F.lit("")) != "") & F.coalesce(e["cell"].try_cast("double") != 0, F.lit(True))
    )
    return df.select(*ids, F.explode(kept).alias("e")).select(*ids, "e.day_idx", "e.day", F.col("e.cell").alias(hours))


def to_matrix(headers: Column, values: Column) -> Column:
    """The values of a map in the order of the headers; missing ones are empty."""
    return F.transform(headers, lambda h: F.coalesce(F.try_element_at(values, h), F.lit("")))
