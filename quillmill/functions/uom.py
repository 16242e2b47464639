"""Units of measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Unit text to code; None marks junk, which is cleared.
UOM_CODES: dict[str, str | None] = {
    "hours": "HR", "hour": "HR", "hr": "HR", "hrs": "HR", "hur": "HR", "per hour": "HR", "p/h": "HR", "per hr": "HR",
    "/hr": "HR", "/hour": "HR", "hourly": "HR",
    "days": "DAY", "day": "DAY", "dy": "DAY", "dys": "DAY", "daily": "DAY", "per day": "DAY", "p/d": "DAY",
    "ea": "EA", "each": "EA", "unit": "EA", "units": "EA", "pc": "EA", "pcs": "EA", "piece": "EA", "pieces": "EA",
    "item": "EA", "no": "EA", "no.": "EA",
    "lot": "LOT", "lo": "LOT", "ls": "LOT", "lump sum": "LOT", "lump": "LOT", "lumpsum": "LOT",
    "week": "WK", "weeks": "WK", "wk": "WK", "wks": "WK", "per week": "WK",
    "month": "MTH", "months": "MTH", "mth": "MTH", "mths": "MTH", "per month": "MTH", "monthly": "MTH", "mo": "MTH",
    "tonne": "T", "tonnes": "T", "ton": "T", "tons": "T", "t": "T", "tl": "T", "mt": "T",
    "kg": "KG", "kgs": "KG", "kilogram": "KG", "kilograms": "KG", "lb": "LB", "lbs": "LB",
    "litre": "L", "litres": "L", "liter": "L", "liters": "L", "l": "L", "lt": "L", "ltr": "L", "ml": "ML", "kl": "KL",
    "kilolitre": "KL",
    "metre": "M", "metres": "M", "meter": "M", "meters": "M", "m": "M", "km": "KM", "mm": "MM",
    "m2": "M2", "sqm": "M2", "sq m": "M2", "m3": "M3", "cum": "M3",
    "roll": "ROLL", "rolls": "ROLL", "rol": "ROLL", "shift": "SHIFT", "shifts": "SHIFT",
    "0": None, "o": None, "0 . 0": None, "0.0": None, "subtotal": None, "total": None, "fifo": None, "cab surface": None,
    "n/a": None, "-": None, "": None,
}
#: Unit text in price lists to canonical names.
PRICE_UNITS = {
    "h": "Hour", "hr": "Hour", "hrs": "Hour", "hour": "Hour", "hourly": "Hour", "hours": "Hour", "per hour": "Hour",
    "$/hr": "Hour", "$/h": "Hour", "d": "Day", "dy": "Day", "day": "Day", "daily": "Day", "days": "Day", "per day": "Day",
    "$/day": "Day", "wk": "Week", "week": "Week", "weekly": "Week", "weeks": "Week", "per week": "Week", "mth": "Month",
    "mo": "Month", "month": "Month", "monthly": "Month", "months": "Month", "per month": "Month", "yr": "Year",
    "year": "Year", "annual": "Year", "annually": "Year", "per annum": "Year", "pa": "Year", "ea": "Each", "each": "Each",
    "per item": "Each", "per unit": "Each", "unit": "Each", "t": "Tonne", "tonne": "Tonne", "ton": "Tonne",
    "tonnes": "Tonne", "per tonne": "Tonne", "$/t": "Tonne", "kg": "Kilogram", "kilogram": "Kilogram",
    "per kg": "Kilogram", "ls": "Lump Sum", "lump sum": "Lump Sum", "lumpsum": "Lump Sum", "lump": "Lump Sum",
    "fixed": "Lump Sum", "m": "Metre", "metre": "Metre", "meter": "Metre", "per metre": "Metre", "per meter": "Metre",
    "m2": "Square Metre", "sqm": "Square Metre", "sq m": "Square Metre", "square metre": "Square Metre",
    "shift": "Shift", "per shift": "Shift", "trip": "Trip", "per trip": "Trip", "lot": "Lot", "per lot": "Lot",
    "km": "Kilometre", "kilometre": "Kilometre", "kilometer": "Kilometre",
}


def uom_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(UOM_CODES.items()), "uom_key string, uom_code string")


def uom_key(value: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))


def with_uom_code(df: DataFrame, column: str, out: str = "uom") -> DataFrame:
    """Adds `out`: the code of a known unit, null for junk, the cleaned text of an unknown one; null stays null.

    The map is a constant of a hundred rows, so it is broadcast.
    """
    known = F.broadcast(uom_table(df.sparkSession).withColumn("uom_found", F.lit(True)))
    cleaned = F.trim(F.regexp_replace(F.col(column), r"\s+", " "))
    return (
        df.join(known, uom_key(F.col(column)) == F.col("uom_key"), "left")
        .withColumn(out, F.when(F.col("uom_found"), F.col("uom_code")).otherwise(cleaned))
        .drop("uom_key", "uom_code", "uom_found")
    )


def price_unit(value: Column) -> Column:
    """The canonical name of a price unit, or the text as it is (left to a provider)."""
    known = F.create_map(*[F.lit(x) for pair in PRICE_UNITS.items() for x in pair])
    return F.coalesce(known[uom_key(value)], value)
