"""Money and number expressions over text; everything stays text until a typed view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Currency codes that may lead an amount.
LEADING_CODES = ("AUD", "USD", "EUR", "GBP", "NZD", "CAD", "SGD")
#: Fields whose text is a number although no transform is asked for.
NUMERIC_TARGETS = (
    "net_amount", "gst", "gross_amount", "quantity", "unit_price", "amount", "rate", "charge", "discount_rebate", "price_units",
)


def parse_currency(value: Column) -> Column:
    """Digits, point and sign of an amount; a last comma before one or two digits is the point if there is none.

    Null stays null; text without any digit, point or sign is returned as it is.
    """
    text = F.regexp_replace(F.trim(value), r"^A?\$", "")
    text = F.regexp_replace(F.trim(text), f"^({'|'.join(LEADING_CODES)})", "")
    text = F.regexp_replace(text, r"\s+", "")
    decimal_comma = ~text.contains(".") & text.rlike(r",\d{1,2}$")
    text = F.when(decimal_comma, F.regexp_replace(text, r",(\d{1,2})$", ".$1")).otherwise(text)
    text = F.regexp_replace(text, r"[^0-9.\-]", "")
    return F.when(text == "", value).otherwise(text)


def numeric_cleanup(value: Column) -> Column:
    """The text without thousands commas if that makes it a number, else as it is."""
    bare = F.replace(F.trim(value), F.lit(","), F.lit(""))
    return F.when(bare.try_cast("double").isNotNull(), bare).otherwise(value)


def parse_price(value: Column) -> Column:
    """double; null for blank or malformed text."""
    bare = F.regexp_replace(F.trim(value), r"[^\d.\-]", "")
    return F.when(bare != "", bare.try_cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """value as a double within bounds; low where it is no number."""
    return F.greatest(F.least(F.coalesce(value.try_cast("double"), F.lit(low)), F.lit(high)), F.lit(low))
