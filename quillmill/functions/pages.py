"""Page numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def roman(text: Column) -> Column:
    """1 to 50 for a Roman numeral in its usual form, else null."""
    low = F.lower(F.trim(text))
    value = {"i": 1, "v": 5, "x": 10, "l": 50}
    digits = F.transform(F.split(low, ""), lambda c: F.create_map(*[F.lit(x) for p in value.items() for x in p])[c])
    total = F.aggregate(
        digits,
        F.struct(F.lit(0).alias("sum"), F.lit(99).alias("before")),
        # a digit after a smaller one takes that one away twice: it was added before
        lambda a, d: F.struct(
            (a["sum"] + d - F.when(d > a["before"], 2 * a["before"]).otherwise(0)).alias("sum"), d.alias("before")
        ),
        lambda a: a["sum"],
    )
    return F.when(low.rlike("^(l|x{1,4}|(xl|x{0,4})(ix|iv|v?i{0,4}))$") & (low != "") & total.between(1, 50), total)


def printed_page(line: Column) -> Column:
    """The page number a line consists of: `12`, `- 12 -`, `Page 12`, `12 of 40` or a Roman numeral."""
    text = F.trim(line)
    number = lambda pattern: F.regexp_extract(text, pattern, 1)
    found = [number(r"^[-\s]*(\d{1,4})[-\s]*$"), number(r"(?i)^page\s+(\d{1,4})\s*$"), number(r"(?i)^(\d{1,4})\s+of\s+\d+\s*$")]
    bare = F.regexp_replace(text, "^[- ]+|[- ]+$", "")
    return F.coalesce(*[F.when(x != "", x.cast("int")) for x in found], F.when(F.length(text) <= 8, roman(bare)))


def page_list(text: Column, last_page: Column) -> Column:
    """array of pages in `5`, `5-7` (also with an en dash) or `5, 6; 7`, those within 1 and last_page.

    A range is cut to the document before it is spelled out, whatever its ends are.
    """
    bound = lambda n: F.regexp_extract(text, r"^\s*(\d+)\s*[-–]\s*(\d+)\s*$", n).try_cast("decimal(38,0)")
    low, high = F.greatest(bound(1), F.lit(1)), F.least(bound(2), last_page)
    several = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("int"))
    none = F.array().cast("array<int>")
    inside = F.when(low <= high, F.sequence(low.cast("int"), F.greatest(low, high).cast("int"))).otherwise(none)
    pages = F.when(bound(1).isNotNull() & (bound(1) <= bound(2)), inside).otherwise(several)
    return F.array_distinct(F.filter(pages, lambda p: p.between(1, last_page)))


def to_absolute(printed: Column, offset: Column, footer_page: Column, total: Column) -> Column:
    """printed + offset if in range, else the page found by its footer, else clamped into the document."""
    shifted = printed + offset
    return F.coalesce(
        F.when(shifted.between(1, total), shifted), footer_page, F.greatest(F.lit(1), F.least(shifted, total)),
        F.greatest(F.lit(1), F.least(printed, total)),
    )
