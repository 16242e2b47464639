"""Date expressions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats in the order in which they are tried; day first, US last.
DATE_FORMATS = (
    "d.M.yyyy", "d/M/yyyy", "d-M-yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-M-d", "yyyy/M/d",
    "d.M.yy", "d/M/yy", "d-M-yy", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy",
)
#: Formats of a week-ending header.
WEEK_ENDING_FORMATS = ("yyyy-M-d", "d/M/yyyy", "d/M/yy", "d-M-yyyy", "d.M.yyyy")
#: Day names to days after Monday.
DAY_INDEX = {
    "mon": 0, "monday": 0, "tue": 1, "tues": 1, "tuesday": 1, "wed": 2, "wednesday": 2, "thu": 3, "thur": 3, "thurs": 3,
    "thursday": 3, "fri": 4, "friday": 4, "sat": 5, "saturday": 5, "sun": 6, "sunday": 6,
}


def try_dates(text: Column, formats: tuple[str, ...]) -> Column:
    """The date by the first format that fits. Two-digit years 69 to 99 are 19xx."""
    found = []
    for f in formats:
        parsed = F.try_to_date(text, f)
        if "yyyy" not in f:
            parsed = F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)
        found.append(parsed)
    return F.coalesce(*found)


def parse_date(value: Column) -> Column:
    """ISO text of the date; else the text with dots and slashes as dashes.

    One leading W/E or three-letter day, with an optional dash, is dropped first.
    """
    bare = F.trim(F.regexp_replace(value, r"^(?:W/E|w/e|Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s*-?\s*", ""))
    date = F.date_format(try_dates(bare, DATE_FORMATS), "yyyy-MM-dd")
    dashed = F.translate(bare, "./", "--")
    return F.coalesce(date, F.when(dashed != "", dashed), value)


def parse_day_first(value: Column) -> Column:
    """A date; day first, several separators; null if none fits."""
    return try_dates(F.trim(value), ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "d/M/yy"))


def _from_parts(text: Column, separator: str) -> Column:
    """The date in the first d<sep>m<sep>y of the text; two-digit years are 20yy."""
    pattern = rf"(\d{{1,2}}){separator}(\d{{1,2}}){separator}(\d{{2,4}})"
    part = lambda i: F.regexp_extract(text, pattern, i)
    year = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(part(3))
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), part(2), part(1)), "yyyy-M-d")


def day_column_date(header: Column, week_ending: Column) -> Column:
    """The work date a day column's header stands for: a date in it, or a bare day name
    counted back from the week's end. Null if there is neither."""
    text = F.trim(header)
    bare = F.rtrim(F.regexp_replace(F.lower(F.trim(F.regexp_replace(text, r"(?i)[\s_]*(hours|shift).*", ""))), "_+$", ""))
    days = F.create_map(*[F.lit(x) for pair in DAY_INDEX.items() for x in pair])
    end = try_dates(F.trim(week_ending), WEEK_ENDING_FORMATS)
    back = F.pmod(F.weekday(end) - days[bare], F.lit(7))
    return F.coalesce(_from_parts(text, "/"), _from_parts(text, "_"), F.date_sub(end, back))


def day_column_shift(header: Column) -> Column:
    """Night, Day, the word found, or an empty string."""
    found = F.trim(F.regexp_extract(header, r"(?i)(Day\s*Shift|Night\s*Shift|Training|Mob-Demob|Standdown)", 1))
    low = F.lower(found)
    return F.when(low.contains("night"), "Night").when(low.contains("day"), "Day").otherwise(found)


def adjustment_dates(start: Column, end: Column, step_months: Column) -> Column:
    """array of dates: start, then every step with the day cut to 28, strictly before end.

    The start is always there, even when it is not before end.
    """
    anchor = F.make_date(F.year(start), F.month(start), F.least(F.dayofmonth(start), F.lit(28)))
    n = F.greatest(F.ceil(F.months_between(end, start) / step_months), F.lit(0)).cast("int") + 1
    later = F.filter(
        F.transform(F.sequence(F.lit(1), n), lambda k: F.add_months(anchor, k * step_months)), lambda d: d < end
    )
    return F.concat(F.array(start), F.coalesce(later, F.array().cast("array<date>")))
