"""Page intervals of sections: ends, coverage, merging, repair. One group is one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What fills gaps and tails, and their confidences.
GAP_TYPE, GAP_CONFIDENCE = "unhandled_content", 0.5
TAIL_TYPE, TAIL_CONFIDENCE = "back_matter", 0.7
REPAIRED_CONFIDENCE = 0.60


def next_value(df: DataFrame, group: list[str], order: list[str], value: str, out: str, default: str = "END") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.lead(value, 1, default).over(w))


def resolve_end(df: DataFrame, group: list[str], order: list[str], start: str, end: str, total: Column) -> DataFrame:
    """A null end becomes the page before the next start, for the last section the last page."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(end, F.coalesce(F.col(end), F.lead(start).over(w) - 1, total))


def cover(df: DataFrame, group: list[str], order: list[str], kind: str, start: str, end: str, total: int) -> DataFrame:
    """Intervals that cover 1..total once: clamped, filled and extended.

    A start moves behind what the sections before it cover; a section left without a
    page is dropped. Gaps become sections of their own. Pages behind the last section
    extend it if it is a tail type already, else they are a section. Adds `source`:
    scan, gap_fill or trailing_fill.
    """
    keep = [*group, kind, start, end]
    w = Window.partitionBy(*group).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    valid = df.filter(F.col(start) <= F.col(end))
    seen = F.coalesce(F.max(end).over(before), F.lit(0))
    clamped = (
        valid.withColumn("_seen", seen)
        .withColumn("_start", F.greatest(F.col(start), F.col("_seen") + 1))
        .filter(F.col("_start") <= F.col(end))
        .withColumn("_last", F.lead(F.lit(True), 1).over(w).isNull())
    )
    tail = F.col("_last") & (F.col(end) < total)
    extends = tail & F.col(kind).isin(TAIL_TYPE, GAP_TYPE)
    new = lambda kind_, a, b, source: F.struct(
        kind_.alias(kind), a.cast("int").alias(start), b.cast("int").alias(end), F.lit(source).alias("source")
    )
    pieces = F.array(
        F.when(F.col("_start") > F.col("_seen") + 1, new(F.lit(GAP_TYPE), F.col("_seen") + 1, F.col("_start") - 1, "gap_fill")),
        new(F.col(kind), F.col("_start"), F.when(extends, F.lit(total)).otherwise(F.col(end)), "scan"),
        F.when(tail & ~extends, new(F.lit(TAIL_TYPE), F.col(end) + 1, F.lit(total), "trailing_fill")),
    )
    return clamped.select(*group, F.explode(F.array_compact(pieces)).alias("_p")).select(
        *keep[: len(group)], F.col(f"_p.{kind}"), F.col(f"_p.{start}"), F.col(f"_p.{end}"), F.col("_p.source")
    )


def merge_runs(df: DataFrame, group: list[str], order: list[str], same: list[str], adjacent: Column | None = None) -> DataFrame:
    """Adds `island`: numbers runs of neighbours with equal `same` columns (and `adjacent`, over lag values, if given)."""
    w = Window.partitionBy(*group).orderBy(*order)
    joins = F.lit(True)
    for c in same:
        joins = joins & F.col(c).eqNullSafe(F.lag(c).over(w)) & F.lag(F.lit(True)).over(w).isNotNull()
    if adjacent is not None:
        joins = joins & adjacent
    started = df.withColumn("_starts", (~F.coalesce(joins, F.lit(False))).cast("int"))
    return started.withColumn("island", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_starts")


def merge_adjacent(df: DataFrame, group: list[str], start: str, end: str, kind: str, name: str) -> DataFrame:
    """Neighbouring sections of one type and name as one section; the first name stays."""
    w = Window.partitionBy(*group).orderBy(start, end, name)
    touching = F.col(start) <= F.lag(end).over(w) + 1
    return (
        merge_runs(df, group, [start, end, name], [kind, name], touching)
        .groupBy(*group, "island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.min_by(kind, start).alias(kind), F.min_by(name, F.struct(start, end, name)).alias(name))
        .drop("island")
    )


def flag_unreliable(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Adds `unreliable` (value below the one before it) and `run_id` (runs of flagged rows; 0 outside)."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("unreliable", F.coalesce(F.col(value) < F.lag(value).over(w), F.lit(False)))
    begins = (F.col("unreliable") & ~F.coalesce(F.lag("unreliable").over(w), F.lit(False))).cast("int")
    run = F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("_begins", begins).withColumn("run_id", F.when(F.col("unreliable"), run).otherwise(0)).drop("_begins")


def repair_starts(df: DataFrame, group: list[str], order: list[str], start: str, total: Column) -> DataFrame:
    """Unreliable starts are spread evenly between the reliable ones around them, with a low confidence."""
    flagged = flag_unreliable(df, group, order, start)
    w = Window.partitionBy(*group).orderBy(*order)
    good = F.when(~F.col("unreliable"), F.col(start))
    low = F.last(good, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) + 1
    high = F.coalesce(F.first(good, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)) - 1, total)
    run = Window.partitionBy(*group, "run_id")
    nth = F.row_number().over(run.orderBy(*order))
    n = F.count(F.lit(1)).over(run)
    spread = flagged.withColumn("_low", low).withColumn("_high", high).withColumn("_nth", nth).withColumn("_n", n)
    step = F.greatest(F.lit(1), F.floor((F.col("_high") - F.col("_low") + 1) / (F.col("_n") + 1)))
    guess = F.least(F.col("_low") + F.col("_nth") * step, F.greatest(F.col("_high"), F.col("_low"))).cast("int")
    return (
        spread.withColumn(start, F.when(F.col("unreliable"), guess).otherwise(F.col(start)))
        .withColumn("confidence", F.when(F.col("unreliable"), F.lit(REPAIRED_CONFIDENCE)).otherwise(F.lit(1.0)))
        .drop("_low", "_high", "_nth", "_n", "run_id")
    )


def to_pages(df: DataFrame, start: str, end: str, page: str = "page") -> DataFrame:
    """A row for each page of an interval; intervals without a page give none."""
    valid = df.filter(F.col(start) <= F.col(end))
    return valid.withColumn(page, F.explode(F.sequence(F.col(start), F.col(end))))


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """True if the intervals share a page, or if there is no interval."""
    return start.isNull() | ((end >= low) & (start <= high))


def context_window(df: DataFrame, group: list[str], order: str, hit: Column, before: int, after: int) -> DataFrame:
    """Rows from `before` rows before a hit to `after` rows behind it; overlaps once."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-after, before)
    return df.withColumn("_near", F.max(hit.cast("int")).over(w)).filter("_near = 1").drop("_near")


#: What marks a line of an adjustment formula, as it is written.
CLAUSE_MARKERS = (
    "Po =", "Po=", "CPIo", "CPIln", "CPIn", "Pn =", "Pn=", "base price", "Base Price", "Review Milestone", "calendar quarter", "Cat No.", "6401",
)


def clause_context(lines: DataFrame, group: list[str], order: str, text: str, before: int = 30, after: int = 49) -> DataFrame:
    """The lines around those that speak of price adjustment or mark a formula; lines of nothing but spaces (of any width, no-break ones too) do not count."""
    from quillmill.functions.text import ESCALATION_KEYWORDS, contains_any

    hit = contains_any(F.col(text), ESCALATION_KEYWORDS)
    for marker in CLAUSE_MARKERS:
        hit = hit | F.contains(text, F.lit(marker))
    return context_window(lines.filter(F.col(text).rlike(r"[^\p{Zs}]")), group, order, hit, before, after)
