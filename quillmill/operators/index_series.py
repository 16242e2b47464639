"""Prices against an index: as-of lookups, frequencies, re-pricing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.session import cut_lineage, maybe_broadcast


def by_month(index: DataFrame, index_date: str, index_value: str, series: str | None = None) -> DataFrame:
    """_series, _month, _found (d, v), _last: the row in force in each month from a series' first row to its last.

    A row is in force from the first month that begins on its date or later. As many rows
    as the index spans months, whatever the facts are.
    """
    named = index.filter(F.col(index_date).isNotNull()).select(
        (F.col(series) if series else F.lit("")).alias("_series"), F.col(index_date).cast("date").alias("d"), F.col(index_value).alias("v")
    )
    one = named.groupBy("_series", "d").agg(F.max("v").alias("v"))
    since = F.when(F.dayofmonth("d") == 1, F.col("d")).otherwise(F.add_months(F.trunc("d", "MM"), 1))
    w = Window.partitionBy("_series").orderBy("d")
    spans = one.withColumn("_from", since).withColumn("_next", F.lead("_from").over(w)).withColumn(
        "_last", F.max("_from").over(Window.partitionBy("_series"))
    )
    until = F.coalesce(F.add_months("_next", -1), F.col("_from"))
    months = F.when(F.col("_from") <= until, F.sequence("_from", F.greatest("_from", until), F.expr("interval 1 month")))
    return spans.select("_series", F.explode(months).alias("_month"), F.struct("d", "v").alias("_found"), "_last")


def as_of(
    df: DataFrame, date: str, index: DataFrame, index_date: str, index_value: str, out_date: str, out_value: str,
    series: str | None = None, index_series: str | None = None,
) -> DataFrame:
    """Adds date and value of the index row of the latest date not after the month of `date`.

    With series (a column of df) and index_series (one of the index) each row looks into
    its own series. The index is spelled out month by month and joined by equality, so df
    is not shuffled as long as the index has at most BROADCAST_ROWS months in all; a date
    after the last row takes the last row. A null value of the row that is found is
    returned as null, as is everything for a null date or a date before the first row. Of
    index rows of one date the largest value counts.
    """
    months = cut_lineage(by_month(index, index_date, index_value, index_series))
    month = F.trunc(F.col(date), "MM")
    found = maybe_broadcast(months.select(F.col("_series").alias("_s"), "_month", "_found"))
    if series is None:
        last = F.lit(months.agg(F.max("_last")).first()[0]).cast("date")
        asked, same = df.withColumn("_ask", F.when(month.isNotNull(), F.least(month, last))), F.lit(True)
    else:
        ends = maybe_broadcast(months.groupBy(F.col("_series").alias("_e")).agg(F.max("_last").alias("_end")))
        asked = df.join(ends, F.col(series) == F.col("_e"), "left").withColumn("_ask", F.when(month.isNotNull(), F.least(month, F.col("_end"))))
        same = F.col(series) == F.col("_s")
    return asked.join(found, same & (F.col("_ask") == F.col("_month")), "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.col("_found.d").alias(out_date), F.col("_found.v").alias(out_value)
    )


def prior_quarter(date: Column) -> Column:
    """The first of the month three months before."""
    return F.add_months(F.trunc(date, "MM"), -3)


def frequency(dates: DataFrame, series: str, date: str) -> DataFrame:
    """series, frequency: by the median gap between distinct dates; fewer than three dates are quarterly."""
    w = Window.partitionBy(series).orderBy(date)
    gaps = dates.select(series, date).distinct().withColumn("_gap", F.datediff(date, F.lag(date).over(w)))
    label = (
        F.when(F.count(F.lit(1)) < 3, "quarterly")
        .when(F.median("_gap") < 45, "monthly")
        .when(F.median("_gap") < 100, "quarterly")
        .otherwise("annual")
    )
    return gaps.groupBy(series).agg(label.alias("frequency"))


def match_series(series: DataFrame, name: str, position: str, target: str) -> DataFrame:
    """The first series whose name contains the target, else the first Australian index-number series."""
    text = F.lower(name)
    rank = F.when(text.contains(target.lower()), 0).when(text.contains("australia") & text.contains("index numbers"), 1)
    return series.withColumn("_rank", rank).filter("_rank is not null").agg(F.min_by(name, F.struct("_rank", position)).alias(name))


def reprice_locked(base_price: Column, base_index: Column, index: Column) -> Column:
    """base price * index / base index; null for a base of zero."""
    return F.when(base_index != 0, base_price * index / base_index)


def reprice_rolling(df: DataFrame, group: list[str], order: str, base_price: str, index: str, out: str) -> DataFrame:
    """Each price from the one before it: the ratios telescope, so it is base price * index / first index.

    Rows whose index is null or zero are passed over: their price is null.
    """
    w = Window.partitionBy(*group).orderBy(order)
    usable = F.when(F.col(index) != 0, F.col(index))
    first = F.first(usable, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(out, F.col(base_price) * usable / first)


def validity_of_adjusted(df: DataFrame, group: list[str], date: str, period_end: Column, out: str = "valid_to") -> DataFrame:
    """An adjusted row is valid to the next adjustment date (that day included), the last to the period's end."""
    w = Window.partitionBy(*group).orderBy(date)
    return df.withColumn(out, F.coalesce(F.lead(date).over(w), period_end))


def read_wide(df: DataFrame, date: str) -> DataFrame:
    """series, date, value: a wide index sheet of text columns in long form; undated rows go, bad numbers are null."""
    names = [c for c in df.columns if c != date]
    dated = df.withColumn(date, F.col(date).try_cast("date")).filter(F.col(date).isNotNull())
    long = dated.unpivot([date], names, "series", "value")
    return long.select("series", F.col(date).alias("date"), F.col("value").try_cast("double").alias("value"))
