"""Validity intervals of prices: chaining, expansion, fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chain_valid_to(df: DataFrame, item: str, valid_from: str, valid_to: str, order: list[str], as_of: Column) -> DataFrame:
    """Fill null valid_to with the day before the item's next valid_from, else with as_of.

    Only the immediately next row counts: if it has no date, as_of is taken. Rows are
    ordered by valid_from (null last), then by `order`, which must make the order total.
    """
    w = Window.partitionBy(item).orderBy(F.col(valid_from).asc_nulls_last(), *order)
    following = F.date_sub(F.lead(valid_from).over(w), 1)
    return df.withColumn(valid_to, F.coalesce(F.col(valid_to), following, as_of))


def expand_weekly(df: DataFrame, valid_from: str, valid_to: str, out_from: str = "week_from", out_to: str = "week_to") -> DataFrame:
    """A row for each 7 days from valid_from on, the last one clipped to valid_to.

    No start: the row stays, dates null. No end: one row without an end. End before start: no row.
    """
    start, end = F.col(valid_from), F.col(valid_to)
    weeks = (
        F.when(start.isNull() | end.isNull(), F.array(start))
        .when(start <= end, F.sequence(start, F.greatest(start, end), F.expr("interval 7 days")))
        .otherwise(F.array().cast("array<date>"))
    )
    clipped = F.when(F.col(out_from).isNotNull() & end.isNotNull(), F.least(F.date_add(out_from, 6), end)).otherwise(end)
    return df.withColumn(out_from, F.explode(weeks)).withColumn(out_to, clipped)


def fan_out(df: DataFrame, id_col: str, ids: DataFrame, limit: int = 10_000) -> DataFrame:
    """Every row once for each distinct id of `ids` (one column), the row's own id overwritten.

    With at most one id the rows are unchanged. The ids are a short list by meaning: a
    count checks that, and beyond `limit` the call is refused, as its result would be
    that many copies of the table.
    """
    name = ids.columns[0]
    distinct = ids.filter(F.col(name).isNotNull()).distinct()
    listed = [r[0] for r in distinct.orderBy(name).limit(limit + 1).collect()]
    if len(listed) > limit:
        raise ValueError(f"more than {limit} ids")
    if len(listed) <= 1:
        return df
    return df.withColumn(id_col, F.explode(F.array(*[F.lit(x) for x in listed])))
