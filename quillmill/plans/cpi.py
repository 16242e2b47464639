"""Re-pricing by adjustment clauses: a row of prices and a formula give a row for each adjustment date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import dates, money
from quillmill.operators import index_series
from quillmill.session import cut_lineage, maybe_broadcast

#: Months between adjustments, by name.
STEPS = {"annual": 12, "annually": 12, "yearly": 12, "half-yearly": 6, "semi-annual": 6, "quarterly": 3, "monthly": 1}


def step_months(frequency: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in STEPS.items() for x in pair])
    return F.coalesce(known[F.lower(F.trim(frequency))], F.lit(3))


def adjustment_label(kind: Column, base_price: Column, base_index: Column, index: Column, price: Column, start: Column, end: Column) -> Column:
    """What an adjusted row says of itself: prices with two decimals, indexes with one."""
    day = lambda d: F.date_format(d, "dd/MM/yyyy")
    return F.format_string(
        "CPI Adjusted (%s) | Po: %.2f | CPIo: %.1f | CPIn: %.1f | Pn: %.2f | Period: %s-%s", kind, base_price, base_index, index, price, day(start), day(end)
    )


def adjust_prices(prices: DataFrame, formulas: DataFrame, index: DataFrame) -> DataFrame:
    """document_id, row_id, period_id, valid_from, valid_to, price, index_date, index_value, base_price, base_index for each adjustment date.

    prices: document_id, row_id, item, net_price (text). formulas: document_id, period_id,
    period_start, period_end (dates), frequency, series, base_price and base_index (null:
    rolling), keyword (null: all rows of the document; a keyword without a hit is for all
    of them too). index: series, date, value. Rows meet the periods of their own document.
    Prices and indexes are carried within a row; each base is locked or rolls on its own.
    """
    from quillmill.functions.text import keyword_match

    periods = formulas.select("document_id", "period_id", "period_start", "period_end", "frequency", "series", "base_price", "base_index", "keyword")
    rows = prices.select("document_id", "row_id", "item", money.parse_price(F.col("net_price")).alias("own_price"))
    hit = rows.join(maybe_broadcast(periods), "document_id").withColumn("hit", F.coalesce(keyword_match(F.col("item"), F.col("keyword")), F.lit(True)))
    any_hit = hit.groupBy("document_id", "period_id").agg(F.max("hit").alias("any_hit"))  # a row a period
    wanted = hit.join(maybe_broadcast(cut_lineage(any_hit)), ["document_id", "period_id"]).filter("hit or not any_hit").drop("hit", "any_hit")

    when = dates.adjustment_dates(F.col("period_start"), F.col("period_end"), step_months(F.col("frequency")))
    dated = wanted.withColumn("date", F.explode(when))
    looked = index_series.as_of(dated, "date", index, "date", "value", "index_date", "index_value", series="series", index_series="series")
    rolled = looked.withColumn("_start", F.coalesce("base_price", "own_price"))
    group = ["document_id", "row_id", "period_id"]
    rolling = index_series.reprice_rolling(rolled, group, "date", "_start", "index_value", "_rolling")
    locked = index_series.reprice_locked(F.col("_start"), F.col("base_index"), F.col("index_value"))
    out = rolling.withColumn("price", F.when(F.col("base_index").isNotNull(), locked).otherwise(F.col("_rolling")))
    out = index_series.validity_of_adjusted(out.withColumnRenamed("date", "valid_from"), group, "valid_from", F.col("period_end"))
    return out.select(*group, "valid_from", "valid_to", "price", "index_date", "index_value", "base_price", "base_index")
