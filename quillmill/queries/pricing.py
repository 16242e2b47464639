"""Prices: validity, index adjustment, text and number parsing, over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import dates, money, pricing_text, uom
from quillmill.operators import index_series, intervals, reshape, validity
from quillmill.queries.registry import query, table

AS_OF = "DATE '2002-01-01'"


@query(f"""
SELECT o_custkey, o_orderkey, valid_from,
       coalesce(valid_to, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from NULLS LAST, o_orderkey) - 1, {AS_OF}) AS valid_to
FROM (SELECT o_custkey, o_orderkey,
             CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS valid_from,
             CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to FROM orders)
""")
def q_valid_to_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderkey") % 17 != 0, day).alias("valid_from"),
        F.when(F.col("o_orderkey") % 11 == 0, F.date_add(day, 30)).alias("valid_to"),
    )
    return validity.chain_valid_to(rows, "o_custkey", "valid_from", "valid_to", ["o_orderkey"], F.expr(AS_OF))


@query("""
SELECT o_orderkey, CAST(g AS DATE) AS week_from, least(CAST(g AS DATE) + 6, t) AS week_to
FROM (SELECT o_orderkey, t, unnest(generate_series(f, t, INTERVAL 7 DAY)) AS g
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS f,
                   CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) - 3 AS t FROM orders))
""")
def q_weekly_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("f"), F.date_add(day, (F.col("o_orderkey") % 45 - 3).cast("int")).alias("t")
    )
    return validity.expand_weekly(rows, "f", "t").select("o_orderkey", "week_from", "week_to")


@query("SELECT n_nationkey, n_name, r_name AS contract_id FROM nation, (SELECT DISTINCT r_name FROM region)")
def q_contract_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit("").alias("contract_id"))
    return validity.fan_out(nations, "contract_id", table(spark, sf_dir, "region").select("r_name"))


_INDEX = """
WITH idx AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS m, l_returnflag AS s, CAST(round(max(l_extendedprice) * 100) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2
)"""
_SERIES = "CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END"


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarterly series: the largest price of each return flag, in cents."""
    quarter = F.trunc(F.col("l_shipdate").cast("date"), "QUARTER")
    largest = F.round(F.max("l_extendedprice") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").groupBy(quarter.alias("m"), F.col("l_returnflag").alias("s")).agg(largest.alias("v"))


@query(_INDEX + f"""
SELECT o_orderkey, idx.m AS index_month, idx.v AS index_value
FROM (SELECT o_orderkey, {_SERIES} AS s, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders) o ASOF LEFT JOIN idx ON o.s = idx.s AND o.d >= idx.m
""")
def q_asof_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SERIES).alias("s"), F.col("o_orderdate").cast("date").alias("d"))
    found = index_series.as_of(orders, "d", _index(spark, sf_dir), "m", "v", "index_month", "index_value", series="s", index_series="s")
    return found.select("o_orderkey", "index_month", "index_value")


@query(_INDEX + """
SELECT o_orderkey, lookup_month, idx.m AS index_month, idx.v AS index_value
FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 3 MONTH AS DATE) AS lookup_month FROM orders) o
ASOF LEFT JOIN (SELECT * FROM idx WHERE s = 'N') idx ON o.lookup_month >= idx.m
""")
def q_prior_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", index_series.prior_quarter(F.col("o_orderdate").cast("date")).alias("lookup_month")
    )
    index = _index(spark, sf_dir).filter("s = 'N'")
    return index_series.as_of(orders, "lookup_month", index, "m", "v", "index_month", "index_value")


_QUARTERS = "(VALUES (0, DATE '2024-01-01', {0}), (1, DATE '2024-04-01', {1}), (2, DATE '2024-07-01', {2}), (3, DATE '2024-10-01', {3}), (4, DATE '2025-01-01', {4})) q(k, d, i)"


def _quarterly(spark: SparkSession, sf_dir: str, values: list[float]) -> DataFrame:
    """Each part with five quarterly adjustment dates and the index of each."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).alias("cents"))
    dated = parts.withColumn(
        "d", F.explode(dates.adjustment_dates(F.lit("2024-01-01").cast("date"), F.lit("2025-01-02").cast("date"), F.lit(3)))
    )
    index = F.create_map(*[F.lit(x) for pair in zip(("2024-01", "2024-04", "2024-07", "2024-10", "2025-01"), values, strict=True) for x in pair])
    return dated.withColumn("i", index[F.date_format("d", "yyyy-MM")])


def _adjusted(priced: DataFrame) -> DataFrame:
    out = index_series.validity_of_adjusted(priced, ["p_partkey"], "d", F.lit("2025-03-31").cast("date"))
    return out.select("p_partkey", F.col("d").alias("valid_from"), "valid_to", F.floor("price").cast("long").alias("price_cents"))


_ADJUSTED = """
SELECT p_partkey, d AS valid_from, coalesce(lead(d) OVER (PARTITION BY p_partkey ORDER BY d), DATE '2025-03-31') AS valid_to,
       CAST(floor(round(p_retailprice * 100) * nullif(i, 0) / {base}) AS BIGINT) AS price_cents
FROM part, {quarters}
"""


@query(_ADJUSTED.format(base="100.0", quarters=_QUARTERS.format("102.0", "104.0", "106.0", "108.0", "110.0")))
def q_cpi_locked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _quarterly(spark, sf_dir, [102.0, 104.0, 106.0, 108.0, 110.0])
    return _adjusted(rows.withColumn("price", index_series.reprice_locked(F.col("cents"), F.lit(100.0), F.col("i"))))


@query(_ADJUSTED.format(base="104.0", quarters=_QUARTERS.format("104.0", "102.0", "0.0", "108.0", "110.0")))
def q_cpi_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _quarterly(spark, sf_dir, [104.0, 102.0, 0.0, 108.0, 110.0])
    return _adjusted(index_series.reprice_rolling(rows, ["p_partkey"], "d", "cents", "i", "price"))


@query("""
WITH o AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 400 AS e,
         CASE o_orderkey % 4 WHEN 0 THEN 12 WHEN 1 THEN 6 WHEN 2 THEN 1 ELSE 3 END AS step FROM orders
), k AS (SELECT *, unnest(generate_series(0, 14)) AS k FROM o),
d AS (
  SELECT o_orderkey, k, e,
         CASE WHEN k = 0 THEN s ELSE CAST(make_date(year(s), month(s), least(day(s), 28)) + to_months(CAST(k * step AS INTEGER)) AS DATE) END AS adj_date
  FROM k
)
SELECT o_orderkey, adj_date FROM d WHERE k = 0 OR adj_date < e
""")
def q_adjust_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    step = F.when(key == 0, 12).when(key == 1, 6).when(key == 2, 1).otherwise(3)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(dates.adjustment_dates(day, F.date_add(day, 400), step)).alias("adj_date"))


@query("""
WITH d AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events),
g AS (SELECT event_type, d - lag(d) OVER (PARTITION BY event_type ORDER BY d) AS gap FROM d)
SELECT event_type, CASE WHEN count(*) < 3 THEN 'quarterly' WHEN median(gap) < 45 THEN 'monthly'
                        WHEN median(gap) < 100 THEN 'quarterly' ELSE 'annual' END AS frequency FROM g GROUP BY event_type
""")
def q_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("date").alias("d"))
    return index_series.frequency(days, "event_type", "d")


@query("""
SELECT l_orderkey, l_linenumber, qualifier, CAST(round(v * 100) AS BIGINT) AS cents, ord
FROM (SELECT l_orderkey, l_linenumber, unnest([{'ord': 0, 'qualifier': 'price', 'v': l_extendedprice},
        {'ord': 1, 'qualifier': 'tax', 'v': l_tax}, {'ord': 2, 'qualifier': 'discount', 'v': l_discount}], recursive := true) FROM lineitem)
WHERE v <> 0
""")
def q_unpivot_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = lambda c: F.when(F.col(c) != 0, F.round(F.col(c) * 100).cast("long"))
    prices = {"price": cents("l_extendedprice"), "tax": cents("l_tax"), "discount": cents("l_discount")}
    return reshape.unpivot_prices(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], prices).withColumnRenamed("price", "cents")


@query("""
SELECT user_id, CAST(isodow(ts) - 1 AS INTEGER) AS day_idx, count(*) AS hours FROM events GROUP BY 1, 2
""")
def q_day_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = [str(d) for d in range(7)]
    wide = table(spark, sf_dir, "events").groupBy("user_id").agg(
        *[F.count_if(F.weekday(F.col("ts").cast("date")) == int(d)).alias(d) for d in days]
    )
    long = reshape.day_rows(wide, ["user_id"], {d: F.col(d) for d in days})
    return long.select("user_id", "day_idx", F.col("hours").cast("long").alias("hours"))


def _case(key: str, values: list[str]) -> str:
    """SQL text of both engines: the value at the key's remainder."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _values(rows: list[tuple]) -> str:
    text = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN CAST(o_orderdate AS DATE) END AS work_date,
       CASE o_orderkey % 6 WHEN 2 THEN 'Day' WHEN 3 THEN 'Night' WHEN 5 THEN 'Training' ELSE '' END AS shift_type FROM orders
""")
def q_day_column_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    header = (
        F.when(key % 6 == 0, F.date_format(day, "EEE d/M/yyyy"))
        .when(key % 6 == 1, F.concat(F.lit("weekly_total_"), F.date_format(day, "d_MM_yyyy")))
        .when(key % 6 == 2, F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" - Day Shift Hours")))
        .when(key % 6 == 3, F.concat(F.date_format(day, "d/MM/yyyy"), F.lit(" Nightshift")))
        .when(key % 6 == 4, F.concat(F.date_format(day, "EEEE"), F.lit(" Hours")))
        .otherwise("Training")
    )
    week_ending = F.when(key % 6 == 4, F.date_format(F.date_add(day, (key % 7).cast("int")), "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.day_column_date(header, week_ending).alias("work_date"), dates.day_column_shift(header).alias("shift_type")
    )


@query("""
SELECT c_custkey, sign || CAST(whole AS VARCHAR) || CASE WHEN c_custkey % 4 = 3 THEN '' ELSE '.' || frac END AS parsed
FROM (SELECT c_custkey, CASE WHEN c < 0 THEN '-' ELSE '' END AS sign, abs(c) // 100 AS whole, lpad(CAST(abs(c) % 100 AS VARCHAR), 2, '0') AS frac
      FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS c FROM customer))
""")
def q_parse_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, key = F.round(F.col("c_acctbal") * 100).cast("long"), F.col("c_custkey") % 4
    sign, whole = F.when(c < 0, "-").otherwise(""), F.expr("abs(cast(round(c_acctbal * 100) as long)) div 100")
    frac = F.lpad((F.abs(c) % 100).cast("string"), 2, "0")
    grouped = F.when(whole >= 1000, F.concat((whole / 1000).cast("int").cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")))
    grouped = grouped.otherwise(whole.cast("string"))
    text = (
        F.when(key == 0, F.concat(F.lit("AUD "), sign, whole.cast("string"), F.lit("."), frac))
        .when(key == 1, F.concat(F.lit("$"), sign, grouped, F.lit(","), frac))
        .when(key == 2, F.concat(F.lit("A$"), sign, grouped, F.lit("."), frac))
        .otherwise(F.concat(F.lit("$ "), sign, grouped))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", money.parse_currency(text).alias("parsed"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS parsed FROM orders")
def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 5
    shown = (
        F.when(key == 0, F.date_format(day, "dd.MM.yyyy"))
        .when(key == 1, F.date_format(day, "d/M/yyyy"))
        .when(key == 2, F.date_format(day, "d MMMM yyyy"))
        .when(key == 3, F.date_format(day, "MMM dd, yyyy"))
        .otherwise(F.concat(F.lit("W/E "), F.date_format(day, "dd-MM-yy")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(shown).alias("parsed"))


@query("""
SELECT p_partkey, txt, CASE WHEN p_partkey % 5 = 0 THEN txt ELSE replace(trim(txt), ',', '') END AS cleaned
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name || ', ' || p_partkey
                             ELSE ' ' || (p_partkey // 1000) || ',' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.50' END AS txt FROM part)
""")
def q_numeric_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    txt = F.when(key % 5 == 0, F.concat("p_name", F.lit(", "), key.cast("string"))).otherwise(
        F.concat(F.lit(" "), F.expr("cast(p_partkey div 1000 as string)"), F.lit(","), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".50"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", txt.alias("txt")).withColumn("cleaned", money.numeric_cleanup(F.col("txt")))


_UNITS = [
    ("HRS", "HR"), (" per  hour ", "HR"), ("Total", None), ("pallet", "pallet"), (None, None), ("Sq M", "M2"), ("n/a", None), ("Lump Sum", "LOT"),
    ("hourly", "HR"), ("/hour", "HR"), ("Days", "DAY"), ("P/D", "DAY"), ("each", "EA"), ("Pcs", "EA"), ("No.", "EA"), ("lo", "LOT"), ("WKS", "WK"),
    ("monthly", "MTH"), ("mo", "MTH"), ("Tonnes", "T"), ("mt", "T"), ("kgs", "KG"), ("LB", "LB"), ("Litres", "L"), ("ml", "ML"), ("kilolitre", "KL"),
    ("metres", "M"), ("KM", "KM"), ("mm", "MM"), ("cum", "M3"), ("rol", "ROLL"), ("Shifts", "SHIFT"), ("0.0", None), ("fifo", None), ("-", None), ("box of 10", "box of 10"),
]


@query(f"""
SELECT p_partkey, orig_uom, uom FROM part
JOIN (VALUES {_values([(i, *u) for i, u in enumerate(_UNITS)])}) v(k, orig_uom, uom) ON p_partkey % {len(_UNITS)} = k
""")
def q_uom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get(F.array(*[F.lit(u[0]).cast("string") for u in _UNITS]), (F.col("p_partkey") % len(_UNITS)).cast("int"))
    rows = table(spark, sf_dir, "part").select("p_partkey", raw.alias("orig_uom"))
    return uom.with_uom_code(rows, "orig_uom")


_PRICE_UNIT = [("$/hr", "Hour"), (" Per Day", "Day"), ("wk", "Week"), ("p.a.x", "p.a.x"), ("pa", "Year"), ("EA", "Each"), ("$/t", "Tonne"), ("fixed", "Lump Sum"), ("sqm", "Square Metre"), (None, None)]


@query(f"""
SELECT p_partkey, unit FROM part JOIN (VALUES {_values([(i, u[1]) for i, u in enumerate(_PRICE_UNIT)])}) v(k, unit) ON p_partkey % {len(_PRICE_UNIT)} = k
""")
def q_price_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get(F.array(*[F.lit(u[0]).cast("string") for u in _PRICE_UNIT]), (F.col("p_partkey") % len(_PRICE_UNIT)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", uom.price_unit(raw).alias("unit"))


@query(r"""
SELECT doc_id,
  CASE WHEN regexp_matches(text, '\b(AUD|USD|EUR|GBP|NZD|CAD|SGD|HKD|JPY|CNY|INR)\b') THEN regexp_extract(text, '\b(AUD|USD|EUR|GBP|NZD|CAD|SGD|HKD|JPY|CNY|INR)\b', 1)
       WHEN regexp_matches(text, '[Aa]ustralian\s+[Dd]ollars?') THEN 'AUD' WHEN regexp_matches(text, 'US\s+[Dd]ollars?') THEN 'USD'
       WHEN regexp_matches(text, '[Ss]terling|[Pp]ounds?\s+[Ss]terling') THEN 'GBP' ELSE '' END AS currency,
  CASE WHEN regexp_matches(text, '\$/\s*hr|per\s+hour|hourly') THEN 'Hour' WHEN regexp_matches(text, '\$/\s*day|per\s+day|daily') THEN 'Day'
       WHEN regexp_matches(text, '\$/\s*week|per\s+week|weekly') THEN 'Week' WHEN regexp_matches(text, '\$/\s*month|per\s+month|monthly') THEN 'Month'
       WHEN regexp_matches(text, '\$/\s*year|per\s+annum|annual') THEN 'Year' WHEN regexp_matches(text, 'per\s+ton(ne)?|\$/t\b') THEN 'Tonne'
       WHEN regexp_matches(text, 'per\s+k(g|ilogram)') THEN 'Kilogram' WHEN regexp_matches(text, 'per\s+unit|each|per\s+item') THEN 'Each'
       WHEN regexp_matches(text, 'per\s+met(re|er)|\$/m\b') THEN 'Metre' WHEN regexp_matches(text, 'per\s+(sq\s*m|m2|square\s+met)') THEN 'Square Metre'
       WHEN regexp_matches(text, 'lump\s+sum|fixed\s+(fee|price)') THEN 'Lump Sum' WHEN regexp_matches(text, 'per\s+trip') THEN 'Trip'
       WHEN regexp_matches(text, 'per\s+shift') THEN 'Shift' WHEN regexp_matches(text, 'per\s+lot') THEN 'Lot' ELSE '' END AS uom
FROM (SELECT doc_id, text || CASE doc_id % 7 WHEN 0 THEN ' payable in AUD, per hour' WHEN 1 THEN ' US dollars per square metre' WHEN 2 THEN ' a lump sum' ELSE '' END AS text FROM documents)
""")
def q_detect_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id") % 7
    more = F.when(key == 0, " payable in AUD, per hour").when(key == 1, " US dollars per square metre").when(key == 2, " a lump sum").otherwise("")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", more).alias("text"))
    return rows.select("doc_id", pricing_text.detect_currency(F.col("text")).alias("currency"), pricing_text.detect_unit(F.col("text")).alias("uom"))


_LABELS = [
    ("Effective Date:", "VALID_FROM"), ("Expiry date (inclusive)", "VALID_TO"), ("Contract No.", "CONTRACT_ID"), ("Payment Currency", "CURRENCY"),
    ("Supplier", "COMPANY_CODE"), ("Scope of work", None), ("Agreement reference", "CONTRACT_ID"), ("EXPIRES", "VALID_TO"), ("Dated", "VALID_FROM"),
    ("Organisation", "COMPANY_CODE"), ("", None), ("(Contract No. inside)", None), ("valid until:", "VALID_TO"), ("undated", None),
]


@query(f"""
SELECT p_partkey, field FROM part JOIN (VALUES {_values([(i, x[1]) for i, x in enumerate(_LABELS)])}) v(k, field) ON p_partkey % {len(_LABELS)} = k
""")
def q_kv_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.get(F.array(*[F.lit(x[0]) for x in _LABELS]), (F.col("p_partkey") % len(_LABELS)).cast("int"))
    shown = F.when(F.col("p_size") % 2 == 0, F.upper(label)).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "), label))
    return table(spark, sf_dir, "part").select("p_partkey", pricing_text.label_field(shown).alias("field"))


@query("""
WITH p AS (SELECT p_partkey, p_size % 7 AS k, split_part(p_name, ' ', 1) AS w FROM part)
SELECT p_partkey, CASE WHEN k IN (0, 1, 5) THEN 'price' WHEN k = 2 THEN 'TARGET_QUANTITY' WHEN k = 3 THEN 'ITEM_DESCRIPTION' WHEN k = 6 THEN 'MAX_RATE' END AS kind,
       CASE k WHEN 0 THEN w WHEN 1 THEN w WHEN 2 THEN 'Qty ' || w WHEN 3 THEN w || ' Description' WHEN 4 THEN w || ' comments' WHEN 5 THEN '' ELSE 'Maximum ' || w END AS qualifier,
       CASE k WHEN 0 THEN 'AUD' WHEN 5 THEN 'USD' ELSE '' END AS currency, k = 0 OR k = 5 AS currency_header
FROM p
""")
def q_price_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    word, key = F.split("p_name", " ")[0], F.col("p_size") % 7
    texts = [(word, " AUD"), (word, " Rate ($/hr)"), ("Qty ", word), (word, " Description"), (word, " comments"), ("usd", ""), ("Maximum ", word)]
    h = F.get(F.array(*[F.concat(*[F.lit(x) if isinstance(x, str) else x for x in t]) for t in texts]), key.cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.when(pricing_text.is_price_header(h), "price").otherwise(pricing_text.header_field(h)).alias("kind"),
        pricing_text.price_qualifier(h).alias("qualifier"), pricing_text.header_currency(h).alias("currency"), pricing_text.is_currency_header(h).alias("currency_header"),
    )


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'MSA-2025-' || c_custkey WHEN 1 THEN CAST(4500000000 + c_custkey AS VARCHAR)
                                      ELSE 'PRJ-2025/' || c_custkey END AS contract_id FROM customer
""")
def q_contract_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = (
        F.when(key % 3 == 0, F.concat(F.lit("MSA-2025-"), key.cast("string")))
        .when(key % 3 == 1, F.concat(F.lit("Contract Number: "), (key + 4500000000).cast("string")))
        .otherwise(F.concat(F.lit("Ref: PRJ-2025/"), key.cast("string")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", pricing_text.contract_id(text).alias("contract_id"))


_COVER_ROWS = """
WITH r AS (
  SELECT l_suppkey, l_returnflag, l_quantity, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem
), s AS (
  SELECT l_suppkey, rn, CASE WHEN l_returnflag = 'R' THEN 'unhandled_content' ELSE 'schedule' END AS section_type,
         rn * 5 + l_linenumber % 4 AS a, rn * 5 + l_linenumber % 4 + CAST(l_quantity AS INTEGER) % 8 - 1 AS b FROM r
)"""


@query(_COVER_ROWS + """
, v AS (SELECT *, coalesce(max(b) OVER (PARTITION BY l_suppkey ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM s WHERE a <= b),
c AS (SELECT *, greatest(a, seen + 1) AS ca FROM v WHERE greatest(a, seen + 1) <= b),
l AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY rn DESC) = 1 AS last FROM c)
SELECT l_suppkey, section_type, CAST(ca AS INTEGER) AS start_page,
       CAST(CASE WHEN last AND b < 100000 AND section_type = 'unhandled_content' THEN 100000 ELSE b END AS INTEGER) AS end_page, 'scan' AS source FROM l
UNION ALL SELECT l_suppkey, 'unhandled_content', CAST(seen + 1 AS INTEGER), CAST(ca - 1 AS INTEGER), 'gap_fill' FROM l WHERE ca > seen + 1
UNION ALL SELECT l_suppkey, 'back_matter', CAST(b + 1 AS INTEGER), 100000, 'trailing_fill' FROM l WHERE last AND b < 100000 AND section_type <> 'unhandled_content'
""")
def q_interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_cover_lineitem")
    rows = spark.sql(_COVER_ROWS.replace("FROM lineitem", "FROM _cover_lineitem") + " SELECT l_suppkey, rn, section_type, cast(a as int) start_page, cast(b as int) end_page FROM s")
    return intervals.cover(rows, ["l_suppkey"], ["rn"], "section_type", "start_page", "end_page", 100000)


_RUN_ROWS = """
  SELECT l_suppkey, rn * 3 AS s, rn * 3 + CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE 2 END AS e, l_returnflag AS kind, l_linestatus AS name FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus, l_shipdate) AS rn FROM {0})"""


@query(f"""
WITH r AS ({_RUN_ROWS.format("lineitem")}),
f AS (SELECT *, NOT coalesce(kind = lag(kind) OVER w AND name = lag(name) OVER w AND s <= lag(e) OVER w + 1, false) AS starts FROM r WINDOW w AS (PARTITION BY l_suppkey ORDER BY s)),
i AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY l_suppkey ORDER BY s) AS island FROM f)
SELECT l_suppkey, CAST(min(s) AS INTEGER) AS s, CAST(max(e) AS INTEGER) AS e, kind, name FROM i GROUP BY l_suppkey, island, kind, name
""")
def q_merge_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_RUN_ROWS.format("{lineitem}"), lineitem=table(spark, sf_dir, "lineitem")).withColumns({"s": F.col("s").cast("int"), "e": F.col("e").cast("int")})
    return intervals.merge_adjacent(rows, ["l_suppkey"], "s", "e", "kind", "name")


@query("""
WITH r AS (SELECT p_partkey, p_size, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS n, CAST(floor(p_retailprice) AS INTEGER) AS p FROM part)
SELECT p_partkey, n || ' - Day' AS description, CAST(p AS VARCHAR) AS price, 'AUD' AS currency, 0 AS ord FROM r WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey, n || ' - ' || a, CAST(p + 1 AS VARCHAR), '', 1 FROM r WHERE p_size % 3 = 0 AND p_size % 2 = 0
UNION ALL SELECT p_partkey, n, CASE WHEN p_size % 2 = 0 THEN CAST(p AS VARCHAR) ELSE '' END, '', 0 FROM r WHERE p_size % 3 = 1
UNION ALL SELECT p_partkey, n, CAST(p AS VARCHAR), '', 0 FROM r WHERE p_size % 3 = 2
""")
def q_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, price = F.col("p_size") % 3, F.col("p_retailprice").cast("int")
    adjective, noun = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    even = F.col("p_size") % 2 == 0
    text = lambda c: c.cast("string")
    headers = F.when(kind == 0, F.array(F.lit("Role"), F.lit("Day AUD"), F.concat(adjective, F.lit(" Rate")))).when(kind == 1, F.array(F.lit("Item"), F.lit("Rate")))
    row = F.when(kind == 0, F.array(noun, text(price), F.when(even, text(price + 1)).otherwise(F.lit(" ")))).when(
        kind == 1, F.array(noun, F.when(even, text(price)))
    )
    tables = table(spark, sf_dir, "part").select(
        "p_partkey", headers.otherwise(F.array(F.lit("Item"), F.lit("Notes"))).alias("headers"), row.otherwise(F.array(noun, text(price))).alias("row")
    )
    return reshape.price_rows(tables, ["p_partkey"])


@query("""
WITH f AS (SELECT user_id, event_id, ts, coalesce(value < lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS unreliable FROM events),
b AS (SELECT *, unreliable AND NOT coalesce(lag(unreliable) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS begins FROM f)
SELECT user_id, event_id, unreliable,
       CASE WHEN unreliable THEN CAST(sum(CAST(begins AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) ELSE 0 END AS run_id
FROM b
""")
def q_nonmonotonic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.flag_unreliable(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id", "unreliable", "run_id")


@query("""
WITH r AS (SELECT l_suppkey, CAST(rn AS INTEGER) AS rn, CAST(rn * 4 + CASE WHEN l_linenumber = 3 THEN -9 ELSE 0 END AS INTEGER) AS s FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)),
f AS (SELECT *, coalesce(s < lag(s) OVER (PARTITION BY l_suppkey ORDER BY rn), false) AS bad FROM r),
g AS (SELECT *, bad AND NOT coalesce(lag(bad) OVER (PARTITION BY l_suppkey ORDER BY rn), false) AS begins, CASE WHEN NOT bad THEN s END AS good FROM f),
h AS (SELECT *, CASE WHEN bad THEN sum(CAST(begins AS INTEGER)) OVER (PARTITION BY l_suppkey ORDER BY rn) ELSE 0 END AS run,
             last_value(good IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS low,
             coalesce(first_value(good IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 1, 100000) AS high FROM g),
i AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, run ORDER BY rn) AS nth, count(*) OVER (PARTITION BY l_suppkey, run) AS n FROM h)
SELECT l_suppkey, rn, CAST(CASE WHEN bad THEN least(low + nth * greatest(1, floor((high - low + 1) / (n + 1))), greatest(high, low)) ELSE s END AS INTEGER) AS s, bad AS unreliable
FROM i
""")
def q_repair_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_RUN_ROWS.format("{lineitem}").replace("SELECT l_suppkey,", "SELECT l_linenumber, l_suppkey,", 1), lineitem=table(spark, sf_dir, "lineitem"))
    starts = rows.select(
        "l_suppkey", (F.col("s") / 3).cast("int").alias("rn"), ((F.col("s") / 3).cast("int") * 4 + F.when(F.col("l_linenumber") == 3, -9).otherwise(0)).alias("s")
    )
    return intervals.repair_starts(starts, ["l_suppkey"], ["rn"], "s", F.lit(100000)).select("l_suppkey", "rn", "s", "unreliable")
