"""Matching and pricing steps over the relational tables: descriptions, terms, price lists, adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.operators import counters, dedupe, index_series, intervals, mapping
from quillmill.plans import cpi, pricing, rules
from quillmill.queries.registry import query, table


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumns({"adjective": F.split("p_name", " ")[0], "noun": F.split("p_name", " ")[1], "price": F.floor("p_retailprice").cast("string")})


@query("""
SELECT p_partkey, p_name AS orig_name, CASE WHEN p_name LIKE 'hot %' THEN upper(p_name) ELSE p_name END AS name,
       CASE WHEN p_name LIKE 'hot %' THEN CAST(90 AS BIGINT) WHEN p_name LIKE 'cold %' THEN 50 END AS confidence FROM part
""")
def q_replace_by_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _named(spark, sf_dir)
    matches = parts.filter("adjective in ('hot', 'cold')").select(
        F.col("p_name").alias("value"), F.upper("p_name").alias("matched"), F.when(F.col("adjective") == "hot", 0.9).otherwise(0.5).alias("confidence")
    ).distinct()
    out = mapping.replace_by_match(parts.select("p_partkey", F.col("p_name").alias("name")), "name", matches)
    return out.select("p_partkey", "orig_name", "name", F.round(F.col("name_norm_confidence") * 100).cast("long").alias("confidence"))


@query("""
SELECT 'found' AS ask, arg_min(n_name, n_nationkey) AS series FROM nation WHERE contains(lower(n_name), 'nation_1')
UNION ALL SELECT 'default', arg_min('Index Numbers ; Australia ; ' || n_name, n_nationkey) FROM nation
""")
def q_match_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    found = index_series.match_series(nations, "n_name", "n_nationkey", "Nation_1")
    default = index_series.match_series(nations.withColumn("n_name", F.concat(F.lit("Index Numbers ; Australia ; "), "n_name")), "n_name", "n_nationkey", "no such")
    return found.select(F.lit("found").alias("ask"), F.col("n_name").alias("series")).unionByName(default.select(F.lit("default").alias("ask"), F.col("n_name").alias("series")))


@query("""
SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 10 END AS s, o_orderkey % 10 + o_orderkey % 4 AS e FROM orders) WHERE s IS NULL OR (e >= 5 AND s <= 7)
""")
def q_page_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    start = F.when(key % 11 > 0, key % 10)
    return table(spark, sf_dir, "orders").filter(intervals.overlaps(start, key % 10 + key % 4, F.lit(5), F.lit(7))).select("o_orderkey")


@query("""
SELECT p_partkey, p_brand, 'C-' || p_brand AS contract_id, split_part(p_name, ' ', 2) AS item_description, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS net_price,
       CASE WHEN p_size % 3 = 0 THEN 'USD' ELSE 'AUD' END AS currency, CASE WHEN p_size % 3 = 0 THEN '1/7/2024' ELSE '1/1/2024' END AS valid_from,
       CASE p_size % 3 WHEN 0 THEN 'Hour' WHEN 2 THEN 'Day' END AS price_unit
FROM part WHERE p_size % 4 <> 3
""")
def q_pricing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, size = _named(spark, sf_dir), F.col("p_size")
    priced = size % 4 != 3
    tables = parts.select(
        F.col("p_brand").alias("document_id"), F.col("p_partkey").alias("table_id"), F.col("p_partkey").alias("ord"),
        F.when(priced, "Schedule of Rates").otherwise("Contacts").alias("section"), F.lit("").alias("caption"),
        F.when(size % 3 == 0, "Effective Date: 1/7/2024 in USD per hour").when(size % 3 == 2, "daily").otherwise("").alias("context"),
        F.when(priced, F.array(F.lit("Role"), F.lit("Day Rate"))).otherwise(F.array(F.lit("Name"), F.lit("Phone"))).alias("headers"),
        F.array(F.array("noun", F.when(priced, F.col("price")).otherwise("x"))).alias("rows"),
    )
    defaults = parts.select(
        F.col("p_brand").alias("document_id"), F.concat(F.lit("C-"), "p_brand").alias("contract_id"), F.lit("AUD").alias("currency"), F.lit("1/1/2024").alias("valid_from"),
        F.lit(None).cast("string").alias("valid_to"),
    ).distinct()
    items = pricing.pricing_items(tables, defaults)
    return items.select(
        F.col("table_id").alias("p_partkey"), F.col("document_id").alias("p_brand"), "contract_id", "item_description", "net_price", "currency", "valid_from", "price_unit"
    )


@query("""
WITH q AS (SELECT * FROM (VALUES (DATE '2024-01-01', DATE '2024-04-01', 102), (DATE '2024-04-01', DATE '2024-07-01', 104), (DATE '2024-07-01', DATE '2024-10-01', 106),
  (DATE '2024-10-01', DATE '2024-12-31', 108)) v(f, t, i)),
p AS (SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS price, contains(p_name, 'bolt') AS hit, bool_or(contains(p_name, 'bolt')) OVER (PARTITION BY p_brand) AS any_hit FROM part)
SELECT p_partkey, f AS valid_from, t AS valid_to, price * i AS cents,
       'CPI Adjusted (cpi_ratio) | Po: ' || price || '.00 | CPIo: 100.0 | CPIn: ' || i || '.0 | Pn: ' || CAST(price * i // 100 AS BIGINT) || '.' || lpad(CAST(price * i % 100 AS VARCHAR), 2, '0')
         || ' | Period: 01/01/2024-31/12/2024' AS label
FROM p, q WHERE hit OR NOT any_hit
""")
def q_adjust_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _named(spark, sf_dir)
    prices = parts.select(F.col("p_brand").alias("document_id"), F.col("p_partkey").alias("row_id"), F.col("p_name").alias("item"), F.concat(F.lit("$"), "price").alias("net_price"))
    day = lambda d: F.lit(d).cast("date")
    formulas = parts.select(
        F.col("p_brand").alias("document_id"), F.lit("p").alias("period_id"), day("2024-01-01").alias("period_start"), day("2024-12-31").alias("period_end"),
        F.lit("quarterly").alias("frequency"), F.lit("A").alias("series"), F.lit(None).cast("double").alias("base_price"), F.lit(100.0).alias("base_index"), F.lit("bolt").alias("keyword"),
    ).distinct()
    values = [("A", "2024-01-01", 102.0), ("A", "2024-04-01", 104.0), ("A", "2024-06-15", 106.0), ("A", "2024-10-01", 108.0), ("B", "2024-01-01", 1.0)]
    index = spark.createDataFrame(values, "series string, date string, value double").withColumn("date", F.col("date").cast("date"))
    out = cpi.adjust_prices(prices, formulas, index)
    base = F.col("price") * 100 / F.col("index_value")
    label = cpi.adjustment_label(F.lit("cpi_ratio"), base, F.col("base_index"), F.col("index_value"), F.col("price"), day("2024-01-01"), day("2024-12-31"))
    return out.select(F.col("row_id").alias("p_partkey"), "valid_from", "valid_to", F.round(F.col("price") * 100).cast("long").alias("cents"), label.alias("label"))


@query("""
WITH t AS (SELECT DISTINCT p_name AS term, string_split(p_name, ' ') AS ws FROM part)
SELECT p_partkey, term, CAST(len(list_intersect(ws, said)) * 50 AS BIGINT) AS percent
FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), string_split(lower(p_type), ' ')) AS said FROM part), t WHERE list_has_any(ws, said)
""")
def q_match_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    sections = parts.select(F.col("p_partkey").alias("section_id"), F.concat("p_name", F.lit(" ("), "p_type", F.lit(")")).alias("text"))
    out = rules.match_terms(sections, parts.select(F.col("p_name").alias("term")).distinct())
    return out.select(F.col("section_id").alias("p_partkey"), "term", F.round(F.col("score") * 100).cast("long").alias("percent"))


_BAG = r"list_filter(list_distinct(string_split(trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\p{{M}}]+', ' ', 'g')), ' ')), lambda w: w <> '')"


@query(f"""
WITH w AS (SELECT doc_id, {_BAG.format("text")} AS a, {_BAG.format("split_part(text, chr(10), 1)")} AS b FROM documents)
SELECT doc_id, CAST(len(a) AS BIGINT) AS words, CAST(len(a) - len(list_intersect(a, b)) AS BIGINT) AS missed FROM w WHERE len(a) > 0
""")
def q_page_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = rules.page_recall(docs, docs.select("doc_id", F.split("text", "\n")[0].alias("text")), ["doc_id"])
    return out.select("doc_id", F.col("total_elements_on_page").alias("words"), F.col("elements_missed").alias("missed"))


@query("""
SELECT DISTINCT upper(split_part(p_name, ' ', 2)) || ', ' || split_part(p_name, ' ', 1) AS value, p_name AS matched, CAST(100 AS BIGINT) AS percent FROM part
""")
def q_match_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _named(spark, sf_dir)
    values = parts.select(F.concat(F.upper("noun"), F.lit(", "), "adjective").alias("value")).unionByName(parts.select(F.concat("p_name", F.lit(" extra")).alias("value"))).distinct()
    out = rules.match_descriptions(values, parts.select(F.col("p_name").alias("reference")).distinct())
    return out.select("value", "matched", F.round(F.col("confidence") * 100).cast("long").alias("percent"))


@query("""
SELECT DISTINCT ' ' || upper(p_name) || 's' AS value, p_name AS matched, CAST(floor(20000.0 * length(p_name) / (2 * length(p_name) + 1)) AS BIGINT) AS score_bp FROM part
""")
def q_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    values = names.select(F.concat(F.lit(" "), F.upper("p_name"), F.lit("s")).alias("value"))
    out = dedupe.fuzzy_match(values, names.select(F.col("p_name").alias("candidate"), F.col("p_name").alias("ord")))
    return out.select("value", "matched", F.floor(F.col("score") * 10000 + 1e-6).cast("long").alias("score_bp"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'CPI A' WHEN 1 THEN event_type END AS series, CASE event_id % 3 WHEN 1 THEN event_type ELSE 'all' END AS applies_to,
       CASE event_id % 3 WHEN 0 THEN 'quarterly' END AS frequency, CASE event_id % 3 WHEN 0 THEN CAST(event_id AS DOUBLE) END AS base_price, CASE event_id % 3 WHEN 1 THEN CAST(130.5 AS DOUBLE) END AS base_index
FROM events
""")
def q_formula_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id") % 3
    js = (
        F.when(key == 0, F.concat(F.lit('{"series": " CPI A | CPI B", "applies_to": "None", "frequency": " Quarterly", "Po": "'), "event_id", F.lit('"}')))
        .when(key == 1, F.concat(F.lit('{"cpi_series": "'), "event_type", F.lit('", "items": " '), "event_type", F.lit('", "CPIo": 130.5, "base_price": "n/a"}')))
        .otherwise('{"index": "n/a"}')
    )
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in counters.normalise_formula(js).items()])


@query("SELECT p_partkey, 'steel ' || split_part(p_name, ' ', 2) || '|grout|an|' || split_part(p_name, ' ', 1) || ' type' AS keywords FROM part")
def q_filter_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _named(spark, sf_dir)
    said = F.concat(F.lit("Steel "), "noun", F.lit(" prices ("), "adjective", F.lit(" type) and all Grout, AN price"))
    return parts.select("p_partkey", F.array_join(F.filter(text.filter_keywords(said), lambda w: ~w.startswith("an ")), "|").alias("keywords"))
