"""Column mapping and target-table rules over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import pages, text
from quillmill.operators import mapping
from quillmill.plans import provider
from quillmill.queries.registry import query, table

_MAPPINGS = [
    ("part", 1, "TblInvoice", "Name", "item_description", "none", 0), ("part", 1, "TblInvoice", "Size", "quantity", "none", 1),
    ("part", 1, "TblInvoice", "Price", "unit_price", "currency", 2), ("part", 1, "TblInvoice", "Brand", "brand", "none", 3),
    ("part", 1, "TblInvoice", "Type", "item_description", "none", 4),
    ("part", 2, "TblTimesheets", "Name", "staff_equipment_name", "none", 0), ("part", 2, "TblTimesheets", "Size", "rate", "none", 1),
    ("part", 2, "TblTimesheets", "Type", "unit_price", "none", 2),
]


@query("""
WITH r AS (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part)
SELECT p_partkey, p_type AS item_description, CAST(p_size AS VARCHAR) AS quantity, CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS unit_price,
       NULL AS staff_equipment_name, NULL AS rate FROM r WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, NULL, NULL, NULL, p_name, CAST(p_size AS VARCHAR) FROM r WHERE p_partkey % 2 = 1
""")
def q_mapping_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one id, the first an invoice, the second a timesheet, each with its own proposal."""
    cents = "cast(round(p_retailprice * 100) as long)"
    price = F.expr(f"concat('$', cast({cents} div 100 as string), '.', lpad(cast({cents} % 100 as string), 2, '0'))")
    columns = {"Name": F.col("p_name"), "Size": F.col("p_size").cast("string"), "Price": price, "Brand": F.col("p_brand"), "Type": F.col("p_type")}
    cells = F.array(*[F.struct(F.lit(h).alias("header"), F.lit(i).alias("col_idx"), c.alias("value")) for i, (h, c) in enumerate(columns.items())])
    parts = table(spark, sf_dir, "part").select("p_partkey", F.lit("part").alias("table_id"), (F.col("p_partkey") % 2).alias("at"), cells.alias("cells"))
    numbered = mapping.occurrence(parts.select("table_id", "at").distinct(), ["table_id"], "at")
    rows = parts.join(F.broadcast(numbered), ["table_id", "at"]).select("p_partkey", "table_id", "occ", F.inline("cells"))  # two tables
    mappings = spark.createDataFrame(_MAPPINGS, "table_id string, occ int, target_table string, source string, target string, hint string, ord int")
    out = mapping.apply_mappings(rows, mappings, ["p_partkey"], {"TblInvoice": mapping.INVOICE, "TblTimesheets": mapping.TIMESHEET})
    return out.select("p_partkey", "item_description", "quantity", "unit_price", "staff_equipment_name", "rate")


@query("SELECT p_partkey FROM part UNION ALL SELECT -2")
def q_header_row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array("p_name", "p_brand", "p_type").alias("row"))
    planted = spark.createDataFrame([(-1, ["name", " BRAND", "x"]), (-2, ["", None, " "]), (-3, ["", "brand"])], "p_partkey long, row array<string>")
    headers = F.array(*[F.lit(h) for h in ("Name", "Brand", "Type")])
    return rows.unionByName(planted).filter(~mapping.looks_like_header(F.col("row"), headers)).select("p_partkey")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_returnflag END AS name,
       CASE l_linenumber WHEN 2 THEN '10.10' WHEN 3 THEN '7' END AS item
FROM lineitem WHERE l_linenumber <> 1 AND NOT (l_discount = 0 AND l_tax = 0)
""")
def q_timesheet_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(n == 1, " Sub Total ").when(n == 2, "10.10").when(n == 3, "7").otherwise(F.col("l_returnflag")).alias("name"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("quantity"), "l_tax",
        F.when(F.col("l_discount") == 0, "none").otherwise(F.col("l_discount").cast("string")).alias("charge"), F.lit(None).cast("string").alias("item"),
    )
    return mapping.filter_timesheet_rows(rows, "name", "quantity", "l_tax", "charge", "item").select("l_orderkey", "l_linenumber", "name", "item")


@query("SELECT o_orderkey, '1' AS flag FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 5 <> 0")
def q_primary_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "invoice").when(F.col("o_orderstatus") == "O", "Invoice_summary").otherwise("supply_document")
    title = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("DRAFT "), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    flagged = table(spark, sf_dir, "orders").select("o_orderkey", mapping.primary_flag(kind, title).alias("flag"))
    return mapping.keep_primary(flagged, "flag")


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 15 AS a, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CAST(unnest(CASE k WHEN 0 THEN generate_series(greatest(a, 1), least(a + 3, 10))
         WHEN 1 THEN list_distinct(list_filter([a, a + 1, 3], lambda p: p BETWEEN 1 AND 10)) WHEN 2 THEN generate_series(greatest(a, 1), 10) ELSE [] END) AS INTEGER) AS page FROM t
""")
def q_page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, key = F.col("o_orderkey") % 15, F.col("o_orderkey") % 4
    shown = (
        F.when(key == 0, F.concat_ws("-", a.cast("string"), (a + 3).cast("string")))
        .when(key == 1, F.format_string("%d, %d;3", a, a + 1))
        .when(key == 2, F.concat(a.cast("string"), F.lit(" – 20000000000")))  # to the end, however far
        .otherwise("n/a")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(pages.page_list(shown, F.lit(10))).alias("page"))


@query("""
WITH r AS (SELECT p_partkey, p_size, p_partkey % 7 AS k, ([0, 1, 2, 3, 2, 1])[p_size // 10 + 1] + ([0, 1, 2, 3, 2, 1, 2, 3, 4, 2])[p_size % 10 + 1] AS letters FROM part)
SELECT p_partkey, CASE WHEN k < 4 OR (k = 4 AND letters > 0) OR (k = 5 AND letters BETWEEN 1 AND 4) THEN p_size END AS page FROM r
""")
def q_roman_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey") % 7
    tens = F.array(*[F.lit(x) for x in ("", "x", "xx", "xxx", "xl", "l")])
    ones = F.array(*[F.lit(x) for x in ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")])
    roman = F.concat(F.get(tens, F.floor(size / 10).cast("int")), F.get(ones, size % 10))
    number = size.cast("string")
    line = (
        F.when(key == 0, number).when(key == 1, F.concat(F.lit("- "), number, F.lit(" -"))).when(key == 2, F.concat(F.lit("Page "), number))
        .when(key == 3, F.concat(number, F.lit(" of 120"))).when(key == 4, roman).when(key == 5, F.concat(F.lit("- "), F.upper(roman), F.lit(" -")))
        .otherwise(F.concat(F.lit("Item "), number))
    )
    return table(spark, sf_dir, "part").select("p_partkey", pages.printed_page(line).alias("page"))


@query(r"""
SELECT doc_id, coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace(regexp_replace(text, '[^0-9A-Za-z_.-]', '_', 'g'), '_+', '_', 'g'),
       '^[_.]+|[_.]+$', '', 'g'), 80), '[_.]+$', ''), ''), 'unnamed') AS slug FROM documents
""")
def q_safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.safe_name(F.col("text")).alias("slug"))


@query("""
WITH h AS (
  SELECT 'lineitem' AS table_id, column_name AS header FROM (DESCRIBE lineitem) UNION ALL SELECT 'part', column_name FROM (DESCRIBE part)
  UNION ALL SELECT 'orders', column_name FROM (DESCRIBE orders)
), w AS (SELECT * FROM (VALUES (1, 'unit_price', 'currency', 'unit price'), (2, 'unit_price', 'currency', 'retailprice'), (3, 'unit_price', 'currency', 'rate'),
  (4, 'amount', 'currency', 'extendedprice'), (5, 'amount', 'currency', 'amount'), (6, 'amount', 'currency', 'total price'), (7, 'amount', 'currency', 'totalprice'),
  (8, 'discount_rebate', 'none', 'discount'), (9, 'discount_rebate', 'none', 'rebate'), (10, 'gst', 'currency', 'gst'), (11, 'gst', 'currency', 'tax'),
  (12, 'quantity', 'none', 'quantity'), (13, 'quantity', 'none', 'qty'), (14, 'quantity', 'none', 'hours'), (15, 'invoice_date', 'date', 'shipdate'),
  (16, 'invoice_date', 'date', 'orderdate'), (17, 'invoice_date', 'date', 'invoice date'), (18, 'invoice_date', 'date', 'date'), (19, 'item_description', 'none', 'item'),
  (20, 'item_description', 'none', 'name'), (21, 'item_description', 'none', 'description'), (22, 'item_description', 'none', 'type'), (23, 'uom', 'none', 'uom'),
  (24, 'uom', 'none', 'unit'), (25, 'uom', 'none', 'size'), (26, 'invoice_number', 'none', 'orderkey')) v(n, target, hint, word)),
b AS (SELECT table_id, header, regexp_replace(lower(header), '^[a-z]_', '') AS low FROM h),
m AS (SELECT table_id, header, low, arg_min(target, n) AS target, arg_min(hint, n) AS hint, arg_min(word, n) AS word FROM b JOIN w ON contains(low, word) GROUP BY ALL)
SELECT table_id, header, coalesce(target, 'UNMAPPED') AS target, coalesce(round(length(word) / length(b.low), 2), 0) AS confidence, hint FROM b LEFT JOIN m USING (table_id, header)
""")
def q_provider_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name).columns for name in ("lineitem", "part", "orders")}
    headers = spark.createDataFrame([(t, c) for t, cs in tables.items() for c in cs], "table_id string, header string")
    return provider.propose_mappings(headers, "table_id", "header")
