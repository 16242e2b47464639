"""Deduplication, reconciliation and quality reports over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import dedupe, quality
from quillmill.plans import reconcile
from quillmill.queries.pricing import _values
from quillmill.queries.registry import query, table

_ALL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) % 3 ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, {_ALL}) = 1
""")
def q_invoice_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat(F.lit("Item "), "l_orderkey")
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {"item": F.when(F.col("l_partkey") % 2 == 0, F.upper(item)).otherwise(F.concat(item, F.lit(" "))), "amount": F.col("l_quantity").cast("int") % 3}
    )
    kept = dedupe.invoice_dedupe(rows, "item", ["l_linenumber", "amount"], F.col("l_returnflag") == "R", _ALL.split(", "))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT doc_id, min(pos) AS pos, line
FROM (SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
GROUP BY doc_id, line
""")
def q_dedupe_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return dedupe.paragraph_dedupe(lines, ["doc_id"], "line", "pos")


_VERDICTS = "CASE WHEN quality = 1 AND toxic = 0 THEN {0} WHEN quality = 0 AND toxic = 0 THEN {1} WHEN quality = 1 THEN {2} ELSE {3} END"


@query(f"""
WITH v AS (SELECT lang, {_VERDICTS.format("'C'", "'I'", "'M'", "'U'")} AS v FROM labels JOIN documents USING (doc_id)),
a AS (SELECT lang, count(*) AS total, count(*) FILTER (v = 'C') AS correct, count(*) FILTER (v = 'I') AS incorrect, count(*) FILTER (v = 'M') AS missing FROM v GROUP BY lang)
SELECT *, correct + incorrect + missing AS verifiable,
       CASE WHEN correct + incorrect + missing > 0 THEN correct * 10000 // (correct + incorrect + missing) ELSE 0 END AS accuracy_bp FROM a
""")
def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _VERDICTS.format("'right'", "' Wrong '", "'not found'", "'no idea'")
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return quality.accuracy(rows.withColumn("verdict", F.expr(words)), ["lang"], "verdict")


@query("""
WITH d AS (SELECT source, n_chars % 101 AS c, doc_id % 7 = 0 AS e FROM documents),
a AS (SELECT source, count(*) AS n, avg(c) AS average, CAST(median(c) * 2 AS BIGINT) AS median_x2, count(*) FILTER (c >= 99) AS perfect,
             count(*) FILTER (c >= 80 AND c < 99) AS high, count(*) FILTER (c > 0 AND c < 50) AS low, count(*) FILTER (c = 0) AS "none",
             CAST(count(*) FILTER (e) AS BIGINT) AS errors FROM d GROUP BY source)
SELECT source, n, median_x2, perfect, high, low, "none", errors,
       CASE WHEN average >= 95 AND errors = 0 THEN 'A' WHEN average >= 85 THEN 'B' WHEN average >= 70 THEN 'C' WHEN average >= 50 THEN 'D' ELSE 'F' END AS grade FROM a
""")
def q_coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("source", (F.col("n_chars") % 101).alias("coverage"), (F.col("doc_id") % 7 == 0).alias("error"))
    return quality.coverage_statistics(rows, ["source"], "coverage", F.col("error")).drop("average")


@query("""
SELECT source, doc_id, coverage FROM (
  SELECT source, doc_id, n_chars % 101 AS coverage, row_number() OVER (PARTITION BY source ORDER BY n_chars % 101, doc_id) AS r FROM documents)
WHERE r <= 10 AND coverage < 100
""")
def q_worst_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", (F.col("n_chars") % 101).alias("coverage"))
    return quality.worst_rows(rows, ["source"], "coverage", "doc_id")


@query("""
SELECT source, avg(c) < 0.85 OR min(c) < 0.70 AS needs_review
FROM (SELECT source, CASE WHEN n_chars > 1500 THEN 1.0 WHEN n_chars > 300 THEN 0.7 ELSE 0.5 END AS c FROM documents) GROUP BY source
""")
def q_confidence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when(F.col("n_chars") > 1500, 1.0).when(F.col("n_chars") > 300, 0.7)
    return quality.review_flag(table(spark, sf_dir, "documents").select("source", c.alias("c")), ["source"], "c")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def q_class_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.class_rollup(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("""
SELECT p_brand, p_name AS canonical, n FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, length(p_name) DESC, p_name) = 1
""")
def q_canonical_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.canonical_variant(table(spark, sf_dir, "part"), ["p_brand"], "p_name")


@query("""
WITH d AS (SELECT l_returnflag, datediff('day', o_orderdate, l_shipdate) AS offset_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT l_returnflag, offset_days, count(*) AS votes FROM d GROUP BY 1, 2)
SELECT l_returnflag, offset_days, votes, votes * 10000 // CAST(sum(votes) OVER (PARTITION BY l_returnflag) AS BIGINT) AS agreement_bp FROM c
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY votes DESC, offset_days) = 1
""")
def q_mode_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return dedupe.mode_with_share(rows.select("l_returnflag", F.datediff("l_shipdate", "o_orderdate").alias("offset_days")), ["l_returnflag"], "offset_days")


@query("""
WITH s AS (SELECT p_name, list(DISTINCT p_brand) FILTER (p_size <= 3) AS cs FROM part GROUP BY p_name),
w AS (SELECT p_name, cs, list_distinct(string_split(lower(p_name), ' ')) AS ws FROM s)
SELECT a.p_name AS name_a, b.p_name AS name_b, len(list_intersect(a.ws, b.ws)) AS shared, least(len(a.ws), len(b.ws)) AS smaller
FROM w a JOIN w b ON a.p_name < b.p_name
WHERE NOT coalesce(list_has_any(a.cs, b.cs), false) AND len(list_intersect(a.ws, b.ws)) > 0
  AND 2 * len(list_intersect(a.ws, b.ws)) >= least(len(a.ws), len(b.ws))
""")
def q_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_name", F.when(F.col("p_size") <= 3, F.col("p_brand")).alias("brand"))
    return dedupe.candidate_pairs(dedupe.contract_sets(parts, "p_name", "brand"), "p_name", "contracts")


@query("SELECT p_name, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM part GROUP BY p_name")
def q_contract_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.contract_sets(table(spark, sf_dir, "part"), "p_name", "p_brand").select("p_name", F.array_join("contracts", ",").alias("brands"))


@query(r"""
WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT upper(split_part(p_name, ' ', 2)) || ', ' || split_part(p_name, ' ', 1) FROM part),
k AS (SELECT name, array_to_string(list_sort(list_filter(string_split_regex(regexp_replace(lower(name), '[^a-z0-9_\s]', ' ', 'g'), '\s+'), lambda w: w <> '')), ' ') AS norm_key FROM n)
SELECT norm_key, arg_min(name, (-length(name), name)) AS canonical, count(*) AS members FROM k GROUP BY norm_key
""")
def q_norm_key_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    words = F.split("name", " ")
    turned = parts.select(F.concat(F.upper(words[1]), F.lit(", "), words[0]).alias("name"))
    return dedupe.merge_by_key(parts.unionByName(turned), "name")


_CASES = [("all", None), ("long", "widget"), ("short", "ot"), ("short hit", "hot"), ("none", "zzzz")]


@query(f"""
WITH c AS (SELECT * FROM (VALUES {_values(_CASES)}) v(case_id, kw)),
h AS (SELECT case_id, p_partkey, CASE WHEN kw IS NULL THEN true WHEN length(kw) <= 3 THEN list_contains(string_split(p_name, ' '), kw) ELSE contains(p_name, kw) END AS hit FROM part, c)
SELECT case_id, p_partkey FROM h WHERE hit OR case_id NOT IN (SELECT case_id FROM h WHERE hit)
""")
def q_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.functions.text import keyword_match

    cases = F.array(*[F.struct(F.lit(i).alias("case_id"), F.lit(k).cast("string").alias("kw")) for i, k in _CASES])
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.inline(cases))
    hits = rows.withColumn("hit", F.coalesce(keyword_match(F.col("p_name"), F.col("kw")), F.lit(True)))
    found = hits.groupBy("case_id").agg(F.max("hit").alias("any_hit"))  # a row a case
    return hits.join(F.broadcast(found), "case_id").filter("hit or not any_hit").select("case_id", "p_partkey")


@query()
def q_name_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.name_clusters(table(spark, sf_dir, "part"), "p_name")


@query("""
WITH RECURSIVE s AS (
  SELECT split_part(p_name, ' ', 1) AS first, p_name, row_number() OVER (PARTITION BY split_part(p_name, ' ', 1) ORDER BY p_name) AS rn, cs
  FROM (SELECT p_name, coalesce(list(DISTINCT p_brand) FILTER (p_size <= 3), []) AS cs FROM part GROUP BY p_name)
), r AS (
  SELECT DISTINCT first, CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[][]) AS taken, CAST(NULL AS VARCHAR) AS p_name, CAST(NULL AS INTEGER) AS subgroup FROM s
  UNION ALL
  SELECT first, rn, CASE WHEN pos = 0 THEN list_append(taken, cs) ELSE list_concat(list_append(taken[1:pos - 1], list_concat(taken[pos], cs)), taken[pos + 1:]) END, p_name,
         CAST(CASE WHEN pos = 0 THEN len(taken) ELSE pos - 1 END AS INTEGER)
  FROM (SELECT r.first, s.rn, r.taken, s.cs, s.p_name, coalesce(list_position(list_transform(r.taken, lambda t: NOT list_has_any(t, s.cs)), true), 0) AS pos
        FROM r JOIN s ON s.first = r.first AND s.rn = r.rn + 1)
)
SELECT first, p_name, subgroup FROM r WHERE rn > 0
""")
def q_cooccurrence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_name", F.when(F.col("p_size") <= 3, F.col("p_brand")).alias("brand"))
    sets = dedupe.contract_sets(parts, "p_name", "brand")
    return dedupe.split_by_cooccurrence(sets.withColumn("first", F.split("p_name", " ")[0]), "first", "p_name", "contracts")


@query("""
WITH w AS (SELECT p_partkey % 4 AS k, p_name, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS n FROM part),
c AS (SELECT DISTINCT k, a, n, upper(a[1]) || a[2:] AS ca, upper(n[1]) || n[2:] AS cn FROM w),
h AS (SELECT a, n, bool_or(k = 1) AS turned, bool_or(k = 2) AS kit FROM c GROUP BY a, n),
m AS (SELECT k, c.a, c.n, turned, kit, CASE k WHEN 0 THEN a || ' ' || n WHEN 1 THEN n || ', ' || a WHEN 2 THEN a || ' ' || n || ' kit' ELSE 'mech. ' || n END AS raw,
             CASE k WHEN 0 THEN ca || ' ' || cn WHEN 1 THEN cn || ', ' || ca WHEN 2 THEN ca || ' ' || cn || ' Kit' ELSE 'Mechanical ' || cn END AS cleaned,
             CASE WHEN k = 0 AND turned THEN cn || ', ' || ca WHEN k = 0 THEN ca || ' ' || cn END AS own
      FROM c JOIN h USING (a, n))
SELECT DISTINCT raw, cleaned, coalesce(own, cleaned) AS merged, CASE WHEN k = 0 AND kit AND NOT turned THEN cleaned || ' Kit' ELSE coalesce(own, cleaned) END AS final FROM m
""")
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they are, turned around, with a word more, and with an abbreviation; no two rows share a contract."""
    words = F.split("p_name", " ")
    key = F.col("p_partkey") % 4
    raw = (
        F.when(key == 0, F.col("p_name")).when(key == 1, F.concat(words[1], F.lit(", "), words[0])).when(key == 2, F.concat("p_name", F.lit(" kit")))
        .otherwise(F.concat(F.lit("mech. "), words[1]))
    )
    return reconcile.reconcile(table(spark, sf_dir, "part").select(raw.alias("name"), F.concat("p_brand", F.lit("-"), "p_partkey").alias("contract")), "name", "contract")
