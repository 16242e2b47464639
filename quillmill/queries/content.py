"""Content trees, text and JSON over documents, conversations and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.operators import intervals, quality, tree
from quillmill.plans.provider import reply_items
from quillmill.queries.registry import query, table


@query("SELECT conv_id, turn, coalesce(lead(role) OVER (PARTITION BY conv_id ORDER BY turn), 'END') AS next_role FROM conversations")
def q_next_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.next_value(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role", "next_role")
    return rows.select("conv_id", "turn", "next_role")


_TURNS = "(SELECT conv_id, turn, turn * 3 AS start_page, CASE WHEN turn % 2 = 1 THEN turn * 3 + 4 END AS end_page FROM conversations)"


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", (turn * 3).alias("start_page"), F.when(turn % 2 == 1, turn * 3 + 4).alias("end_page")
    )


@query(f"""
SELECT conv_id, turn, start_page, coalesce(end_page, lead(start_page) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 30) AS end_page FROM {_TURNS}
""")
def q_end_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.resolve_end(_sections(spark, sf_dir), ["conv_id"], ["turn"], "start_page", "end_page", F.lit(30).cast("long"))


@query(f"""
SELECT conv_id, page, count(*) AS sections FROM (
  SELECT conv_id, unnest(generate_series(start_page, end_page)) AS page FROM (
    SELECT conv_id, start_page, coalesce(end_page, lead(start_page) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 30) AS end_page FROM {_TURNS}))
GROUP BY conv_id, page
""")
def q_section_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.to_pages(q_end_page(spark, sf_dir), "start_page", "end_page").groupBy("conv_id", "page").agg(F.count(F.lit(1)).alias("sections"))


@query(r"""
SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (
  SELECT doc_id, trim(regexp_replace(replace(replace(replace(chr(8203) || 'A' || chr(160) || chr(8211) || ' ' || text || chr(8221), chr(8203), ''), chr(8211), '-'), chr(8221), '"'), '[\s\x{00a0}]+', ' ', 'g')) AS t FROM documents)
""")
def q_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = F.concat(F.lit("​A –"), F.lit(" "), F.col("text"), F.lit("”"))
    clean = table(spark, sf_dir, "documents").select("doc_id", text.sanitise(planted).alias("t"))
    return clean.select("doc_id", F.length("t").alias("n"), F.md5("t").alias("digest"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^\p{L}\p{N}_\p{M}]+', ' ', 'g'))) AS digest FROM documents")
def q_search_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.search_normalise(F.col("text"))).alias("digest"))


@query("""
WITH l AS (SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
h AS (SELECT *, max(CAST(contains(line, ' the ') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near FROM l)
SELECT doc_id, pos FROM h WHERE near = 1
""")
def q_context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return intervals.context_window(lines, ["doc_id"], "pos", F.col("line").contains(" the "), before=1, after=2).select("doc_id", "pos")


@query("SELECT conv_id, md5(string_agg(trim(text), chr(10) ORDER BY turn)) AS digest FROM conversations WHERE trim(text) <> '' GROUP BY conv_id")
def q_section_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = tree.text_of(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("text"))
    return joined.select("conv_id", F.md5("text").alias("digest"))


def _conversation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    block = lambda t: F.struct(
        F.lit("subsection").alias("type"), t["role"].alias("heading"),
        F.array(F.struct(F.lit("paragraph").alias("type"), t["text"].alias("text"))).alias("content"),
    )
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.transform(turns, block)).alias("js"))


@query("""
WITH r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations)
SELECT conv_id, lpad(CAST(p AS VARCHAR), 10, '0') AS path, 0 AS depth, 'subsection' AS block_type, role AS content FROM r
UNION ALL SELECT conv_id, lpad(CAST(p AS VARCHAR), 10, '0') || '.0000000000', 1, 'paragraph', md5(text) FROM r WHERE trim(text) <> ''
""")
def q_flatten_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = tree.flatten_blocks(spark, _conversation_json(spark, sf_dir), "conv_id", "js")
    return flat.select("conv_id", tree.path_key(F.col("path")).alias("path"), "depth", "block_type", F.coalesce("heading", F.md5("text")).alias("content"))


@query("""
WITH d AS (SELECT doc_id, coalesce(trim(text), '') AS t, lang, source FROM documents), z AS (SELECT '0000000000' AS z, '0000000001' AS o, '0000000002' AS w)
SELECT doc_id, z AS path, 0 AS depth, 'subsection' AS block_type, NULL AS under, source AS content FROM d, z
UNION ALL SELECT doc_id, z || '.' || z, 1, 'subsection', source, '' FROM d, z
UNION ALL SELECT doc_id, z || '.' || z || '.' || z, 2, 'subsection', source, lang FROM d, z
UNION ALL SELECT doc_id, z || '.' || z || '.' || z || '.' || z, 3, 'paragraph', coalesce(lang, source), md5(t) FROM d, z WHERE t <> ''
UNION ALL SELECT doc_id, z || '.' || z || '.' || z || '.' || o, 3, 'table', coalesce(lang, source), 'Rates' FROM d, z
UNION ALL SELECT doc_id, z || '.' || z || '.' || o, 2, 'paragraph', source, md5('odd') FROM d, z
UNION ALL SELECT doc_id, o, 0, 'paragraph', NULL, md5('bare') FROM d, z
""")
def q_flatten_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a tree of four levels: a blank heading, a block of unknown type, a table, a bare text, a blank paragraph."""
    text = F.coalesce(F.trim("text"), F.lit(""))
    of = lambda kind, **fields: F.struct(F.lit(kind).alias("type"), *[c.alias(n) for n, c in fields.items()])
    rates = of("table", caption=F.lit("Rates"), headers=F.array(F.lit("A"), F.lit("B")), rows=F.array(F.array(F.col("source"), F.lit(None).cast("string"))))
    js = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    nest = lambda heading, *blocks: F.concat(F.lit('{"type":"subsection","heading":'), js(F.struct(heading.alias("h"))).substr(F.lit(6), F.lit(10**6)).substr(F.lit(1), F.length(js(F.struct(heading.alias("h")))) - 6), F.lit(',"content":['), F.concat_ws(",", *blocks), F.lit("]}"))
    third = nest(F.col("lang"), js(of("paragraph", text=text)), js(rates))
    second = nest(F.lit(""), third, F.lit('{"type":"note","text":"odd"}'))
    first = nest(F.col("source"), second)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("["), first, F.lit(',"bare",{"type":"paragraph","text":" "}]')).alias("js"))
    flat = tree.flatten_blocks(spark, docs, "doc_id", "js")
    said = F.when(F.col("block_type") == "paragraph", F.md5("text")).when(F.col("block_type") == "table", F.col("caption")).otherwise(F.col("heading"))
    return flat.select("doc_id", tree.path_key(F.col("path")).alias("path"), "depth", "block_type", "under", said.alias("content"))


@query("""
SELECT event_id, 0 AS nth, CASE WHEN json_extract_string(props, '$.k') = '0' THEN '' ELSE json_extract_string(props, '$.k') END AS k, event_type AS type FROM events WHERE event_id % 13 <> 0
UNION ALL SELECT event_id, 1, '', '' FROM events WHERE event_id % 13 <> 0
""")
def q_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of two objects and a text each, every thirteenth of them cut off."""
    named = F.regexp_replace("props", r"\}$", "")
    reply = F.concat(F.lit("["), named, F.lit(', "type": " '), "event_type", F.lit(' ", "other": 1}, "x", {"k": null, "type": "N/A"}]'))
    cut = F.when(F.col("event_id") % 13 == 0, F.lit('[{"k": ')).otherwise(reply)
    items = table(spark, sf_dir, "events").select("event_id", F.posexplode(reply_items(cut, ("k", "type"))).alias("nth", "item"))
    return items.select("event_id", "nth", F.col("item")["k"].alias("k"), F.col("item")["type"].alias("type"))


@query("""
SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctx_turn
FROM conversations
""")
def q_trailing_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("role") == "user", F.col("turn"))
    return tree.carry_forward(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], user, "ctx_turn", include_current=True).select("conv_id", "turn", "ctx_turn")


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM documents),
t AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS term FROM part UNION SELECT DISTINCT lower(o_orderstatus) FROM orders UNION SELECT 'the' UNION SELECT 'of')
SELECT term FROM t WHERE term NOT IN (SELECT w FROM w WHERE w IS NOT NULL)
""")
def q_unmatched_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([("the",), ("of",)], "term string")
    terms = table(spark, sf_dir, "part").select(F.split("p_name", " ")[1].alias("term")).unionByName(
        table(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("term"))
    ).unionByName(planted).distinct()
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("term"))
    return quality.unmatched(terms, words, "term")
