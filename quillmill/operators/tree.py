"""Ordered content trees: flattening, tables, context."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import pricing_text
from quillmill.session import cut_lineage


def flatten_blocks(spark: SparkSession, docs: DataFrame, id_col: str, json_col: str, max_depth: int = 100) -> DataFrame:
    """id, path (array of positions), depth, under, block_type, heading, text, caption, headers, rows: blocks in preorder by path.

    under is the nearest heading above that is not blank.

    The content is an array of blocks; subsections hold blocks in `content`. Blocks of
    unknown type with a text are paragraphs; blank paragraphs are left out, the children
    of blank headings kept; a block that is bare text is a paragraph. Malformed JSON gives no rows.

    The tree is opened level by level, each level exploded from the checkpoint of the
    one above, until a level is empty; a level has as many tasks as the documents had.
    """
    roots = docs.select(F.col(id_col).alias("id"), F.try_parse_json(F.col(json_col)).alias("v")).filter("v is not null")
    level = spark.sql(
        "SELECT id, array(pos) AS path, CAST(NULL AS STRING) AS under, value AS v FROM {roots}, LATERAL variant_explode_outer(v) WHERE value IS NOT NULL", roots=roots
    )
    levels: list[DataFrame] = []
    for depth in range(max_depth + 1):
        level = cut_lineage(level)
        if levels and level.isEmpty():
            break
        levels.append(level.withColumn("depth", F.lit(depth)))
        heading = F.nullif(F.trim(F.try_variant_get("v", "$.heading", "string")), F.lit(""))
        inner = level.select("id", "path", F.coalesce(heading, "under").alias("under"), F.try_variant_get("v", "$.content", "variant").alias("inside"))
        level = spark.sql(
            "SELECT id, array_append(path, pos) AS path, under, value AS v FROM {inner}, LATERAL variant_explode(inside)", inner=inner.filter("inside is not null")
        )
    rows = reduce(DataFrame.unionByName, levels)
    get = lambda p, t: F.try_variant_get(F.col("v"), p, t)
    kind = get("$.type", "string")
    text = F.coalesce(get("$.text", "string"), F.when(F.schema_of_variant("v") == "STRING", F.try_variant_get("v", "$", "string")))
    block_type = F.when(kind.isin("paragraph", "table", "subsection"), kind).when(F.trim(text) != "", "paragraph")
    out = rows.select(
        F.col("id").alias(id_col), "path", "depth", "under", block_type.alias("block_type"), get("$.heading", "string").alias("heading"),
        text.alias("text"), get("$.caption", "string").alias("caption"), get("$.headers", "array<string>").alias("headers"),
        get("$.rows", "array<array<string>>").alias("rows"),
    )
    blank = (F.col("block_type") == "paragraph") & (F.coalesce(F.trim("text"), F.lit("")) == "")
    return out.filter(F.col("block_type").isNotNull() & ~F.coalesce(blank, F.lit(False)))


def path_key(path: Column) -> Column:
    """A path as text that sorts in preorder: ten digits hold every position."""
    return F.array_join(F.transform(path, lambda p: F.lpad(p.cast("string"), 10, "0")), ".")


def carry_forward(df: DataFrame, group: list[str], order: list[str], value: Column, out: str, include_current: bool = False) -> DataFrame:
    """Adds the last non-null value of the rows before (or of this row too)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def text_of(df: DataFrame, group: list[str], order: list[str], text: Column, separator: str = "\n") -> DataFrame:
    """group, text: non-blank texts in order, joined."""
    rows = df.withColumn("_t", F.trim(text)).filter(F.col("_t") != "")
    return rows.groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_t"))), lambda s: s["_t"]), separator).alias("text")
    )


def inherit_headers(df: DataFrame, group: list[str], order: list[str], headers: str, width: str) -> DataFrame:
    """A table without headers takes those of the last table that had some, if their widths differ by at most one."""
    filled = carry_forward(df, group, order, F.when(F.size(headers) > 0, F.col(headers)), "_before")
    fits = F.abs(F.size("_before") - F.col(width)) <= 1
    return filled.withColumn(headers, F.when(F.size(headers) > 0, F.col(headers)).when(fits, F.col("_before")).otherwise(F.col(headers))).drop("_before")


def absorb_continuations(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """group, head order, headers, caption, rows: tables without headers and caption are appended to the one before.

    df: headers, caption, rows (array of arrays of text). The widths must agree within one, or be unknown.
    """
    width = F.greatest(F.size("headers"), F.size(F.get("rows", F.lit(0))))
    w = Window.partitionBy(*group).orderBy(*order)
    known = df.withColumn("_width", width)
    opens = (
        (F.size("headers") > 0) | (F.coalesce(F.trim("caption"), F.lit("")) != "") | F.lag("_width").over(w).isNull()
        | ((F.col("_width") > 0) & (F.lag("_width").over(w) > 0) & (F.abs(F.col("_width") - F.lag("_width").over(w)) > 1))
    )
    numbered = known.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int")).withColumn(
        "_table", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    piece = F.struct(*order, "headers", "caption", "rows")
    return (
        numbered.groupBy(*group, "_table")
        .agg(F.array_sort(F.collect_list(piece)).alias("_p"))
        .select(
            *group, "_table", F.col("_p")[0]["headers"].alias("headers"), F.col("_p")[0]["caption"].alias("caption"),
            F.flatten(F.transform("_p", lambda p: p["rows"])).alias("rows"),
        )
    )


def _number(cell: Column) -> Column:
    return F.trim(cell).rlike(r"^[$€£]?\s*[\d,]+\.?\d*$")


def is_header_row(row: Column) -> Column:
    """At least 60 % of the row's filled cells are no numbers; false for a row without any."""
    filled = F.filter(row, lambda c: F.coalesce(F.trim(c), F.lit("")) != "")
    text = F.size(F.filter(filled, lambda c: ~_number(c)))
    return F.coalesce((F.size(filled) > 0) & (text * 10 >= F.size(filled) * 6), F.lit(False))


def common_width(rows: Column) -> Column:
    """The commonest number of cells of a row; of equally common ones the widest."""
    widths = F.transform(rows, F.size)
    counted = F.transform(F.array_distinct(widths), lambda x: F.struct(F.size(F.filter(widths, lambda y: y == x)).alias("n"), x.alias("width")))
    return F.array_max(counted)["width"]


def repair_headers(df: DataFrame) -> DataFrame:
    """headers, caption, rows: a first row that reads as headers takes their place.

    It does where headers are narrower than the commonest row and the first row has that
    width; where the headers are one cell above a row of several; and where there are
    none and the second row holds a number. What stood in the headers goes to the end of
    the caption, unless the caption says it already.
    """
    first, second = F.get("rows", F.lit(0)), F.get("rows", F.lit(1))
    width, filled = F.size("headers"), F.exists("headers", lambda h: F.coalesce(F.trim(h), F.lit("")) != "")
    none = ~F.coalesce(filled, F.lit(False))
    narrow = (width > 0) & (width < F.col("_width"))
    # a narrow header is case one alone, so a lone cell counts for itself only where it is as wide as the rows
    takes = (
        F.when(narrow, F.size(first) == F.col("_width"))
        .when((width == 1) & ~none, F.size(first) >= 2)
        .when(none, (F.size(first) >= 2) & F.coalesce(F.exists(second, _number), F.lit(False)))
        .otherwise(F.lit(False))
    )
    title = F.when(narrow, F.array_join("headers", " | ", "")).when(width == 1, F.trim(F.get("headers", F.lit(0)))).otherwise("")
    caption = F.coalesce(F.trim("caption"), F.lit(""))
    joined = F.when((title == "") | F.contains(caption, title), F.col("caption")).when(caption == "", title).otherwise(F.concat(caption, F.lit(" - "), title))
    checked = df.withColumn("_width", common_width(F.col("rows"))).withColumn("_takes", F.coalesce(takes & is_header_row(first), F.lit(False)))
    return checked.withColumns(
        {
            "caption": F.when(F.col("_takes"), joined).otherwise(F.col("caption")),
            "headers": F.when(F.col("_takes"), F.transform(first, lambda c: F.trim(F.coalesce(c, F.lit(""))))).otherwise(F.col("headers")),
            "rows": F.when(F.col("_takes"), F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))).otherwise(F.col("rows")),
        }
    ).drop("_width", "_takes")


def is_label_table(rows: Column) -> Column:
    """Two rows or more, or over 30 % of them, begin with a known label before another cell."""
    labelled = F.filter(rows, lambda r: (F.size(r) >= 2) & pricing_text.label_field(F.rtrim(F.regexp_replace(F.trim(r[0]), ":+$", ""))).isNotNull())
    n = F.size(labelled)
    return F.coalesce((F.size(rows) > 0) & ((n >= 2) | (n * 10 > F.size(rows) * 3)), F.lit(False))


def is_pricing_table(caption: Column, headers: Column, section: Column, rows: Column) -> Column:
    """A pricing word in caption, headers or section; or a number in the first five rows and the word in the section."""
    from quillmill.functions.text import contains_any

    named = contains_any(F.concat_ws(" ", caption, F.array_join(headers, " ")), pricing_text.PRICING_KEYWORDS)
    number = F.exists(F.slice(rows, 1, 5), lambda r: F.exists(r, lambda c: c.rlike(r"\d")))
    return named | (number & contains_any(section, pricing_text.PRICING_KEYWORDS))


def label_pairs(df: DataFrame, ids: list[str], rows: str = "rows", headers: str | None = None) -> DataFrame:
    """ids, field, value: labelled values of key-value tables; the first of each field.

    A label stands in a cell before its value, or in one cell with it behind a colon, or
    is the header of the column in a table of three rows at most; headers come last.
    """
    flat = df.select(*ids, F.posexplode(rows).alias("r", "row")).select(*ids, "r", "row", F.posexplode("row").alias("c", "cell"))
    beside = F.get("row", F.col("c") + 1)
    inline = F.regexp_extract("cell", r"^\s*([^:]+):\s*(\S.*)$", 2)
    label = F.when(inline != "", F.regexp_extract("cell", r"^\s*([^:]+):", 1)).otherwise(F.col("cell"))
    found = flat.select(*ids, F.lit(0).alias("way"), "r", "c", pricing_text.label_field(label).alias("field"), F.trim(F.when(inline != "", inline).otherwise(beside)).alias("value"))
    if headers is not None:
        short = df.filter(F.size(rows) <= 3).select(*ids, F.col(headers).alias("_heads"), F.posexplode(rows).alias("r", "row"))
        under = short.select(*ids, "r", "row", F.posexplode("_heads").alias("c", "head"))
        bare = F.rtrim(F.regexp_replace(F.trim("head"), ":+$", ""))
        found = found.unionByName(
            under.select(*ids, F.lit(1).alias("way"), "r", "c", pricing_text.label_field(bare).alias("field"), F.trim(F.get("row", F.col("c"))).alias("value"))
        )
    w = Window.partitionBy(*ids, "field").orderBy("way", "r", "c")
    return found.filter("field is not null and value <> ''").withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*ids, "field", "value")


#: Keys of a document that are no sections.
NO_SECTION_KEYS = ("document_id", "document_header")


def sections_of(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """id, ord, section_type, section_name, section (JSON text) of flat ({sections: [..]}) and bucketed (type -> [..] or {..}) documents.

    A document with a filled list `sections` is flat. The name is what the section says
    (heading, section_name, section, caption), else its type in title case. Bucketed
    sections that the document's header lists come in its order, before the others.
    from_json on the root keeps the order of its keys.
    """
    get = lambda name: F.nullif(F.trim(F.get_json_object("section", f"$.{name}")), F.lit(""))
    listed = F.from_json(F.get_json_object(json_col, "$.sections"), "array<string>")
    rows = df.select(id_col, F.col(json_col).alias("_js"), listed.alias("_listed"))
    flat = rows.filter(F.size("_listed") > 0).select(id_col, F.posexplode("_listed").alias("pos", "section")).select(
        id_col, F.lit(0).alias("place"), F.lit(0).alias("bucket"), "pos", "section",
        F.coalesce(F.get_json_object("section", "$.section_type"), F.lit("section")).alias("section_type"),
        F.coalesce(F.get_json_object("section", "$.section_name"), F.get_json_object("section", "$.heading"), F.lit("Unknown")).alias("section_name"),
    )
    entries = F.filter(
        F.map_entries(F.from_json("_js", "map<string,string>")),
        lambda e: ~e["key"].isin(*NO_SECTION_KEYS, "tables") & (e["value"].startswith("[") | (e["value"].startswith("{") & (e["value"] != "{}"))),
    )
    order = F.from_json(F.get_json_object("_js", "$.document_header.sections"), "array<string>")
    old = rows.filter(F.coalesce(F.size("_listed"), F.lit(0)) <= 0).select(id_col, order.alias("_order"), F.posexplode(entries).alias("bucket", "e"))
    parts = F.when(F.col("e.value").startswith("["), F.from_json("e.value", "array<string>")).otherwise(F.array("e.value"))
    typed = old.select(id_col, "_order", "bucket", F.col("e.key").alias("section_type"), F.posexplode(parts).alias("pos", "section"))
    named = typed.withColumn(
        "section_name", F.coalesce(*[get(n) for n in ("heading", "section_name", "section", "caption")], F.initcap(F.replace("section_type", F.lit("_"), F.lit(" "))))
    )
    at = F.array_position("_order", F.col("section_name"))
    bucketed = named.withColumn("place", F.when(at > 0, at).otherwise(F.lit(9999)).cast("int"))
    w = Window.partitionBy(id_col).orderBy("place", "bucket", "pos")
    every = flat.unionByName(bucketed.select(flat.columns))
    return every.select(id_col, F.row_number().over(w).alias("ord"), "section_type", "section_name", "section")
