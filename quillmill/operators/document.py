"""Documents as wholes: headers, tables in all layouts, context, page resolution, assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import search_normalise
from quillmill.session import maybe_broadcast

#: Keys of a header that are no fields.
NO_HEADER_KEYS = ("sections", "tables", "failed_tables", "detection_summary")
#: Ranks of a model's confidence words.
CONFIDENCE_RANK = {"high": 0, "medium": 1, "low": 2}


def header_fields(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """id, field, value: all `*_header` objects merged, the first of a field wins; {"text": ..} is unwrapped.

    from_json on the root keeps the order of its keys.
    """
    entries = F.filter(F.map_entries(F.from_json(json_col, "map<string,string>")), lambda e: e["key"].endswith("_header") & e["value"].startswith("{"))
    flat = df.select(id_col, F.posexplode(entries).alias("i", "e")).select(
        id_col, "i", F.posexplode(F.map_entries(F.from_json("e.value", "map<string,string>"))).alias("j", "f")
    )
    flat = flat.filter(~F.col("f.key").isin(*NO_HEADER_KEYS))
    value = F.coalesce(F.get_json_object("f.value", "$.text"), F.col("f.value"))
    w = Window.partitionBy(id_col, "f.key").orderBy("i", "j")
    return flat.withColumn("n", F.row_number().over(w)).filter("n = 1").select(id_col, F.col("f.key").alias("field"), value.alias("value"))


def discover_tables(sections: DataFrame, id_col: str, ord_col: str, json_col: str) -> DataFrame:
    """id, ord, layout, pos, tbl (JSON): tables of a section's `tables` (A) and of its typed blocks, `content` (B) or,
    where that is empty, `data.content` (C); nested ones come from the flattened tree."""
    listed = lambda path: F.from_json(F.get_json_object(json_col, path), "array<string>")
    blocks = F.when(F.coalesce(F.size(listed("$.content")), F.lit(0)) > 0, listed("$.content")).otherwise(listed("$.data.content"))
    layout = F.when(F.coalesce(F.size(listed("$.content")), F.lit(0)) > 0, "B").otherwise("C")
    own = sections.select(id_col, ord_col, F.lit("A").alias("layout"), F.posexplode(listed("$.tables")).alias("pos", "tbl"))
    typed = sections.select(id_col, ord_col, layout.alias("layout"), F.posexplode(blocks).alias("pos", "tbl"))
    return own.unionAll(typed.filter(F.get_json_object("tbl", "$.type") == "table"))


def bucketed_tables(documents: DataFrame, found: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """The tables of bucketed documents (D), for those of which nothing was found in another layout."""
    from quillmill.operators.tree import sections_of

    missing = documents.join(found.select(id_col).distinct(), id_col, "left_anti")
    parts = sections_of(missing.select(id_col, json_col), id_col, json_col)
    return discover_tables(parts, id_col, "ord", "section").withColumn("layout", F.lit("D"))


def context_around(blocks: DataFrame, group: list[str], order: str, before: int = 10, after: int = 6) -> DataFrame:
    """Adds context_before (the last paragraphs before a block) and context_after (paragraphs among the blocks
    behind it, up to the next subsection).

    A paragraph gathers itself and the ones before it, at most `before`; a block takes what
    the last paragraph before it gathered, so no row holds more than that.
    """
    is_paragraph = F.coalesce(F.col("block_type") == "paragraph", F.lit(False))
    w = Window.partitionBy(*group).orderBy(order)
    alike = Window.partitionBy(*group, "_paragraph").orderBy(order).rowsBetween(-(before - 1), 0)
    gathered = blocks.withColumn("_paragraph", is_paragraph).withColumn("_own", F.when(F.col("_paragraph"), F.collect_list("text").over(alike)))
    past = F.last("_own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.collect_list(F.struct(F.coalesce("block_type", F.lit("")).alias("k"), F.coalesce("text", F.lit("")).alias("t"))).over(w.rowsBetween(1, after))
    out = gathered.withColumn("_past", past).withColumn("_next", behind)
    stop = F.array_position(F.transform("_next", lambda x: x["k"] == "subsection"), True)
    upto = F.when(stop > 0, F.slice("_next", F.lit(1), F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(F.col("_next"))
    return out.withColumns(
        {
            "context_before": F.array_join(F.coalesce("_past", F.array().cast("array<string>")), "\n"),
            "context_after": F.array_join(F.transform(F.filter(upto, lambda x: x["k"] == "paragraph"), lambda x: x["t"]), "\n"),
        }
    ).drop("_past", "_next", "_own", "_paragraph")


def heading_pages(entries: DataFrame, pages: DataFrame, reach: int = 40, first: int = 5) -> DataFrame:
    """document_id, title, printed_page, page: the page nearest to where a title should stand that says it.

    entries: document_id, ord, title, printed_page; the first ones of a document are
    looked for. pages: document_id, page_number, text, is_toc. A title should stand
    printed_page pages behind the table of contents, within the document; pages less than
    `reach` away are searched, those behind before those in front.
    """
    nth = F.row_number().over(Window.partitionBy("document_id").orderBy("ord"))
    asked = (
        entries.withColumn("_n", nth).filter(F.col("_n") <= first).drop("_n")
        .withColumn("_title", search_normalise(F.col("title")))
        .filter((F.length("_title") >= 3) & F.col("printed_page").isNotNull())
    )
    spans = pages.groupBy("document_id").agg(F.coalesce(F.max(F.when(F.col("is_toc"), F.col("page_number"))), F.lit(0)).alias("_toc"), F.max("page_number").alias("_total"))
    anchored = asked.join(spans, "document_id").withColumn("_anchor", F.greatest(F.lit(1), F.least(F.col("_toc") + F.col("printed_page"), F.col("_total"))))
    said = pages.filter("not is_toc").select("document_id", "page_number", search_normalise(F.col("text")).alias("_body"))
    # at most `first` titles of a document meet its pages
    found = said.join(maybe_broadcast(anchored), "document_id").filter(
        (F.abs(F.col("page_number") - F.col("_anchor")) < reach) & F.contains("_body", F.col("_title"))
    )
    distance = F.abs(F.col("page_number") - F.col("_anchor")) * 2 + (F.col("page_number") < F.col("_anchor")).cast("int")
    return found.groupBy("document_id", "title", "printed_page").agg(F.min_by("page_number", distance).alias("page"))


def context_pages(listed: Column, total: Column, around: int = 1) -> Column:
    """The pages from `around` before the first to `around` after the last, within the document."""
    low, high = F.greatest(F.array_min(listed) - around, F.lit(1)), F.least(F.array_max(listed) + around, total)
    return F.when((F.size(listed) > 0) & (low <= high), F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))


def best_candidate(df: DataFrame, group: list[str], confidence: str, order: str) -> DataFrame:
    """The candidate of the best confidence word, the first of equals."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for p in CONFIDENCE_RANK.items() for x in p])[F.lower(confidence)], F.lit(9))
    w = Window.partitionBy(*group).orderBy(rank, order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def sample_rows(df: DataFrame, group: list[str], order: str, cells: str, n: int = 5, longest: int = 120) -> DataFrame:
    """The first n rows of each table, cells cut with an ellipsis: what a prompt shows."""
    cut = F.transform(cells, lambda c: F.when(F.length(c) > longest, F.concat(F.substring(c, 1, longest), F.lit("..."))).otherwise(c))
    w = Window.partitionBy(*group).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).filter(f"_r <= {n}").drop("_r").withColumn(cells, cut)


def sample_table(headers: Column, rows: Column, widest: int = 40, n: int = 5) -> Column:
    """The first rows of a table as text with aligned columns, cells cut to `widest` characters."""
    cell = lambda r, i: F.coalesce(F.get(r, i), F.lit(""))
    short = lambda c: F.when(F.length(c) > widest, F.concat(F.substring(c, 1, widest - 3), F.lit("..."))).otherwise(c)
    some = F.slice(rows, 1, n)
    widths = F.transform(
        headers, lambda h, i: F.least(F.lit(widest), F.aggregate(some, F.length(h), lambda most, r: F.greatest(most, F.length(short(cell(r, i))))))
    )
    padded = lambda c, w: F.when(F.length(c) >= w, c).otherwise(F.rpad(c, w, F.lit(" ")))

    def drawn(t: Column) -> Column:
        line = lambda cells: F.concat(F.lit("  "), F.array_join(F.zip_with(cells, t["widths"], padded), " | "))
        rule = F.concat(F.lit("  "), F.array_join(F.transform(t["widths"], lambda w: F.repeat(F.lit("-"), w)), "-+-"))
        body = F.transform(t["rows"], lambda r: line(F.transform(t["headers"], lambda h, i: short(cell(r, i)))))
        return F.array_join(F.concat(F.array(line(t["headers"]), rule), body), "\n")

    made = F.transform(F.array(F.struct(headers.alias("headers"), some.alias("rows"), widths.alias("widths"))), drawn)[0]
    return F.when((F.size(headers) > 0) & (F.size(rows) > 0), made).otherwise("(no sample data available)")


def combine(sections: DataFrame, headers: DataFrame) -> DataFrame:
    """document_id, header (map), section_names, sections (array in page order): one row a document.

    sections: document_id, start_page, section_name, section_type, heading, content. An empty heading is the section's name.
    """
    heading = F.coalesce(F.nullif(F.trim("heading"), F.lit("")), "section_name")
    one = F.struct(F.coalesce("start_page", F.lit(0)).alias("start_page"), "section_name", "section_type", heading.alias("heading"), "content")
    body = sections.groupBy("document_id").agg(F.array_sort(F.collect_list(one)).alias("sections"))
    head = headers.groupBy("document_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("header"))
    names = F.array_distinct(F.transform("sections", lambda s: s["section_name"]))
    return body.join(head, "document_id", "left").select("document_id", "header", names.alias("section_names"), "sections")
