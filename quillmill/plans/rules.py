"""Rule-based defaults in the place of the model-backed operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.functions.pricing_text import label_field
from quillmill.operators.dedupe import prefix_pairs
from quillmill.session import cut_lineage


def classify_document(body: Column, types: dict[str, tuple[str, ...]], default: str) -> Column:
    """The first type one of whose keywords the text contains."""
    out = None
    for name, keywords in types.items():
        hit = text.contains_any(body, keywords)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(default)


def headings(pages: DataFrame, document: str = "document_id", page: str = "page_number", body: str = "text") -> DataFrame:
    """document, page, section_name: numbered or upper-case lines of at most 80 characters that begin a section."""
    lines = pages.select(document, page, F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    line = F.trim("line")
    is_heading = line.rlike(r"^\d{1,2}(\.\d{1,2})*\.?\s+\p{Lu}") | (line.rlike(r"\p{Lu}{3}") & (line == F.upper(line)))
    return lines.filter(is_heading & F.length(line).between(4, 80)).select(document, page, "line_no", line.alias("section_name"))


def toc_entries(pages: DataFrame, document: str = "document_id", body: str = "text") -> DataFrame:
    """document, title, printed_page: lines of a table of contents (dot leaders)."""
    lines = pages.select(document, F.explode(F.split(body, "\n")).alias("line"))
    pattern = r"^\s*(.+?)\s*\.{3,}\s*(\d{1,4})\s*$"
    return lines.filter(F.col("line").rlike(pattern)).select(
        document, F.regexp_extract("line", pattern, 1).alias("title"), F.regexp_extract("line", pattern, 2).cast("int").alias("printed_page")
    )


def section_ends(found: DataFrame, total: Column, document: str = "document_id", page: str = "page_number", order: str = "line_no") -> DataFrame:
    """found with start_page, end_page: a section ends on the page before the next heading's, or on it if both share one."""
    w = Window.partitionBy(document).orderBy(page, order)
    following = F.lead(page).over(w)
    end = F.when(following.isNotNull(), F.greatest(following - 1, F.col(page))).otherwise(total)
    return found.withColumn("end_page", end).withColumnRenamed(page, "start_page")


def interrupted(page_text: Column, next_text: Column) -> Column:
    """Whether a section goes on behind a page that interrupts it: off without a model."""
    return F.lit(False)


def page_header(pages: DataFrame, document: str = "document_id", page: str = "page_number", body: str = "text") -> DataFrame:
    """document, field, value: `Label: value` lines of the first page, the first of each known label."""
    first = pages.filter(F.col(page) == 1).select(document, F.posexplode(F.split(body, "\n")).alias("r", "line"))
    pair = first.select(document, "r", label_field(F.regexp_extract("line", r"^\s*([^:]+):", 1)).alias("field"), F.trim(F.regexp_extract("line", r"^\s*[^:]+:\s*(.*)$", 1)).alias("value"))
    w = Window.partitionBy(document, "field").orderBy("r")
    return pair.filter("field is not null and value <> ''").withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(document, "field", "value")


def paragraphs(pages: DataFrame, document: str = "document_id", page: str = "page_number", body: str = "text") -> DataFrame:
    """document, page, pos, text: the lines of pages as paragraphs, ` -- ` written as ` - `; blank ones left out."""
    lines = pages.select(document, page, F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    return lines.select(document, page, "pos", F.replace(F.trim("line"), F.lit(" -- "), F.lit(" - ")).alias("text")).filter("text <> ''")


def review_value(source: Column, made: Column) -> Column:
    """correct if a mapped value says what its source says, as text or as a number; missing if it is blank; else incorrect."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    number = lambda c: F.regexp_replace(c, r"[$,\s]", "").try_cast("double")
    same = (F.lower(F.trim(source)) == F.lower(F.trim(made))) | F.coalesce(number(source) == number(made), F.lit(False))
    return F.when(blank(source) & blank(made), "correct").when(blank(made), "missing").when(same, "correct").otherwise("incorrect")


def match_terms(sections: DataFrame, terms: DataFrame, least: float = 0.5) -> DataFrame:
    """term, section_id, score: the share of a term's words that a section has. Found through the words, not by pairs."""
    words = terms.select("term", text.token_set(F.col("term")).alias("ws")).select("term", F.size("ws").alias("n"), F.explode("ws").alias("word"))
    said = sections.select("section_id", F.explode(text.token_set(F.regexp_replace("text", r"[^\w\s]", " "))).alias("word"))
    found = said.join(words, "word").groupBy("term", "section_id").agg((F.count(F.lit(1)) / F.first("n")).alias("score"))
    return found.filter(F.col("score") >= least)


def page_recall(pages: DataFrame, extracted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, coverage_pct, total_elements_on_page, elements_missed: distinct page words that the extracted text has."""
    bag = lambda df: df.select(*keys, F.explode(F.array_distinct(F.split(text.search_normalise(F.col("text")), " "))).alias("word")).filter("word <> ''")
    both = bag(pages).join(bag(extracted).withColumn("found", F.lit(1)), [*keys, "word"], "left")
    out = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_elements_on_page"), F.count_if(F.col("found").isNull()).alias("elements_missed"))
    share = 100.0 * (F.col("total_elements_on_page") - F.col("elements_missed")) / F.col("total_elements_on_page")
    return out.withColumn("coverage_pct", F.round(share, 2))


def verify_statement(statement: Column, page_text: Column) -> Column:
    """CORRECT if the pages contain the statement, MISSING if not, UNVERIFIABLE without pages."""
    found = F.contains(text.search_normalise(page_text), text.search_normalise(statement))
    return F.when(F.coalesce(F.trim(page_text), F.lit("")) == "", "UNVERIFIABLE").when(found, "CORRECT").otherwise("MISSING")


def match_descriptions(values: DataFrame, references: DataFrame, least: float = 0.75) -> DataFrame:
    """value, matched, confidence: the reference with the largest Jaccard similarity of words, if it is at least `least`.

    At similarity t two sets of n and m words share one of the rarest n - ceil(t * n) + 1
    words of the one and of the rarest m - ceil(t * m) + 1 of the other; only those meet.
    """
    bag = lambda df, c: cut_lineage(df.select(F.col(c).alias("name"), text.token_set(F.regexp_replace(c, r"[^\w\s]", " ")).alias("words")).filter("size(words) > 0").distinct())
    prefix = lambda n: n - F.ceil(n * least) + 1
    met = prefix_pairs(bag(values, "value"), bag(references, "reference"), prefix, prefix)
    shared = F.size(F.array_intersect("words_a", "words_b"))
    scored = met.select(
        F.col("name_a").alias("value"), F.col("name_b").alias("matched"), (shared / (F.size("words_a") + F.size("words_b") - shared)).alias("confidence")
    ).filter(F.col("confidence") >= least)
    return scored.groupBy("value").agg(
        F.min_by("matched", F.struct((-F.col("confidence")).alias("c"), "matched")).alias("matched"), F.max("confidence").alias("confidence")
    )
