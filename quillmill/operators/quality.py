"""Extraction quality: coverage, accuracy, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import verdict

#: Thresholds of the review flag.
AVERAGE_CONFIDENCE, LEAST_CONFIDENCE = 0.85, 0.70


def grade(average: Column, errors: Column) -> Column:
    return (
        F.when((average >= 95) & (errors == 0), "A").when(average >= 85, "B").when(average >= 70, "C").when(average >= 50, "D").otherwise("F")
    )


def coverage_statistics(df: DataFrame, group: list[str], coverage: str, errors: Column) -> DataFrame:
    """group, n, average, median_x2, perfect, high, low, none, errors, grade.

    The median is doubled, so that it is whole for whole coverages; low is above 0 and
    below 50. Empty groups do not appear; see with_empty().
    """
    c = F.col(coverage)
    count = lambda cond: F.count_if(cond)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(c).alias("average"),
        (F.median(c) * 2).cast("long").alias("median_x2"),
        count(c >= 99).alias("perfect"),
        count((c >= 80) & (c < 99)).alias("high"),
        count((c > 0) & (c < 50)).alias("low"),
        count(c == 0).alias("none"),
        F.sum(errors.cast("long")).alias("errors"),
    ).withColumn("grade", grade(F.col("average"), F.col("errors")))


def with_empty(documents: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Every document; those without statistics get zeros and grade F."""
    out = documents.select(key).distinct().join(stats, key, "left")
    fill = {c: 0 for c, t in stats.dtypes if c != key and t not in ("string",)}
    return out.fillna(fill).fillna({"grade": "F"} if "grade" in stats.columns else {})


def accuracy(df: DataFrame, group: list[str], verdict_col: str) -> DataFrame:
    """group, total, correct, incorrect, missing, verifiable, accuracy_bp (of the verifiable; 0 without any)."""
    v = verdict(F.col(verdict_col))
    counted = df.withColumn("_v", v).groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_v") == "CORRECT").alias("correct"),
        F.count_if(F.col("_v") == "INCORRECT").alias("incorrect"),
        F.count_if(F.col("_v") == "MISSING").alias("missing"),
    )
    verifiable = F.col("correct") + F.col("incorrect") + F.col("missing")
    share = F.when(verifiable > 0, F.expr("(correct * 10000) div (correct + incorrect + missing)")).otherwise(F.lit(0))
    return counted.withColumn("verifiable", verifiable).withColumn("accuracy_bp", share.cast("long"))


def worst_rows(df: DataFrame, group: list[str], coverage: str, tie: str, n: int = 10) -> DataFrame:
    """The n rows of least coverage in each group, less those at 100."""
    w = Window.partitionBy(*group).orderBy(coverage, tie)
    return df.withColumn("_r", F.row_number().over(w)).filter(f"_r <= {n}").filter(F.col(coverage) < 100).drop("_r")


def review_flag(df: DataFrame, group: list[str], confidence: str) -> DataFrame:
    """group, needs_review: the average or the least confidence is too low; a missing one counts 0.5."""
    c = F.coalesce(F.col(confidence), F.lit(0.5))
    return df.groupBy(*group).agg(((F.avg(c) < AVERAGE_CONFIDENCE) | (F.min(c) < LEAST_CONFIDENCE)).alias("needs_review"))


def section_confidence(content_size: Column) -> Column:
    """1.0; 0.3 less for empty content; 0 for none."""
    return F.when(content_size.isNull(), 0.0).when(content_size == 0, 0.7).otherwise(1.0)


def class_rollup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by the keys, with subtotals and a total (keys null)."""
    return df.rollup(*keys).agg(F.count(F.lit(1)).alias("n"))


def mapping_review(reviews: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """key, tables_reviewed, average_accuracy_pct and the counts of verdicts, for every document.

    reviews: key, error (null: completed), overall_accuracy_pct, classification_verdict,
    mapping_verdicts and value_verdicts (arrays of text). Failed tables do not count; a
    classification that is not correct is incorrect.
    """
    done = F.col("error").isNull()
    verdicts = lambda c, v: F.sum(F.when(done, F.size(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x == v)))).cast("long")
    right = done & F.coalesce(F.col("classification_verdict") == "correct", F.lit(False))
    stats = reviews.groupBy(key).agg(
        F.count_if(done).alias("tables_reviewed"),
        F.round(F.avg(F.when(done, F.coalesce("overall_accuracy_pct", F.lit(0)))), 1).alias("average_accuracy_pct"),
        F.count_if(right).alias("classification_correct"),
        F.count_if(done & ~right).alias("classification_incorrect"),
        *[verdicts(F.col("mapping_verdicts"), v).alias(f"mappings_{v}") for v in ("correct", "incorrect", "missing", "unnecessary")],
        *[verdicts(F.col("value_verdicts"), v).alias(f"values_{v}") for v in ("correct", "incorrect")],
    )
    return with_empty(documents, stats, key)


def review_totals(stats: DataFrame, failed: Column) -> DataFrame:
    """One row over documents of mapping_review(): files, errors, least, mean and largest accuracy, sums, and the verdicts' shares in percent."""
    ok = ~failed
    counts = [c for c in stats.columns if c.startswith(("mappings_", "values_", "classification_"))]
    out = stats.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(failed).alias("errors"),
        *[F.round(f(F.when(ok, F.col("average_accuracy_pct"))), 1).alias(f"{n}_accuracy_pct") for n, f in (("min", F.min), ("avg", F.avg), ("max", F.max))],
        *[F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in counts],
    )
    for group in ("mappings", "values"):
        own = [c for c in counts if c.startswith(group)]
        total = sum((F.col(c) for c in own[1:]), F.col(own[0]))
        out = out.withColumns({f"{c}_pct": F.when(total > 0, F.round(100.0 * F.col(c) / total, 1)) for c in own})
    return out


def structure_faults(document_id: Column, header: Column, sections: Column) -> Column:
    """array of what a document lacks."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim(document_id), F.lit("")) == "", "document_id is missing"),
            F.when(header.isNull(), "document_header is missing"),
            F.when(sections.isNull(), "sections is missing"),
        )
    )


def kind_faults(js: Column, wanted: Column) -> Column:
    """What is wrong with a section's JSON, for the kind (array, object or null) its schema has; null if nothing is."""
    kind = F.when(F.ltrim(js).startswith("["), "array").when(F.ltrim(js).startswith("{"), "object").otherwise("value")
    return F.when(wanted.isNotNull() & (kind != wanted), F.concat(F.lit("expected "), wanted, F.lit(", got "), kind))


def unmatched(terms: DataFrame, found: DataFrame, on: str) -> DataFrame:
    return terms.join(found.select(on).distinct(), on, "left_anti")
