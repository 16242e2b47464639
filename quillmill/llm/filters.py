"""Filters for the stages of a pipeline: documents in, documents out, all columns kept.

What goes is a small table of keys beside the documents; it is broadcast if a count
shows that it is small, else both sides are shuffled by the key. Key columns get
names that the documents do not have.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, exact_dedup, language_id, near_dedup
from quillmill.session import cut_lineage, maybe_broadcast


def _own(name: str) -> str:
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def _without(docs: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """docs less the rows whose keys are a row of `gone` (one column for each key; null equals null)."""
    names, others = [_own("key") for _ in keys], [_own("gone") for _ in keys]
    gone = maybe_broadcast(cut_lineage(gone.toDF(*others)))
    condition = F.lit(True)
    for a, b in zip(names, others, strict=True):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    keyed = docs.withColumns(dict(zip(names, keys, strict=True)))
    return keyed.join(gone, condition, "left_anti").drop(*names)


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is not rejected; the model learns from their own labels."""
    model = language_id.fit(language_id.training_rows(docs, F.lit(True)))
    found = _own("language")
    return docs.withColumn(found, language_id.predict(F.col("text"), model)).filter(~F.col(f"{found}.rejected")).drop(found)


def keep_exact(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts."""
    groups = exact_dedup.exact_groups(docs)
    left = _without(docs, [exact_dedup.row_key()], groups.filter("not kept").select("row_key").distinct())
    kept = groups.filter("kept").select("digest", "row_key")
    several = kept.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    repeated = cut_lineage(kept.join(maybe_broadcast(cut_lineage(several)), "digest", "left_semi").distinct())
    if repeated.isEmpty():
        return left
    # rows that share even the id: the longest of them stays
    key, digest, row = _own("key"), _own("digest"), _own("row")
    marked = left.withColumn(key, exact_dedup.row_key()).join(maybe_broadcast(repeated.toDF(digest, key)), key, "left")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = marked.filter(F.col(digest).isNotNull()).groupBy(digest).agg(F.max_by(whole, F.struct(F.length("text"), "text")).alias(row)).select(f"{row}.*")
    return marked.filter(F.col(digest).isNull()).select(whole.alias(row)).select(f"{row}.*").unionByName(one)


def keep_near(docs: DataFrame) -> DataFrame:
    """The document of least id of each group of near-duplicates."""
    groups = near_dedup.near_groups(docs)
    return _without(docs, [F.col("doc_id")], groups.filter("not kept").select("doc_id").distinct())


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.find_contamination(docs, benchmark)
    return _without(docs, [decontaminate.document_key()], found.filter("n_hit > 0").select("document_key").distinct())
