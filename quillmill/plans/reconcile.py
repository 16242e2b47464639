"""Reconciling descriptions across contracts.

Sanitise; clean by rule (abbreviations, title case); merge what is equal but for case,
punctuation and word order, unless two of them stand in one contract; check the
remaining candidate pairs by their word sets. The maps are applied once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import normalise_key, sanitise
from quillmill.operators import dedupe
from quillmill.session import cut_lineage

#: Abbreviations of the rule-based cleaner.
ABBREVIATIONS = {"asst": "assistant", "mech": "mechanical", "elec": "electrical", "supv": "supervisor", "eng": "engineer", "equip": "equipment", "maint": "maintenance"}


def clean(description: Column) -> Column:
    """Whole-word abbreviations written out, in title case."""
    known = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    words = F.transform(F.split(sanitise(description), " "), lambda w: F.coalesce(known[F.regexp_replace(F.lower(w), r"\.$", "")], w))
    return F.initcap(F.array_join(words, " "))


def reconcile(df: DataFrame, description: str, contract: str) -> DataFrame:
    """raw, cleaned, merged, final: what each raw description becomes, step by step."""
    raw = df.filter(F.col(description).isNotNull()).select(F.col(description).alias("raw"), clean(F.col(description)).alias("cleaned"), F.col(contract).alias("contract"))
    sets = dedupe.contract_sets(raw, "cleaned", "contract")
    # one group a key: few spellings each; those that share a contract are split
    keyed = sets.withColumn("key", normalise_key(F.col("cleaned")))
    split = cut_lineage(dedupe.split_by_cooccurrence(keyed, "key", "cleaned", "contracts"))
    canon = split.groupBy("key", "subgroup").agg(F.min_by("cleaned", F.struct(-F.length("cleaned"), "cleaned")).alias("merged"))
    phase2 = split.join(canon, ["key", "subgroup"]).select("cleaned", "merged")

    merged_sets = dedupe.contract_sets(raw.join(phase2, "cleaned"), "merged", "contract")
    pairs = dedupe.candidate_pairs(cut_lineage(merged_sets), "merged", "contracts")
    # the rule in the place of a model: one word set holds the other, and they differ by one word at most
    words = lambda c: F.size(F.array_distinct(F.split(F.lower(c), " ")))
    same = pairs.filter((F.col("shared") == F.col("smaller")) & (F.abs(words(F.col("name_a")) - words(F.col("name_b"))) <= 1) & (F.col("smaller") >= 2))
    longer = F.when(F.length("name_a") >= F.length("name_b"), F.col("name_a")).otherwise(F.col("name_b"))
    shorter = F.when(F.length("name_a") >= F.length("name_b"), F.col("name_b")).otherwise(F.col("name_a"))
    phase3 = same.groupBy(shorter.alias("merged")).agg(F.min(longer).alias("chosen"))
    return (
        raw.select("raw", "cleaned").distinct().join(phase2, "cleaned").join(phase3, "merged", "left")
        .select("raw", "cleaned", "merged", F.coalesce("chosen", "merged").alias("final"))
    )
