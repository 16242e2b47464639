"""From raw documents to token ids: language ID, exact and near deduplication,
benchmark decontamination and byte-level BPE, each by its operator in quillmill.llm.

A stage is (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of
docs. Stages cannot be put into SQL (a trained model, a tokenizer), so there is no
ORACLE_SQL; tests compare run() with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import byte_bpe, filters
from quillmill.session import bound_arrow_batches, cut_lineage, delete_path, new_shared_path

#: The rank file of the last stage, on every executor.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    return filters.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filters.keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filters.keep_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filters.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    found = docs.select("doc_id", byte_bpe.encode_decode_column(F.col("text"), RANKS).alias("bpe"))
    return found.select(
        "doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"), F.col("bpe.ids").alias("ids"), F.sha2("bpe.decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminate),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the documents are written to the shared folder."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            delete_path(spark, last)
        last = path
    result = cut_lineage(STAGES[-1][1](spark, docs, sf_dir))
    delete_path(spark, last)
    return result
