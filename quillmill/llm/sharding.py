"""Contiguous, byte-balanced shards from global prefix sums [native].

The rows are dealt out by ranges of their id into parts that are sorted and
checkpointed, so that a part's number and its rows do not change when an executor
is lost. Each part's total is summed, the totals' running sums (one row a part)
give each part's first byte and row, and the running sum inside a part gives the
rest. A shard is where the middle byte of a row falls when all bytes are cut into
equal targets. Texts are read once and never shuffled.

Defined cases: a null text has size 16 and crc32 0; a null id sorts first; rows
that are equal in id, checksum and size share the order between them arbitrarily,
so their results agree as a set; a text may be of any length; an empty table gives an empty table; other
columns are ignored. A row larger than a target can leave shards near it empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.session import cut_lineage

#: Bytes counted for each row besides its text.
ROW_OVERHEAD = 16
#: Range parts for each shuffle partition: more parts than tasks keep the tasks even.
PARTS_PER_TASK = 4


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, start (bytes before the row), shard, slot (gapless from 0)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col(id_col).asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    n_parts = PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = cut_lineage(
        slim.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    )

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    bases = (
        parts.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("base_bytes"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("base_rows"),
            F.sum("part_bytes").over(everything).alias("total_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        parts.withColumn("upto", F.sum("size").over(inside))
        .withColumn("nth", F.count(F.lit(1)).over(inside))
        .join(F.broadcast(bases), "part")  # a row a part: bounded by the number of parts
        .select(
            id_col,
            "size",
            "text_crc32",
            (F.col("base_bytes") + F.col("upto") - F.col("size")).alias("start"),
            (F.col("base_rows") + F.col("nth") - 1).alias("row"),
            "total_bytes",
        )
        # decimals: twice the bytes times the shards can pass 64 bits
        .withColumn("shard", F.expr(f"cast((cast(2 * start + size as decimal(20, 0)) * {n_shards}L) div cast(2 * total_bytes as decimal(20, 0)) as int)"))
    )
    placed = cut_lineage(placed)
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        id_col, "size", "text_crc32", "start", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )
