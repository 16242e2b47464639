r"""Exact duplicates through a log-structured merge index of digests [native].

* Memtables: the rows of a scan task are sorted by digest and flushed as runs of at most
  MEMTABLE rows, each with a Parquet Bloom filter and min/max statistics on the digest,
  so point lookups skip runs and row groups. They are level 0.
* Compaction: when a level has FANOUT flushes, they are merged, in the order of their
  digests, into one flush of the next level, which has one entry a digest: the most
  code points, then the smallest id, and how many rows it stands for. A digest of many
  rows is merged on the side of the runs first, so it arrives as one entry a run.
  compact() merges what all levels hold.
* Hits are digests with several rows. Their texts are verified by bytes: a bitmap of the
  hits' row keys, sized by their number, picks the rows to read (beyond
  FILTER_BITS_MOST bits the keys are joined instead); only those texts are shuffled,
  grouped by (digest, text) with map-side combination, so that a large group of copies
  arrives as one row a task. Digests under which more than one text is found are
  collisions: they are looked up in the runs, and their rows are grouped by the text.

Texts are equal when identical after deleting every character of [\x20\x09-\x0D].
A text is hashed by SHA-256 once; a row is known by a 64-bit key of its id and text.

Defined cases: a null text counts as empty, all empty ones are one group; of rows
equal in id and text all say what the id says; a null id sorts after others; a text
may be of any length; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.session import cut_lineage, delete_path, maybe_broadcast, new_shared_path

#: Characters that do not count when texts are compared: space and \x09-\x0D.
IGNORED = " \t\n\x0b\x0c\r"
#: Rows of a run, and flushes of a level that are merged into the next one.
MEMTABLE, FANOUT = 1_000_000, 8
#: The bitmap of the rows to verify has eight bits a row, within these bounds (2 and 32 MB).
FILTER_BITS_LEAST, FILTER_BITS_MOST = 1 << 24, 1 << 28
_BUCKET = 32768  # bits of one bitmap of bitmap_construct_agg()
#: Digests that are looked up through the runs' filters; more are joined.
LOOKUPS = 1_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _merged(entries: DataFrame) -> DataFrame:
    """digest, chars, id, n: one entry a digest. Sorted and merged on both sides of the shuffle."""
    return (
        entries.groupBy("digest")
        # bitwise_not turns the order of ids around and can't overflow
        .agg(F.max(F.struct("chars", F.bitwise_not("id").alias("not_id"))).alias("best"), F.sum("n").alias("n"))
        .select("digest", "best.chars", F.bitwise_not("best.not_id").alias("id"), "n")
    )


class LsmDigestIndex:
    """Runs of digests below one folder, level by level; add() flushes and merges full levels."""

    def __init__(self, spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256):
        self.spark, self.path, self.digest = spark, path, digest
        self.levels: list[list[str]] = [[]]  # folders of the flushes of each level
        self.logs: list[str] = []  # level 0 as it was flushed: the rows' keys by digest
        self._flushes = 0

    def _flush(self, rows: DataFrame, level: int) -> str:
        path = f"{self.path}/level{level}-{self._flushes}"
        self._flushes += 1
        rows.sortWithinPartitions("digest").write.option("maxRecordsPerFile", MEMTABLE).option("parquet.bloom.filter.enabled#digest", "true").option(
            "parquet.bloom.filter.expected.ndv#digest", str(min(MEMTABLE, 200_000))
        ).parquet(path)
        return path

    def add(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        """Flush the memtables of a batch's tasks, without a shuffle; then merge what is full."""
        rows = docs.select(
            row_key(id_col, text_col).alias("key"),
            F.col(id_col).alias("id"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
            self.digest(normalised(F.col(text_col))).alias("digest"),
            F.lit(1).cast("long").alias("n"),
        )
        self.logs.append(self._flush(rows, 0))
        self.levels[0].append(self.logs[-1])
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self._merge_into(level + 1, self.levels[level])
            self.levels[level] = []
            level += 1

    def _merge_into(self, level: int, flushes: list[str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._flush(_merged(self._entries(flushes)), level))
        for path in flushes:
            if path not in self.logs:
                delete_path(self.spark, path)

    def _entries(self, flushes: list[str]) -> DataFrame:
        return self.spark.read.schema(f"digest {self._digest_type()}, chars int, id {self._id_type}, n long").parquet(*flushes)

    def _digest_type(self) -> str:
        return self.spark.read.parquet(self.logs[0]).schema["digest"].dataType.simpleString()

    @property
    def _id_type(self) -> str:
        return self.spark.read.parquet(self.logs[0]).schema["id"].dataType.simpleString()

    def rows(self) -> DataFrame:
        """key, id, chars, digest, n of all rows that were added."""
        return self.spark.read.parquet(*self.logs)

    def compact(self) -> DataFrame:
        """digest, chars, id, n: all levels merged into the last one."""
        flushes = [path for level in self.levels for path in level]
        last = len(self.levels)
        if len(flushes) > 1 or flushes[0] in self.logs:
            self._merge_into(last, flushes)
            self.levels = [[] for _ in range(last)] + [self.levels[last]]
        return self.spark.read.parquet(*[path for level in self.levels for path in level])

    def lookup(self, digests: DataFrame) -> DataFrame:
        """The rows of these digests. Up to LOOKUPS of them go to the scan, where filters and statistics skip runs."""
        few = [r[0] for r in digests.limit(LOOKUPS + 1).collect()]
        if len(few) <= LOOKUPS:
            return self.rows().filter(F.col("digest").isin(few) if few else F.lit(False))
        return self.rows().join(maybe_broadcast(digests), "digest", "left_semi")


def _bits(key: Column, n_bits: int) -> tuple[Column, Column]:
    at = F.pmod(key, F.lit(n_bits))
    return F.shiftright(at, 15).cast("int"), F.pmod(at, F.lit(_BUCKET)).cast("int")


def _rows_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of texts whose key is among keys (distinct), with the digest beside."""
    n = keys.count()
    n_bits = max(FILTER_BITS_LEAST, 1 << (8 * n).bit_length())
    if n_bits <= FILTER_BITS_MOST:
        bucket, bit = _bits(F.col("key"), n_bits)
        bitmaps = keys.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
        texts = (
            texts.withColumns({"_bucket": bucket, "_bit": bit})
            .join(F.broadcast(bitmaps), "_bucket")  # at most FILTER_BITS_MOST bits
            .filter(F.expr("(cast(conv(hex(substring(_bits, _bit div 8 + 1, 1)), 16, 10) as int) & shiftleft(1, _bit % 8)) <> 0"))
            .drop("_bucket", "_bit", "_bits")
        )
    return texts.join(maybe_broadcast(keys), "key")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """id, keep_id, group_size, kept, digest (of the normalised text), row_key: a row for each row."""
    spark = docs.sparkSession
    index = LsmDigestIndex(spark, new_shared_path(spark, "lsm"), digest)
    index.add(docs, id_col, text_col)
    hits = maybe_broadcast(index.compact().filter("n > 1").select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size")))

    members = index.rows().select("id", "key", "digest").join(hits, "digest", "left")
    texts = docs.select(
        row_key(id_col, text_col).alias("key"),
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
        F.col(text_col).alias("text"),
    )
    norm = normalised(F.col("text"))
    wanted = cut_lineage(members.filter("group_size is not null").select("key", "digest").distinct())
    collided = cut_lineage(
        _rows_of(texts.select("key", "text"), wanted)
        .select("digest", norm.alias("norm"))
        .groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))  # byte verification
        .groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1")
        .select("digest")
    )

    found = members.select(
        "id", F.coalesce("keep_id", "id").alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "digest", "key"
    )
    if not collided.isEmpty():
        rows = _rows_of(texts, cut_lineage(index.lookup(collided).select("key", "digest").distinct())).withColumn("norm", norm)
        rows = rows.filter(digest(F.col("norm")) == F.col("digest"))  # texts that share even the key
        by_text = (
            rows.groupBy("digest", "norm")
            .agg(F.max(F.struct("chars", F.bitwise_not("id").alias("not_id"))).alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", "norm", F.bitwise_not("best.not_id").alias("keep_id"), "group_size")
        )
        resolved = rows.select("id", "digest", "norm", "key").join(by_text, ["digest", "norm"]).drop("norm")
        found = found.join(collided, "digest", "left_anti").unionByName(resolved.select(found.columns))
    result = cut_lineage(
        found.select(
            F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", F.col("key").alias("row_key")
        )
    )
    delete_path(spark, index.path)
    return result
