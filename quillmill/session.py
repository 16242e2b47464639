"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slim table (an id or a 64-bit key, a few longs) that may be broadcast.
#: At about 50 bytes a row in the join's hash table this is 25 MB, texts aside; larger tables are shuffled.
BROADCAST_ROWS = 500_000
#: Bytes of texts and arrays of a table that may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes of an Arrow batch between the JVM and a Python worker: each side holds a whole one.
ARROW_BATCH_BYTES = 4 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session with the settings every operator here is written for."""
    builder = (
        SparkSession.builder.master(master)
        .appName("quillmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUILLMILL_DRIVER_MEMORY", "8g"))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_arrow_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches to ARROW_BATCH_BYTES; a lower one stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if not now.isdigit() or not 0 < int(now) <= ARROW_BATCH_BYTES:
        spark.conf.set(name, str(ARROW_BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a master of this
    machine alone, as in tests, gets a temporary folder; on a cluster that is an error,
    as executors would not see each other's files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quillmill-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_shared_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that new_shared_path() named, on whatever store it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder: lost executors do not take it along."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """True if df has at most `limit` rows and its texts and arrays `limit_bytes`. Run it on checkpointed or written tables."""
    size = F.lit(0).cast("long")
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    rows, total = df.select(size.alias("_size")).limit(limit + 1).agg(F.count(F.lit(1)), F.sum("_size")).first()
    return rows <= limit and (total or 0) <= limit_bytes


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """broadcast(df) if its rows and bytes show that it is small, else df, to be joined by a shuffle."""
    return F.broadcast(df) if small_enough(df, limit) else df
