"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on, the same for every size of input. Adaptive
# execution sizes shuffles, splits skewed join and rebalance partitions and switches join
# strategy by measured size. The small minimum partition size keeps writes of many small
# (language, month) partitions spread over all cores. A shuffled join hashes its smaller side
# instead of sorting both wherever every partition of that side is measured to be small
# enough, which spares sorting the edges in the title lookups. Without a group-limit
# threshold ``row_number() <= n`` cuts rows *before* the shuffle for any n. Tasks of 16 MB
# instead of 64 MB, so that a write is not one task more than there are cores, each of which
# sorts millions of rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    "spark.sql.parquet.filterPushdown": "true",
}


# Compressed columnar input grows by about this factor when its rows are shuffled.
GROWTH = 4
# Aim for shuffle partitions of this many bytes.
TARGET_BYTES = 128 << 20


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    ``input_bytes`` sizes the shuffles. Adaptive execution merges partitions that turn
    out small but never creates more than it started with, so a large job has to start
    high enough; a session that asks for more keeps its own number.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    have = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", str(max(have, shuffle_partitions(input_bytes))))
    return spark


@contextmanager
def tuned(spark: SparkSession, input_bytes: int = 0) -> Iterator[None]:
    """The runtime settings for the length of a block; the caller's own come back after it."""
    keys = [*RUNTIME_SETTINGS, "spark.sql.shuffle.partitions"]
    before = {key: spark.conf.get(key) for key in keys}
    tune(spark, input_bytes)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions of about ``TARGET_BYTES`` for compressed input of this size.

    A job over very large input keeps the product of map tasks and partitions in hand by
    larger input splits (``spark.sql.files.maxPartitionBytes``) or by taking fewer months at
    a time; every large shuffle here is keyed by month.
    """
    return -(-input_bytes * GROWTH // TARGET_BYTES)


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local folder would lose data with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="clickweir-")
    return _local_dirs[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged within the block when it ends, if all of it has been used by then."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in paths:
            target = hadoop.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def staging_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed at the end of the surrounding ``scratch``."""
    path = fresh_dir(spark, label)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it.

    Used where several consumers need the same rows or where a result must not be
    recomputed. The written copy survives the loss of executors, and unlike a
    checkpointed RDD it keeps column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = staging_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
