"""Driver-side file-system metadata through Hadoop, for any storage Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``, sorted; empty when nothing does."""
    fs, target = _handle(spark, pattern)
    found = fs.globStatus(target)
    return sorted(status.getPath().toString() for status in found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return bool(fs.exists(target))


def total_bytes(spark: SparkSession, folder: str) -> int:
    """Size of everything below ``folder``."""
    fs, target = _handle(spark, folder)
    return int(fs.getContentSummary(target).getLength())


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _handle(spark, source)
    _, new = _handle(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def truncate(spark: SparkSession, path: str, size: int) -> None:
    """Keep the first ``size`` bytes of a small file."""
    fs, target = _handle(spark, path)
    source = fs.open(target)
    head = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)
    source.close()
    out = fs.create(target, True)
    out.write(head)
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as listings name it, with scheme and host."""
    fs, target = _handle(spark, path)
    return fs.makeQualified(target).toString()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, target = _handle(spark, path)
    source = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    fs, target = _handle(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.mkdirs(target)


def hive_partitions(
    spark: SparkSession, root: str, columns: Iterable[str], filled: bool = False
) -> list[tuple[str, ...]]:
    """Partition values below ``root``, from folder names alone; ``filled``: of those with files.

    One listing, no Spark job and no file opened: the cost follows the number of partitions
    (or files), not the data.
    """
    columns = list(columns)
    pattern = root + "".join(f"/{name}=*" for name in columns) + "/part-*" * filled
    values = {}
    for path in glob(spark, pattern):
        steps = path.rstrip("/").split("/")
        steps = (steps[:-1] if filled else steps)[-len(columns):]
        values[tuple(step.split("=", 1)[1] for step in steps)] = None
    return list(values)
