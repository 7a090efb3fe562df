"""Partitioned Parquet writes, partition replacement and catalog entries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.schemas import PERIOD
from clickweir.sources import files
from clickweir.sources.layers import list_periods, periods_frame

Period = tuple[str, int, int]


def write_partitions(
    df: DataFrame,
    path: str,
    by: list[str] = PERIOD,
    sort_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    handled: list[Period] | Callable[[], list[Period]] | None = None,
) -> None:
    """Write ``df`` as ZSTD Parquet, replacing the partitions it has rows for.

    ``handled`` names (lang, year, month) partitions that the rows are the whole new content
    of: one of them without rows loses its old files, and stays as an empty folder, which
    shows that it has been dealt with. A function is called after the write, for what only
    the write finds out.

    Rows are gathered by partition first, so a small partition becomes one file; the
    rebalance hint lets adaptive execution split a large partition over several tasks
    and merge small ones. Other partitions stay, and the commit protocol swaps the new
    files in only when the job has succeeded. ``sort_by`` is a layout hint.
    """
    spark = df.sparkSession
    before = _data_files(spark, path) if handled else []
    rows = df.hint("rebalance", *by)
    if "month" in by:
        rows = rows.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    (
        rows.sortWithinPartitions(*by, *sort_by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )
    if handled:
        _settle(spark, path, set(handled() if callable(handled) else handled), set(before))


def _data_files(spark: SparkSession, path: str) -> list[str]:
    return files.glob(spark, path + "".join(f"/{c}=*" for c in PERIOD) + "/part-*")


def _settle(spark: SparkSession, path: str, handled: set[Period], before: set[str]) -> None:
    """Empty the handled partitions whose old files the write has left in place."""
    after = _data_files(spark, path)
    filled, stale = set(), set()
    for file in after:
        folder = file.rsplit("/", 1)[0]
        lang, year, month = (step.split("=", 1)[1] for step in folder.rsplit("/", 3)[1:])
        filled.add((lang, int(year), int(month)))
        if file in before and (lang, int(year), int(month)) in handled:
            stale.add((lang, int(year), int(month)))
            files.delete(spark, folder)
    for lang, year, month in handled:
        if (lang, year, month) not in filled - stale:
            files.make_folder(spark, f"{path}/lang={lang}/year={year}/month={month:02d}")


def without_existing(df: DataFrame, existing: DataFrame, by: list[str] = PERIOD) -> DataFrame:
    """Rows whose partition is not among ``existing`` (one row per written partition)."""
    return df.join(existing.select(*by).distinct(), by, "left_anti")


def write_missing(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write only the partitions that ``path`` does not hold yet."""
    existing = periods_frame(df.sparkSession, list_periods(df.sparkSession, path))
    write_partitions(without_existing(df, existing), path, sort_by=sort_by)


def export_partitions(df: DataFrame, path: str, condition) -> None:
    """Copy the rows of some partitions to another partitioned tree."""
    write_partitions(df.filter(condition), path)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def create_table(
    spark: SparkSession, name: str, layout: StructType, path: str, by: list[str] = PERIOD
) -> None:
    """Create a partitioned Parquet table over ``path`` unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
    )


def replace_partitions(df: DataFrame, table: str) -> None:
    """Swap the table's (lang, year, month) partitions for those in ``df``.

    Partitions without new rows stay as they were. Rows that come from the table itself are
    refused, as they would be deleted while they are read.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    if set(spark.table(table).inputFiles()) & set(df.inputFiles()):
        raise ValueError(f"the new rows are read from {table}; write them elsewhere first")
    with _dynamic_overwrite(spark):
        df.select(*columns).hint("rebalance", *PERIOD).write.insertInto(table, overwrite=True)


def refresh_table(spark: SparkSession, name: str, layout: StructType, path: str) -> DataFrame:
    """A catalog table over an existing partitioned tree, with all its partitions."""
    create_table(spark, name, layout, path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)
