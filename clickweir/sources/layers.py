"""Readers of the layered Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.functions.periods import partition_key
from clickweir.schemas import PARTITIONS, PERIOD
from clickweir.sources import files


def read_layer(spark: SparkSession, path: str, layout: StructType) -> DataFrame:
    """A layered table, or an empty frame of its layout while it does not exist yet.

    The explicit layout covers partition columns too, so '09' is read as 9 and a
    language is always text.
    """
    if not files.glob(spark, f"{path}/*=*"):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def read_periods(
    spark: SparkSession, path: str, layout: StructType, periods: list[tuple[str, int, int]]
) -> DataFrame:
    """Only the given partitions of a table; no other folder is listed."""
    wanted = set(periods)
    folders = [
        f"{path}/lang={lang}/year={year}/month={month}"
        for lang, year, month in files.hive_partitions(spark, path, PERIOD)
        if (lang, int(year), int(month)) in wanted
    ]
    if not folders:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", path).parquet(*folders)


def list_periods(spark: SparkSession, path: str, filled: bool = False) -> list[tuple[str, int, int]]:
    """(lang, year, month) of every partition, from folder names; ``filled``: of those with rows.

    A partition that was handled and got no rows is an empty folder.
    """
    found = files.hive_partitions(spark, path, PERIOD, filled)
    return sorted((lang, int(year), int(month)) for lang, year, month in found)


def list_languages(*tables: DataFrame) -> DataFrame:
    """Languages present in any of the given tables."""
    found = tables[0].select("lang")
    for table in tables[1:]:
        found = found.union(table.select("lang"))
    return found.distinct()


def periods_frame(spark: SparkSession, periods: list[tuple[str, int, int]]) -> DataFrame:
    return spark.createDataFrame(periods, PARTITIONS)


def in_periods(periods: list[tuple[str, int, int]]):
    """Predicate on partition columns that prunes the scan to the given partitions."""
    keys = [f"{lang}/{year}/{month}" for lang, year, month in periods]
    return partition_key().isin(keys) if keys else F.lit(False)


def latest_window(periods: list[tuple[str, int, int]], months: int) -> list[tuple[str, int, int]]:
    """Partitions within the ``months`` calendar months that end at each language's latest."""
    last: dict[str, int] = {}
    for lang, year, month in periods:
        last[lang] = max(last.get(lang, 0), year * 12 + month)
    return [(lang, y, m) for lang, y, m in periods if y * 12 + m > last[lang] - months]


def read_positive(silver: DataFrame) -> DataFrame:
    """Silver rows as Gold takes them: positive counts, widened to long."""
    return silver.filter(F.col("n") > 0).select(
        "lang", "year", "month", "prev_title", "curr_title", F.col("n").cast("long").alias("n")
    )
