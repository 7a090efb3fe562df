"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.session import staging_dir

# White space of the word definition shared by several operators: `[^\x20\x09-\x0D]+`.
BLANKS = r"[\x20\x09-\x0D]+"
FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; no words for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANKS))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that names given later cannot clash."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage for every executor.

    Within ``session.scratch`` the copy is removed at the end of the block.
    """
    return written(df, staging_dir(df.sparkSession, label))


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written and read back; the shuffle files of the write go with its end."""
    with _shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries of the block remove their shuffle files; else these stay until the driver collects garbage."""
    before = spark.conf.get(FREED_SHUFFLES, None)
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED_SHUFFLES)
        else:
            spark.conf.set(FREED_SHUFFLES, before)


def numbered(df: DataFrame, key: str, order: str, label: str) -> DataFrame:
    """``df`` with ``rank``, the number from 0 of each row among those of its ``key``, by ``order``.

    Range partitions are sorted in parallel and written with their positions; a count for each
    (partition, key) turns positions into ranks, so no key passes through one task. For keys
    of few values: there are fewer such counts than partitions and values together, and they
    are broadcast.
    """
    placed = saved(
        df.repartitionByRange(key, order).sortWithinPartitions(key, order).withColumn("row_", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("row_", 33)
    before = Window.partitionBy(key).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        placed.groupBy(key, part.alias("part_")).agg(F.count("*").alias("size_"), F.min("row_").alias("start_"))
        .withColumn("skip_", F.coalesce(F.sum("size_").over(before), F.lit(0)))
    )
    joined = placed.withColumn("part_", part).join(F.broadcast(slices), [key, "part_"])
    return joined.withColumn("rank", F.col("row_") - F.col("start_") + F.col("skip_")).select(*df.columns, "rank")


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for every end of ``links`` (a, b): the smallest node of its component.

    Alternates the two star contractions: every node ties its larger neighbours to its
    smallest neighbour, then its smaller ones, until no link changes. Each step shuffles
    links only, a node with many links is aggregated on the map side, and the number of
    steps grows with the logarithm of the longest chain. Lineage is cut by written tables.
    """
    links = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), f"{label}-links",
    )
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of a node go to the smallest of its neighbourhood
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (
            both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        )
        # small star: smaller neighbours of a node, and the node, go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
            .where("a <> b").distinct()
        )
        links = saved(small, f"{label}-links")
        now = links.agg(
            F.count("*"), F.count_distinct("a"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if now == before or now[0] == 0:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
