"""Clickstream rows derived from a star schema of order lines.

Joins order lines with parts and suppliers into raw clickstream edges that contain every
case the cleaning rules look for: bad types, noise titles, empty titles, missing
referrers, self-loops, zero counts and duplicates. The volume grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The title prefix planted for each part size.
SIZE_PREFIX = {1: "Special:", 2: "User:", 3: "File:", 4: "Talk:", 5: "Category:"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clicks_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw edges (lang, year, month, prev, curr, type, n)."""
    prefix = F.lit("")
    for value, text in SIZE_PREFIX.items():
        prefix = F.when(F.col("p_size") == value, text).otherwise(prefix)

    # Titles are made once per part and supplier, before the joins; rules on the target
    # title then filter parts instead of order lines.
    part_title = F.replace("p_name", F.lit(" "), F.lit("_"))
    parts = table(spark, folder, "part").select(
        "p_partkey",
        part_title.alias("part_title"),
        F.concat(
            prefix,
            F.when(F.col("p_size") != 7, part_title).otherwise(""),
            F.when(F.col("p_size") == 6, "_404").otherwise(""),
        ).alias("curr"),
    )
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", "s_nationkey", F.replace("s_name", F.lit("#"), F.lit("_")).alias("supplier_title")
    )
    regions = table(spark, folder, "region").select(
        "r_regionkey", F.lower(F.substring("r_name", 1, 2)).alias("lang")
    )
    # One base table per join: the planner then sees each table's real size and
    # broadcasts the small ones, while a large part or supplier table is shuffled.
    lines = (
        table(spark, folder, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    line = F.col("l_linenumber")
    return lines.select(
        "lang",
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.when(line == 6, F.col("part_title")).when(line != 7, F.col("supplier_title")).alias("prev"),
        "curr",
        F.when(F.col("l_returnflag") == "A", "link")
        .when(F.col("l_returnflag") == "N", "external")
        .when(F.col("l_linestatus") == "O", "other")
        .otherwise("redlink")
        .alias("type"),
        (F.col("l_quantity").cast("int") - 1).cast("string").alias("n"),
    )
