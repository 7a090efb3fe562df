"""Row counts per cleaning stage and profiles of Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.functions.periods import month_text
from clickweir.functions.ratios import pct_share
from clickweir.operators.cleaning import keepable, readable
from clickweir.schemas import PERIOD


def cleaning_counts(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    """Rows read, kept and filtered per partition, in one pass over the raw rows.

    ``is_empty`` marks partitions that would write nothing.
    """
    counted = bronze.groupBy(*PERIOD).agg(
        F.count_if(readable(profile)).alias("rows_read"),
        F.count_if(keepable(profile)).alias("rows_clean"),
    )
    return counted.select(
        "*",
        (F.col("rows_read") - F.col("rows_clean")).alias("rows_filtered"),
        (F.col("rows_clean") == 0).alias("is_empty"),
    )


def partition_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*PERIOD).agg(F.count("*").alias("row_count"))


def profile_languages(silver: DataFrame) -> DataFrame:
    """Rows, clicks and distinct targets per language, largest first."""
    return (
        silver.groupBy("lang")
        .agg(
            F.count("*").alias("records"),
            F.sum("n").alias("total_clicks"),
            F.count_distinct("curr_title").alias("unique_articles"),
        )
        .orderBy(F.desc("records"), F.asc("lang"))
    )


def profile_range(silver: DataFrame) -> DataFrame:
    """Smallest and largest year and month (independently) and the number of months."""
    return silver.agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.min("month").alias("min_month"),
        F.max("month").alias("max_month"),
        F.count_distinct(month_text()).alias("num_months"),
    )


def profile_types(silver: DataFrame) -> DataFrame:
    """Rows, clicks and share of rows per referral type, largest first."""
    counted = silver.groupBy("type").agg(
        F.count("*").alias("records"), F.sum("n").alias("total_clicks")
    )
    # The window runs over the handful of referral types, not over rows.
    whole = F.sum("records").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("pct", pct_share(F.col("records"), whole)).orderBy(
        F.desc("records"), F.asc("type")
    )


def profile_top_titles(silver: DataFrame, k: int = 10) -> DataFrame:
    """Titles with the most clicks over all languages, with their number of languages."""
    return (
        silver.groupBy("curr_title")
        .agg(F.sum("n").alias("total_clicks"), F.count_distinct("lang").alias("languages"))
        .orderBy(F.desc("total_clicks"), F.asc("curr_title"))
        .limit(k)
    )


def profile_state(silver: DataFrame, popularity: DataFrame) -> DataFrame:
    """What profiles of languages need of each month, in a form that merges.

    ``bits`` marks the targets of a month by their dictionary ids, one bitmap for each bucket
    of 32,768 ids; the rows of Silver are counted in a row without bitmap.
    """
    counted = silver.groupBy(*PERIOD).agg(F.count("*").alias("records"))
    marked = popularity.groupBy(*PERIOD, F.bitmap_bucket_number("curr_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("curr_id")).alias("bits"), F.sum("total_clicks").alias("total_clicks"),
    )
    return marked.unionByName(counted, allowMissingColumns=True)


def merged_profile(state: DataFrame) -> DataFrame:
    """``profile_languages`` of any months, exactly, from their states."""
    by_bucket = state.groupBy("lang", "bucket").agg(
        F.sum("records").alias("records"), F.sum("total_clicks").alias("total_clicks"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("titles"),
    )
    return (
        by_bucket.groupBy("lang").agg(
            F.sum("records").alias("records"), F.sum("total_clicks").alias("total_clicks"), F.sum("titles").alias("unique_articles"),
        )
        .orderBy(F.desc("records"), F.asc("lang"))
    )
