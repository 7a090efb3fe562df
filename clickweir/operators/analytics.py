"""Parameterised queries over the insight tables.

Filters sit on partition columns (lang, year), so each query reads only the folders it
needs. The insight tables hold a fixed number of rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.functions.periods import month_start


def top_of_year(top10: DataFrame, lang: str, year: int) -> DataFrame:
    rows = top10.filter((F.col("lang") == lang) & (F.col("year") == year))
    return rows.select("rn", "curr_title", "clicks_year").orderBy("rn")


def top_of_years(top10: DataFrame, lang: str, years: list[int]) -> DataFrame:
    rows = top10.filter((F.col("lang") == lang) & F.col("year").isin(years))
    return rows.select("year", "rn", "curr_title", "clicks_year").orderBy("year", "rn")


def all_time_leaders(all_time: DataFrame, lang: str, k: int = 10) -> DataFrame:
    return (
        all_time.filter(F.col("lang") == lang)
        .select(F.col("curr_title").alias("title"), F.col("clicks_all_time").alias("clicks"))
        .orderBy(F.desc("clicks"), F.asc_nulls_last("title"))
        .limit(k)
    )


def compare_languages(top10: DataFrame, langs: list[str], year: int) -> DataFrame:
    rows = top10.filter(F.col("lang").isin(langs) & (F.col("year") == year))
    return rows.select("lang", "rn", "curr_title", "clicks_year").orderBy("lang", "rn")


def new_in_top(top10: DataFrame, lang: str, year: int, base_year: int) -> DataFrame:
    """Titles in the top list of ``year`` that were not in that of ``base_year``."""
    own = top10.filter(F.col("lang") == lang)
    now = own.filter(F.col("year") == year).select("curr_title")
    before = own.filter(F.col("year") == base_year).select("curr_title")
    return (
        now.join(before, "curr_title", "left_anti")
        .select(F.col("curr_title").alias("new_in_top10"))
        .orderBy(F.asc_nulls_last("new_in_top10"))
    )


def fastest_growth(trending: DataFrame, lang: str, k: int = 20) -> DataFrame:
    """Largest growth in the language's latest month."""
    own = trending.filter(F.col("lang") == lang)
    latest = own.agg(F.max(month_start())).scalar()
    return (
        own.filter(month_start() == latest)
        .select("year", "month", "curr_title", "clicks_prev", "clicks_now", "abs_delta", "pct_delta")
        .orderBy(F.desc_nulls_last("pct_delta"), F.desc("abs_delta"), F.asc_nulls_last("curr_title"))
        .limit(k)
    )


def most_years_in_top(top10: DataFrame, lang: str, k: int = 20) -> DataFrame:
    return (
        top10.filter(F.col("lang") == lang)
        .groupBy("curr_title")
        .agg(F.count("*").alias("years_in_top10"))
        .orderBy(F.desc("years_in_top10"), F.asc_nulls_last("curr_title"))
        .limit(k)
    )


def popular_in_both(top10: DataFrame, lang_a: str, lang_b: str, year: int, k: int = 20) -> DataFrame:
    """Titles in the top list of both languages, by summed clicks."""

    def side(lang: str, name: str) -> DataFrame:
        rows = top10.filter((F.col("lang") == lang) & (F.col("year") == year))
        return rows.select("curr_title", F.col("clicks_year").alias(name))

    return (
        side(lang_a, "clicks_a")
        .join(side(lang_b, "clicks_b"), "curr_title")
        .orderBy(F.desc(F.col("clicks_a") + F.col("clicks_b")), F.asc("curr_title"))
        .limit(k)
    )


def leader_of_each_year(top10: DataFrame, lang: str) -> DataFrame:
    rows = top10.filter((F.col("lang") == lang) & (F.col("rn") == 1))
    return rows.select("year", "curr_title", "clicks_year").orderBy(F.desc("year"))


def comebacks(top10: DataFrame, lang: str) -> DataFrame:
    """Titles that left the top list and returned after at least one year away."""
    by_title = Window.partitionBy("curr_title").orderBy("year")
    seen = top10.filter((F.col("lang") == lang) & (F.col("rn") <= 10)).select(
        "curr_title",
        F.lag("year").over(by_title).alias("last_seen_year"),
        F.col("year").alias("comeback_year"),
    )
    away = F.col("comeback_year") - F.col("last_seen_year")
    return seen.filter(F.col("last_seen_year").isNotNull() & (away > 1)).orderBy(
        F.desc("comeback_year"), F.asc_nulls_last("curr_title")
    )


def leader_margin(top10: DataFrame, lang: str, year: int) -> DataFrame:
    """First and second place side by side, always one row."""
    rows = top10.filter((F.col("lang") == lang) & (F.col("year") == year) & (F.col("rn") <= 2))

    def place(rank: int, column: str):
        return F.max(F.when(F.col("rn") == rank, F.col(column)))

    return rows.agg(
        place(1, "curr_title").alias("leader"),
        place(1, "clicks_year").alias("leader_clicks"),
        place(2, "curr_title").alias("runner_up"),
        place(2, "clicks_year").alias("runner_up_clicks"),
    ).withColumn("margin", F.col("leader_clicks") - F.col("runner_up_clicks"))
