"""Insight tables over Gold.

Ranking and summing work on ids; titles are attached only to the rows that are left
(``with_titles``). Every function takes all languages at once.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.periods import index_month, index_year, month_index, month_start, window_months
from clickweir.functions.ratios import pct_delta
from clickweir.functions.titles import title_column
from clickweir.operators.dictionary import label_ids
from clickweir.operators.ranking import top_n, top_n_of_few
from clickweir.session import stage


def _keyed(gold: DataFrame, *sides: str) -> tuple[DataFrame, list[str]]:
    """Reduce each side to one key: its title or name if Gold has one, else its id.

    A frame with none of them yields no rows, with a warning.
    """
    keys = []
    for side in sides:
        text = title_column(gold, side)
        if text is None:
            warnings.warn(f"no {side}_title, {side}_name or {side}_id column; nothing to report")
            gold = gold.withColumn(f"{side}_title", F.lit(None).cast("string")).limit(0)
        elif f"{side}_title" in gold.columns or f"{side}_name" in gold.columns:
            gold = gold.withColumn(f"{side}_title", text)
        elif f"{side}_id" in gold.columns:
            keys.append(f"{side}_id")
            continue
        keys.append(f"{side}_title")
    return gold, keys


def with_titles(insight: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Replace ids by titles; without dictionary entries the id itself is shown as text."""
    if labels is not None:
        return label_ids(insight, labels)
    for side in ("curr", "prev"):
        if f"{side}_id" in insight.columns:
            text = F.col(f"{side}_id").cast("string")
            insight = insight.withColumn(f"{side}_title", text).drop(f"{side}_id")
    return insight


def latest_period(gold: DataFrame) -> DataFrame:
    """(lang, year, month) of each language's latest month."""
    last = gold.groupBy("lang").agg(F.max(month_index()).alias("_last"))
    return last.select(
        "lang", index_year(F.col("_last")).alias("year"), index_month(F.col("_last")).alias("month")
    )


def window_periods(latest: DataFrame, months: int = 6) -> DataFrame:
    """The calendar months of each language's window, one row each, with its last month."""
    days = latest.select(
        "lang",
        month_index().alias("_last"),
        F.explode(window_months(month_start(), months)).alias("_day"),
    )
    return days.select("lang", F.year("_day").alias("year"), F.month("_day").alias("month"), "_last")


def within_last_months(gold: DataFrame, months: int) -> DataFrame:
    """Rows of the last ``months`` calendar months of each language, with ``_last``.

    The period set has ``months`` rows per language, so it is broadcast. The join is on
    partition columns; the always-true bound on the month makes the planner treat the set
    as selective and prune folders at run time.
    """
    periods = window_periods(latest_period(gold), months).filter(F.col("month") >= 1)
    return gold.join(F.broadcast(periods), ["lang", "year", "month"])


def _with_period(rows: DataFrame) -> DataFrame:
    """Turn ``_last`` into year and month columns."""
    return rows.select(
        "lang",
        index_year(F.col("_last")).alias("year"),
        index_month(F.col("_last")).alias("month"),
        *[c for c in rows.columns if c not in ("lang", "_last")],
    )


def top10_of_totals(yearly: DataFrame, n: int = 10) -> DataFrame:
    """``top10_by_year`` of totals with a row for each id, written by language and year.

    Like all tables partitioned by the group, one pass ranks them: a task has few groups.
    """
    return top_n(yearly.withColumnRenamed("total_clicks", "clicks_year"), ["lang", "year"], ["-clicks_year", "curr_id"], n)


def top10_by_year(popularity: DataFrame, n: int = 10) -> DataFrame:
    gold, [key] = _keyed(popularity, "curr")
    yearly = gold.groupBy("lang", "year", key).agg(F.sum("total_clicks").alias("clicks_year"))
    return top_n_of_few(stage(yearly, "yearly-totals"), ["lang", "year"], ["-clicks_year", key], n)


def all_time_top_of_totals(totals: DataFrame, n: int = 500) -> DataFrame:
    """``all_time_top`` of totals with a row for each id, written by language."""
    return top_n(totals.withColumnRenamed("total_clicks", "clicks_all_time"), ["lang"], ["-clicks_all_time", "curr_id"], n, rank=None)


def all_time_top(popularity: DataFrame, n: int = 500) -> DataFrame:
    gold, [key] = _keyed(popularity, "curr")
    totals = gold.groupBy("lang", key).agg(F.sum("total_clicks").alias("clicks_all_time"))
    return top_n_of_few(stage(totals, "all-time-totals"), ["lang"], ["-clicks_all_time", key], n, rank=None)


def window_pair_totals(edges: DataFrame, months: int = 6) -> DataFrame:
    """Transitions of every pair over each language's last calendar months.

    Both window insights follow from it.
    """
    gold, keys = _keyed(edges, "prev", "curr")
    recent = within_last_months(gold, months)
    return recent.groupBy("lang", "_last", *keys).agg(F.sum("total_transitions").alias("total"))


def _side_key(totals: DataFrame, side: str) -> str:
    return next(c for c in totals.columns if c.startswith(side + "_"))


def busiest_pairs(totals: DataFrame, n: int = 100_000) -> DataFrame:
    """The ``n`` pairs with the largest totals per language, of written totals."""
    order = ["-total", _side_key(totals, "prev"), _side_key(totals, "curr")]
    top = top_n_of_few(totals, ["lang"], order, n, rank=None)
    return _with_period(top.withColumnRenamed("total", "transitions_6m"))


def strongest_referrers(totals: DataFrame, m: int = 50) -> DataFrame:
    """The ``m`` referrers with the largest totals for every target."""
    target, referrer = _side_key(totals, "curr"), _side_key(totals, "prev")
    top = top_n(totals, ["lang", target], ["-total", referrer], m)
    return _with_period(top.withColumnRenamed("total", "clicks_6m"))


def trending_mom(popularity: DataFrame, n: int = 1000) -> DataFrame:
    """Targets by growth from the month before the latest to the latest month.

    Both months must be present; a month without data is not replaced by an older one.
    """
    gold, [key] = _keyed(popularity, "curr")
    recent = within_last_months(gold, 2)
    is_last = month_index() == F.col("_last")
    pivoted = recent.groupBy("lang", "_last", key).agg(
        F.max(F.when(is_last, F.col("total_clicks"))).alias("clicks_now"),
        F.max(F.when(~is_last, F.col("total_clicks"))).alias("clicks_prev"),
    )
    now, before = F.col("clicks_now"), F.col("clicks_prev")
    change = pivoted.filter(now.isNotNull() & before.isNotNull()).select(
        "*", (now - before).alias("abs_delta"), pct_delta(now, before).alias("pct_delta")
    )
    order = ["-pct_delta", "-abs_delta", key]
    return _with_period(top_n_of_few(stage(change, "month-changes"), ["lang"], order, n, rank=None))
