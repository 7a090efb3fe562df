"""Gold aggregates over id-encoded edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.operators.ranking import top_n, top_n_of_few
from clickweir.schemas import PERIOD


def pair_totals(edges: DataFrame) -> DataFrame:
    """Transitions per month and (prev, curr) pair, by id or by title, types merged.

    Every other Gold table follows from this one. The grouping key includes both ends,
    so neither a hot target nor a hot referrer makes a large shuffle partition, and
    copies of a row are merged before the shuffle.
    """
    ends = [c for c in ("prev_id", "curr_id", "prev_title", "curr_title") if c in edges.columns]
    return edges.groupBy(*PERIOD, *ends).agg(F.sum("n").alias("n"))


def article_popularity(ids: DataFrame) -> DataFrame:
    """Clicks per month and target; takes encoded edges or pair totals."""
    return ids.groupBy(*PERIOD, "curr_id").agg(F.sum("n").alias("total_clicks"))


def article_top(popularity: DataFrame, n: int = 1000, by_month: bool = False) -> DataFrame:
    """The ``n`` most clicked targets of every language and month, of a written table.

    ``by_month``: it is partitioned by language and month. A task then has rows of few months
    and a month is in few tasks, so that the group limit alone makes the shuffle small.
    """
    rank = top_n if by_month else top_n_of_few
    return rank(popularity, PERIOD, ["-total_clicks", "curr_id"], n)


def edges_monthly(pairs: DataFrame, min_clicks: int = 1) -> DataFrame:
    """Pairs with a known referrer and at least ``min_clicks``."""
    return pairs.filter(F.col("prev_id").isNotNull() & (F.col("n") >= min_clicks)).select(
        *PERIOD, "prev_id", "curr_id", F.col("n").alias("total_transitions")
    )


def referrers_top(pairs: DataFrame, m: int = 50, min_clicks: int = 1) -> DataFrame:
    """The ``m`` strongest referrers of every target and month, above a threshold."""
    strong = pairs.filter(F.col("prev_id").isNotNull() & (F.col("n") >= min_clicks)).select(
        *PERIOD, "curr_id", "prev_id", F.col("n").alias("clicks_from_prev")
    )
    return top_n(strong, [*PERIOD, "curr_id"], ["-clicks_from_prev", "prev_id"], m)
