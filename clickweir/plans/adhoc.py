"""The pipeline without a lakehouse: from raw edges straight to an insight."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickweir.operators import dictionary as ids
from clickweir.operators import gold as G
from clickweir.operators import insights as I
from clickweir.operators.cleaning import clean
from clickweir.session import stage
from clickweir.sources.layers import read_positive


def yearly_tops(raw: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most clicked titles of every language and year.

    Runs the same operators as the layered jobs; only what several of them share is
    written, to the shared scratch folder.
    """
    silver = read_positive(stage(clean(raw), "silver"))
    stats = stage(ids.title_stats(silver), "title-stats")
    dictionary = stage(ids.backfill(stats), "dictionary")
    hot = stage(ids.hot_titles(stats, dictionary), "hot-titles")
    encoded = ids.encode_ids(G.pair_totals(silver), dictionary, hot)
    winners = stage(I.top10_by_year(G.article_popularity(encoded), n), "winners")
    return I.with_titles(winners, ids.used_entries([winners], dictionary))
