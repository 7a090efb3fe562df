"""Headline timings: build every layer, then the eleven analytical queries.

Prints one JSON line. ``queries`` holds the median of the analytical queries on the
finished insight tables, ``value`` their sum, and ``pipeline`` the seconds each layer
took to build from the input tables, writes included; ``operators`` times single operators
on written tables, with their rows discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from clickweir import Lakehouse, tune
from clickweir.checks.landing import land_dumps
from clickweir.operators import analytics as N
from clickweir.operators import cleaning
from clickweir.operators import dictionary as ids
from clickweir.operators import gold as G
from clickweir.operators import insights as I
from clickweir.operators import quality as Q
from clickweir.session import fresh_dir, stage
from clickweir.sources.files import total_bytes
from clickweir.sources.layers import read_positive
from clickweir.sources.star_schema import clicks_raw

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = 3


def clock(job: Callable[[], object]) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clickweir-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark, total_bytes(spark, FOLDER))
    lake = Lakehouse(spark, fresh_dir(spark, "bench"))
    raw = clicks_raw(spark, FOLDER)

    def discard(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    pipeline = {
        "raw_scan": clock(lambda: discard(raw)),
        "clean_strict": clock(lambda: discard(cleaning.clean(raw))),
        "silver": clock(lambda: lake.ingest(raw)),
        "gold": clock(lake.build_gold),
        "insights": clock(lake.build_insights),
        "profile": clock(lambda: Q.profile_languages(lake.silver()).collect()),
    }

    # The same rows from dump files: each is decoded once, counted and staged, then cleaned.
    dumps = fresh_dir(spark, "bench-dumps")
    land_dumps(raw, dumps)
    other = Lakehouse(spark, fresh_dir(spark, "bench-dumped"))
    pipeline["ingest_dumps"] = clock(lambda: other.ingest_dumps(dumps))

    # Operators apart from writes: each reads written tables and its rows are discarded.
    silver = read_positive(lake.silver())
    stats = stage(ids.title_stats(silver), "title-stats")
    hot = stage(ids.hot_titles(stats, lake.dictionary()), "hot-titles")
    totals = stage(G.pair_totals(silver), "pair-totals")
    pairs = stage(ids.encode_ids(totals, lake.dictionary(), hot), "pairs")
    popularity, edges = lake.gold("article_popularity"), lake.gold("edges_monthly")
    operators = {
        "title_stats": lambda: ids.title_stats(silver),
        "pair_totals": lambda: G.pair_totals(silver),
        "encode_ids": lambda: ids.encode_ids(totals, lake.dictionary(), hot),
        "article_popularity": lambda: G.article_popularity(pairs),
        "article_top": lambda: G.article_top(popularity),
        "referrers_top": lambda: G.referrers_top(pairs),
        "edges_monthly": lambda: G.edges_monthly(pairs),
        "top10_by_year": lambda: I.top10_by_year(popularity),
        "all_time_top": lambda: I.all_time_top(popularity),
        "trending_mom": lambda: I.trending_mom(popularity),
        "edges_6m": lambda: I.busiest_pairs(stage(I.window_pair_totals(edges), "window-totals")),
        "referrers_6m": lambda: I.strongest_referrers(I.window_pair_totals(edges)),
    }
    operators = {name: clock(lambda: discard(build())) for name, build in operators.items()}

    lake.register_views()

    def top10():
        return spark.table("gs_top10_by_year")

    queries = {
        "n01": lambda: N.top_of_year(top10(), "eu", 2000),
        "n02": lambda: N.top_of_years(top10(), "eu", [1999, 2000]),
        "n03": lambda: N.all_time_leaders(spark.table("gs_all_time_top"), "eu"),
        "n04": lambda: N.compare_languages(top10(), ["eu", "as", "af"], 2000),
        "n05": lambda: N.new_in_top(top10(), "eu", 2000, 1999),
        "n06": lambda: N.fastest_growth(spark.table("gs_trending_mom"), "mi"),
        "n07": lambda: N.most_years_in_top(top10(), "eu"),
        "n08": lambda: N.popular_in_both(top10(), "eu", "as", 2000),
        "n09": lambda: N.leader_of_each_year(top10(), "eu"),
        "n10": lambda: N.comebacks(top10(), "eu"),
        "n11": lambda: N.leader_margin(top10(), "eu", 2000),
    }
    seconds = {
        name: statistics.median(clock(lambda: build().collect()) for _ in range(ROUNDS))
        for name, build in queries.items()
    }
    spark.stop()
    print(json.dumps({
        "metric": "analytical_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "pipeline": {name: round(value, 3) for name, value in pipeline.items()},
        "operators": {name: round(value, 3) for name, value in operators.items()},
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
