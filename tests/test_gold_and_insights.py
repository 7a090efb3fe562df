"""Gold aggregates, rankings, insight tables and the queries on them."""

import pytest

from pyspark.sql import functions as F

from clickweir.operators import analytics as N
from clickweir.operators import gold as G
from clickweir.operators import insights as I
from clickweir.operators import quality as Q
from clickweir.operators import ranking
from clickweir.schemas import GOLD, INSIGHTS, SILVER

IDS = "lang string, year int, month int, prev_id long, curr_id long, n long"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def encoded(spark):
    return spark.createDataFrame([
        ("es", 2024, 1, 1, 2, 5),
        ("es", 2024, 1, 1, 2, 3),
        ("es", 2024, 1, None, 2, 4),
        ("es", 2024, 1, 3, 2, 8),
        ("es", 2024, 1, 2, 3, 12),
        ("es", 2024, 2, 1, 3, 1),
        ("en", 2024, 1, 1, 2, 7),
    ], IDS)


def test_pair_totals_merge_types_and_keep_missing_referrers(encoded):
    assert ("es", 2024, 1, 1, 2, 8) in rows(G.pair_totals(encoded))
    assert ("es", 2024, 1, None, 2, 4) in rows(G.pair_totals(encoded))


def test_popularity_from_edges_or_pairs(encoded):
    expected = [("en", 2024, 1, 2, 7), ("es", 2024, 1, 2, 20), ("es", 2024, 1, 3, 12), ("es", 2024, 2, 3, 1)]
    assert rows(G.article_popularity(encoded)) == expected
    assert rows(G.article_popularity(G.pair_totals(encoded))) == expected


def test_article_top_breaks_ties_by_id(spark):
    popularity = spark.createDataFrame(
        [("es", 2024, 1, i, clicks) for i, clicks in ((4, 9), (2, 9), (7, 9), (1, 3))],
        GOLD["article_popularity"],
    )
    top = rows(G.article_top(popularity, 3), "curr_id", "rn")
    assert top == [(2, 1), (4, 2), (7, 3)]


def test_referrers_and_edges_apply_thresholds(encoded):
    pairs = G.pair_totals(encoded)
    assert rows(G.referrers_top(pairs, 1, 1).filter("curr_id = 2"), "lang", "prev_id", "clicks_from_prev") == [
        ("en", 1, 7), ("es", 1, 8)]
    assert rows(G.edges_monthly(pairs, 8), "prev_id", "curr_id", "total_transitions") == [
        (1, 2, 8), (2, 3, 12), (3, 2, 8)]


@pytest.mark.parametrize("n", [1, 7, 40, 10_000])
def test_ranking_by_cutoff_equals_one_window(spark, n):
    """Groups of any size, ties, nulls, negative and huge values, keys of numbers and of text."""
    row = F.col("id")
    df = spark.range(6000).select(
        F.when(row % 3 == 0, "a").when(row % 300 == 1, "b").otherwise("c").alias("g"),
        F.when(row % 500 != 7, F.when(row % 2 == 0, row * 7919 % 101 - 50).otherwise(row * row * row)).alias("v"),
        (row % 13 / 7 - 0.5).alias("d"), F.md5(row.cast("string")).alias("t"), row.alias("k"),
    ).repartition(37)
    for order in (["-v", "k"], ["-d", "-v", "k"], ["v", "t", "k"], ["t", "k"]):
        want = ranking.top_n(df, ["g"], order, n)
        found = ranking.top_n_of_few(df, ["g"], order, n)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_ranking_by_cutoff_shuffles_few_rows(spark):
    """However many tasks have rows of a group, and however many rows are equal at the cutoff."""
    df = spark.range(0, 400_000, 1, 400).select(F.lit("a").alias("g"), (F.col("id") % 50_000 == 0).cast("long").alias("v"), "id")
    assert ranking.candidates(df, ["g"], ["-v", "id"], 1000).count() < 1010
    wide = df.withColumn("v", F.col("id") * 3)
    assert ranking.candidates(wide, ["g"], ["-v", "id"], 1000).count() == 1000



def test_trending_needs_both_months(spark):
    popularity = spark.createDataFrame([
        ("es", 2024, 1, 1, 10), ("es", 2024, 1, 2, 10), ("es", 2024, 1, 4, 10),
        ("es", 2023, 12, 1, 4), ("es", 2023, 12, 2, 20), ("es", 2023, 12, 3, 5),
        ("en", 2024, 1, 1, 10), ("en", 2023, 11, 1, 5),
    ], GOLD["article_popularity"])
    found = I.with_titles(I.trending_mom(popularity))
    assert rows(found, *INSIGHTS["trending_mom"].names) == [
        ("es", 2024, 1, "1", 10, 4, 6, 150.0),
        ("es", 2024, 1, "2", 10, 20, -10, -50.0),
    ]
    assert rows(I.trending_mom(popularity, 1), "curr_id") == [(1,)]


def test_window_counts_calendar_months(spark):
    months = [(2024, 3), (2024, 2), (2023, 12), (2023, 10), (2023, 9), (2023, 8)]
    edges = spark.createDataFrame(
        [("es", y, m, 1, 2, 10 ** i) for i, (y, m) in enumerate(months)]
        + [("en", 2020, 5, 1, 2, 3)],
        GOLD["edges_monthly"],
    )
    found = rows(I.busiest_pairs(I.window_pair_totals(edges)), "lang", "year", "month", "transitions_6m")
    assert found == [("en", 2020, 5, 3), ("es", 2024, 3, 1111)]
    assert rows(I.strongest_referrers(I.window_pair_totals(edges)), "lang", "clicks_6m", "rn") == [("en", 3, 1), ("es", 1111, 1)]
    assert rows(I.latest_period(edges)) == [("en", 2020, 5), ("es", 2024, 3)]


@pytest.mark.parametrize("column, value, expected", [
    ("curr_title", "Madrid", "Madrid"),
    ("curr_name", "Madrid", "Madrid"),
    ("curr_id", 17, "17"),
])
def test_title_column_choice(spark, column, value, expected):
    gold = spark.createDataFrame([("es", 2024, 1, value, 5)], f"lang string, year int, month int, {column} "
                                 f"{'long' if column.endswith('id') else 'string'}, total_clicks long")
    assert rows(I.with_titles(I.top10_by_year(gold)), "curr_title") == [(expected,)]


def test_title_wins_over_name_and_id(spark):
    gold = spark.createDataFrame([("es", 2024, 1, 3, "n", "t", 5)], "lang string, year int, month int, "
                                 "curr_id long, curr_name string, curr_title string, total_clicks long")
    assert rows(I.with_titles(I.all_time_top(gold)), "curr_title") == [("t",)]


def test_no_title_column_reports_nothing(spark):
    gold = spark.createDataFrame([("es", 2024, 1, 5)], "lang string, year int, month int, total_clicks long")
    with pytest.warns(UserWarning):
        assert I.top10_by_year(gold).count() == 0


def test_empty_gold_gives_empty_insights(spark):
    popularity = spark.createDataFrame([], GOLD["article_popularity"])
    edges = spark.createDataFrame([], GOLD["edges_monthly"])
    for insight in (
        I.top10_by_year(popularity), I.all_time_top(popularity), I.trending_mom(popularity),
        I.busiest_pairs(I.window_pair_totals(edges)), I.strongest_referrers(I.window_pair_totals(edges)),
    ):
        assert insight.count() == 0


@pytest.fixture(scope="module")
def top10(spark):
    return spark.createDataFrame([
        ("es", 2019, "A", 90, 1), ("es", 2019, "B", 80, 2),
        ("es", 2020, "B", 95, 1), ("es", 2020, "C", 70, 2),
        ("es", 2022, "A", 50, 1), ("es", 2022, "B", 40, 2),
        ("en", 2020, "C", 500, 1), ("en", 2020, "B", 60, 2),
    ], INSIGHTS["top10_by_year"])


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_queries_on_yearly_tops(top10):
    assert ordered(N.top_of_year(top10, "es", 2020)) == [(1, "B", 95), (2, "C", 70)]
    assert ordered(N.top_of_years(top10, "es", [2020, 2019]))[0] == (2019, 1, "A", 90)
    assert ordered(N.compare_languages(top10, ["es", "en"], 2020))[0] == ("en", 1, "C", 500)
    assert ordered(N.new_in_top(top10, "es", 2020, 2019)) == [("C",)]
    assert ordered(N.most_years_in_top(top10, "es")) == [("B", 3), ("A", 2), ("C", 1)]
    assert ordered(N.most_years_in_top(top10, "es", 1)) == [("B", 3)]
    assert ordered(N.popular_in_both(top10, "es", "en", 2020)) == [("C", 70, 500), ("B", 95, 60)]
    assert ordered(N.leader_of_each_year(top10, "es")) == [(2022, "A", 50), (2020, "B", 95), (2019, "A", 90)]
    assert ordered(N.comebacks(top10, "es")) == [("A", 2019, 2022), ("B", 2020, 2022)]
    assert ordered(N.leader_margin(top10, "es", 2020)) == [("B", 95, "C", 70, 25)]
    assert ordered(N.leader_margin(top10, "xx", 2020)) == [(None, None, None, None, None)]


def test_growth_uses_the_languages_latest_month(spark):
    trending = spark.createDataFrame([
        ("es", 2024, 1, "A", 10, 5, 5, 100.0), ("es", 2024, 1, "B", 10, 2, 8, None),
        ("es", 2023, 12, "C", 10, 1, 9, 900.0), ("en", 2024, 2, "D", 9, 1, 8, 800.0),
    ], INSIGHTS["trending_mom"])
    assert [r.curr_title for r in N.fastest_growth(trending, "es").collect()] == ["A", "B"]


def test_all_time_leaders(spark):
    table = spark.createDataFrame([("es", "A", 5), ("es", "B", 9), ("en", "C", 99)], INSIGHTS["all_time_top"])
    assert ordered(N.all_time_leaders(table, "es", 1)) == [("B", 9)]


def test_profiles(spark):
    silver = spark.createDataFrame([
        ("es", 2023, 12, "P", "A", "link", 5), ("es", 2024, 1, "P", "A", "other", 5),
        ("es", 2024, 1, "P", "B", "link", 1), ("en", 2024, 1, "P", "A", "link", 7),
    ], SILVER)
    assert ordered(Q.profile_languages(silver)) == [("es", 3, 11, 2), ("en", 1, 7, 1)]
    assert ordered(Q.profile_range(silver)) == [(2023, 2024, 1, 12, 2)]
    assert ordered(Q.profile_types(silver)) == [("link", 3, 13, 75.0), ("other", 1, 5, 25.0)]
    assert ordered(Q.profile_top_titles(silver, 1)) == [("A", 17, 2)]
