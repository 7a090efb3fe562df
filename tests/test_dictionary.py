"""Title ids: numbering, increments, encoding, hot titles, decoding."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickweir.operators import dictionary as ids
from clickweir.schemas import DICTIONARY
from clickweir.session import stage

SILVER = "lang string, year int, month int, prev_title string, curr_title string, n long"
COUNTS = "lang string, first_ym int, title string, uses long"


@pytest.fixture(scope="module")
def silver(spark):
    """Four languages; one referrer holds a third of all rows."""
    row = F.col("id")
    return spark.range(12_000).select(
        F.element_at(F.array(*map(F.lit, ["de", "en", "es", "pt"])), (row % 4 + 1).cast("int")).alias("lang"),
        (F.lit(2020) + row % 3).cast("int").alias("year"),
        (row % 12 + 1).cast("int").alias("month"),
        F.when(row % 3 == 0, "other-search")
        .when(row % 50 != 1, F.concat(F.lit("P"), row % 211))
        .alias("prev_title"),
        F.concat(F.lit("T"), (row * 7) % 499).alias("curr_title"),
        (row % 90 + 1).alias("n"),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def by_window(stats):
    place = F.row_number().over(Window.partitionBy("lang").orderBy("first_ym", "title"))
    return stats.select("lang", place.cast("long").alias("id"), "title")


def test_numbering_equals_one_window_per_language(spark, silver):
    stats = ids.title_stats(silver)
    assert rows(ids.backfill(stats), "lang", "id", "title") == rows(by_window(stats))


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_numbering_does_not_depend_on_the_partition_count(spark, silver, partitions):
    stats = ids.title_stats(silver)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows(ids.backfill(stats), "lang", "id", "title")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == rows(by_window(stats))


def test_months_in_order_equal_a_backfill(spark, silver):
    """Adding month after month gives the ids of the one-shot form."""
    small = silver.filter("year = 2020 and month <= 9")
    known = spark.createDataFrame([], DICTIONARY)
    for month in (1, 4, 7):
        stats = ids.title_stats(small.filter(F.col("month") == month))
        known = known.unionByName(ids.number_titles(ids.match_titles(stats, known).filter("id is null"), known))
        known = spark.createDataFrame(known.collect(), DICTIONARY)
    assert rows(known) == rows(ids.backfill(ids.title_stats(small)), "lang", "id", "title")


def test_late_month_appends_and_keeps_ids(spark):
    known = spark.createDataFrame([("es", 1, "B"), ("es", 2, "A")], DICTIONARY)
    late = spark.createDataFrame([("es", 24_000, "0", 1), ("es", 24_000, "A", 1), ("xx", 24_001, "A", 1)], COUNTS)
    added = ids.number_titles(ids.match_titles(late, known).filter("id is null"), known)
    assert rows(added, "lang", "id", "title") == [("es", 3, "0"), ("xx", 1, "A")]


def test_nothing_new_adds_nothing(spark):
    known = spark.createDataFrame([("es", 1, "B")], DICTIONARY)
    stats = spark.createDataFrame([("es", 24_000, "B", 1)], COUNTS)
    assert ids.number_titles(ids.match_titles(stats, known).filter("id is null"), known).count() == 0


def test_hot_titles_stay_within_their_bound(silver):
    stats = ids.title_stats(silver)
    dictionary = ids.backfill(stats)
    for limit in (10, 100, 700):
        hot = ids.hot_titles(stats, dictionary, limit)
        assert hot.count() < limit
    assert ids.hot_titles(stats, dictionary, 30).filter("title = 'other-search'").count() == 4


@pytest.mark.parametrize("limit", [30, 700, 100_000])
def test_encoding_with_and_without_hot_titles(silver, limit):
    stats = ids.title_stats(silver)
    dictionary = ids.backfill(stats)
    c, p = (dictionary.select("lang", F.col("id").alias(f"{s}_id"), F.col("title").alias(f"{s}_title"))
            for s in ("curr", "prev"))
    expected = silver.join(c, ["lang", "curr_title"]).join(p, ["lang", "prev_title"], "left")
    columns = ["lang", "year", "month", "prev_id", "curr_id", "n"]
    assert rows(ids.encode_ids(silver, dictionary), *columns) == rows(expected, *columns)
    hot = ids.hot_titles(stats, dictionary, limit)
    assert rows(ids.encode_ids(silver, dictionary, hot), *columns) == rows(expected, *columns)


def test_encoding_keeps_missing_referrers_and_drops_unknown_targets(spark):
    dictionary = spark.createDataFrame([("es", 1, "A"), ("es", 2, "B"), ("en", 1, "A")], DICTIONARY)
    silver = spark.createDataFrame([
        ("es", 2024, 1, None, "A", 5),
        ("es", 2024, 1, "X", "A", 6),
        ("es", 2024, 1, "A", "X", 7),
        ("es", 2024, 1, "A", "B", 8),
        ("en", 2024, 1, "B", "A", 9),
    ], SILVER)
    expected = [
        ("en", 2024, 1, None, 1, 9),
        ("es", 2024, 1, 1, 2, 8),
        ("es", 2024, 1, None, 1, 5),
        ("es", 2024, 1, None, 1, 6),
    ]
    for hot in (None, dictionary, dictionary.limit(1), dictionary.limit(0)):
        assert rows(ids.encode_ids(silver, dictionary, hot)) == sorted(expected, key=repr)


def test_no_lookup_key_gathers_hot_or_missing_rows(silver):
    """A third of the rows share a referrer and some have none; no key keeps them together."""
    stats = ids.title_stats(silver)
    dictionary = ids.backfill(stats)
    hot = ids.hot_titles(stats, dictionary, 30)
    keyed = ids.spread_keys(silver, "title", "id", "prev_title", hot)
    largest = keyed.groupBy("lang", "_key").count().agg(F.max("count")).first()[0]
    assert largest < 60 < 900 < silver.groupBy("lang", "prev_title").count().agg(F.max("count")).first()[0]

    encoded = ids.encode_ids(silver, dictionary).withColumn("k", F.monotonically_increasing_id())
    by_id = ids.spread_keys(encoded, "id", "title", "prev_id", ids.hot_ids(encoded, dictionary, 30))
    largest = by_id.groupBy("lang", "_key").count().agg(F.max("count")).first()[0]
    assert largest < 60


def test_copies_of_one_row_are_told_apart_by_their_number(spark):
    dictionary = spark.createDataFrame([("es", 1, "A"), ("es", 2, "B")], DICTIONARY)
    copies = spark.range(3_000).select(
        F.lit("es").alias("lang"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.lit("A").alias("prev_title"), F.lit("B").alias("curr_title"), F.lit(7).alias("n"),
        F.col("id").alias("row_no"))
    keyed = ids.spread_keys(copies, "title", "id", "prev_title", dictionary)
    assert keyed.groupBy("_key").count().agg(F.max("count")).first()[0] < 10
    found = ids.encode_ids(copies, dictionary, dictionary, row_no="row_no")
    assert rows(found) == [("es", 2024, 1, 1, 2, 7)] * 3_000


def test_decoding_both_ways(silver):
    stats = ids.title_stats(silver)
    dictionary = ids.backfill(stats)
    encoded = ids.encode_ids(silver, dictionary)
    columns = ["lang", "year", "month", "prev_title", "curr_title", "n"]
    for options in (
        {},
        {"hot": ids.hot_ids(encoded, dictionary, 30)},
        {"hot": ids.hot_ids(encoded, dictionary)},
    ):
        assert rows(ids.decode_ids(encoded, dictionary, **options), *columns) == rows(silver, *columns)


@pytest.mark.parametrize("by", [["lang", "title"], ["lang", "id"]])
def test_a_sieve_keeps_every_wanted_entry_and_few_others(spark, by):
    entry = F.concat(F.lit("Titel_\u00e9\u6f22_"), F.col("id"))
    dictionary = spark.range(40_000).select(F.lit("de").alias("lang"), "id", entry.alias("title"))
    dictionary = dictionary.union(dictionary.select(F.lit("en"), "id", "title"))
    wanted = stage(dictionary.filter("lang = 'en' and id % 20 = 0").select(*by), "wanted")
    wanted = stage(wanted.union(spark.createDataFrame([("xx", 5 if by[1] == "id" else "no such title")], wanted.schema)), "wanted")
    kept = ids.sifted(dictionary, wanted, by)
    assert kept.columns == dictionary.columns and kept.schema == dictionary.schema
    assert rows(kept.join(wanted, by, "left_semi")) == rows(dictionary.join(wanted, by, "left_semi"))
    assert 2_000 <= kept.count() < 2_000 + 0.05 * 78_000
    assert rows(wanted.join(kept, by, "left"), *by, dictionary.columns[1]) == rows(wanted.join(dictionary, by, "left"), *by, dictionary.columns[1])


def test_a_sieve_has_a_bound_and_may_be_empty(spark, monkeypatch):
    dictionary = spark.range(1_000).select(F.lit("de").alias("lang"), "id", F.concat(F.lit("T"), "id").alias("title"))
    nothing = stage(dictionary.filter("id < 0"), "nothing")
    assert ids.sifted(dictionary, nothing, ["lang", "title"]).count() == 0
    monkeypatch.setattr(ids, "SIEVE_WORDS", 8)
    few, many = (stage(dictionary.filter(f"id < {n}"), "wanted") for n in (32, 33))
    assert ids.sifted(dictionary, few, ["lang", "title"]).count() < 1_000
    assert ids.sifted(dictionary, many, ["lang", "title"]) is dictionary


def test_only_sifted_entries_are_shuffled(spark):
    dictionary = stage(spark.range(20_000).select(F.lit("de").alias("lang"), "id", F.concat(F.lit("T"), "id").alias("title")), "dictionary")
    stats = stage(dictionary.filter("id % 100 = 0").select("lang", F.lit(1).alias("first_ym"), "title", F.lit(1).alias("uses")), "stats")
    with_hint = ids.match_titles(stats.hint("merge"), ids.sifted(dictionary, stats, ["lang", "title"]))
    plan = with_hint._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    # below the exchange of the dictionary stands the join with the broadcast sieve
    assert "Exchange hashpartitioning(lang" in join and "BroadcastHashJoin" in join
    assert with_hint.filter("id is null").count() == 0 and with_hint.count() == 200
