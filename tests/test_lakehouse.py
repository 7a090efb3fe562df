"""Whole jobs: ingest, Gold, insights, increments, skipping, replacing, catalog."""

import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickweir import Lakehouse
from clickweir.operators import dictionary as ids
from clickweir.operators import gold as G
from clickweir.plans import ingest
from clickweir.schemas import BRONZE, DICTIONARY, GOLD, INSIGHTS, SILVER
from clickweir.session import fresh_dir, shared_dir, shuffle_partitions
from clickweir.sinks import tables
from clickweir.checks import landing
from clickweir.checks.landing import land_dumps
from clickweir.sources import bronze, files, layers, listing
from clickweir.streaming import increments

MONTHS = [(2023, 12), (2024, 1), (2024, 2)]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark):
    """Two languages and three months of raw edges; 'en' lacks the last month."""
    data = []
    for lang in ("es", "en"):
        for i, (year, month) in enumerate(MONTHS):
            if (lang, i) == ("en", 2):
                continue
            for k in range(40):
                title = f"T_{(k * 7 + i) % 13}"
                data.append((lang, year, month, "other-search", title, "external", str(5 + k + i)))
                data.append((lang, year, month, f"P_{k % 9}", title, "link", str(3 + k % 5)))
    return spark.createDataFrame(data, BRONZE)


@pytest.fixture()
def lake(spark):
    return Lakehouse(spark, fresh_dir(spark, "lake"))


def contents(lake):
    found = {t: rows(lake.gold(t), *GOLD[t].names) for t in GOLD}
    found |= {t: rows(lake.insight(t), *INSIGHTS[t].names) for t in INSIGHTS}
    return found | {"dictionary": rows(lake.dictionary(), *DICTIONARY.names)}


def test_layers_and_their_invariants(spark, lake, raw):
    lake.ingest(raw)
    done = lake.build_gold()
    lake.build_insights()
    silver = lake.silver()
    assert done == layers.list_periods(spark, lake.silver_path) and len(done) == 5
    assert rows(lake.languages()) == [("en",), ("es",)]

    total = silver.agg(F.sum("n")).first()[0]
    assert lake.gold("article_popularity").agg(F.sum("total_clicks")).first()[0] == total
    assert lake.gold("edges_monthly").agg(F.sum("total_transitions")).first()[0] == total
    assert lake.insight("all_time_top").agg(F.sum("clicks_all_time")).first()[0] == total

    dictionary = lake.dictionary()
    sizes = dictionary.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("ids"),
        F.count_distinct("title").alias("titles"), F.min("id").alias("low"), F.max("id").alias("high"))
    for r in sizes.collect():
        assert r.n == r.ids == r.titles == r.high and r.low == 1

    places = lake.gold("article_top").groupBy("lang", "year", "month").agg(
        F.count("*").alias("n"), F.max("rn").alias("last"), F.count_distinct("rn").alias("d"))
    assert all(r.n == r.last == r.d for r in places.collect())
    assert {r.lang for r in lake.insight("trending_mom").collect()} == {"es", "en"}
    assert rows(lake.insight("trending_mom").select("lang", "year", "month").distinct()) == [
        ("en", 2024, 1), ("es", 2024, 2)]


def test_month_by_month_equals_one_go(spark, lake, raw):
    whole = Lakehouse(spark, fresh_dir(spark, "whole"))
    whole.ingest(raw)
    whole.build_gold()
    whole.build_insights()
    for year, month in MONTHS:
        lake.ingest(raw.filter((F.col("year") == year) & (F.col("month") == month)))
        done = lake.build_gold()
        assert {p[1:] for p in done} == {(year, month)}
        assert lake.build_gold() == []
    lake.build_insights()
    assert contents(lake) == contents(whole)


def test_rerun_changes_nothing(lake, raw):
    lake.ingest(raw)
    lake.build_gold()
    lake.build_insights()
    before = contents(lake)
    lake.ingest(raw)
    lake.build_gold(skip_existing=False)
    lake.build_insights(skip_existing=False)
    assert contents(lake) == before


def test_selected_outputs_and_months(spark, lake, raw):
    lake.ingest(raw)
    assert lake.build_gold(edges=False, referrers=False, latest_month=True) == [("es", 2024, 2)]
    assert not files.exists(spark, lake.gold_path("edges_monthly"))
    assert rows(lake.gold("edges_monthly")) == [] and rows(lake.gold("referrers_top")) == []
    assert lake.build_gold(lang="en", year=2023) == [("en", 2023, 12)]
    assert rows(lake.gold("article_popularity").select("lang", "year", "month").distinct()) == [
        ("en", 2023, 12), ("es", 2024, 2)]
    # Edges are still missing for the month done without them.
    assert ("es", 2024, 2) in lake.build_gold()
    assert lake.build_gold() == []


def test_insights_skip_finished_partitions(spark, lake, raw):
    lake.ingest(raw)
    lake.build_gold()
    lake.build_insights(languages=["en"])
    assert {r.lang for r in lake.insight("all_time_top").collect()} == {"en"}
    stamp = files.glob(spark, lake.insight_path("all_time_top") + "/lang=en/*")
    lake.build_insights()
    assert {r.lang for r in lake.insight("all_time_top").collect()} == {"en", "es"}
    assert files.glob(spark, lake.insight_path("all_time_top") + "/lang=en/*") == stamp
    lake.build_insights(skip_existing=False)
    assert files.glob(spark, lake.insight_path("all_time_top") + "/lang=en/*") != stamp


def test_insights_without_gold_write_nothing(lake):
    lake.build_insights()
    assert rows(lake.insight("top10_by_year")) == [] and rows(lake.languages()) == []


def test_insights_are_rebuilt_alike(lake, raw):
    lake.ingest(raw)
    lake.build_gold()
    lake.build_insights()
    before = contents(lake)
    lake.build_insights(skip_existing=False)
    assert contents(lake) == before


def test_foreign_silver_with_missing_referrer(spark, lake):
    silver = spark.createDataFrame(
        [("es", 2024, 1, None, "A", "other", 5), ("es", 2024, 1, "B", "A", "link", 6),
         ("es", 2024, 1, "B", "C", "link", 0)], SILVER)
    tables.write_partitions(silver, lake.silver_path)
    lake.build_gold()
    assert rows(lake.gold("article_popularity"), "curr_id", "total_clicks") == [(1, 11)]
    assert rows(lake.gold("edges_monthly"), "prev_id", "curr_id", "total_transitions") == [(2, 1, 6)]
    assert rows(lake.dictionary(), "id", "title") == [(1, "A"), (2, "B")]


def test_dumps_round_trip(spark, lake, raw):
    root = tempfile.mkdtemp(prefix="dumps-", dir="/tmp")
    land_dumps(raw, root)
    names = files.glob(spark, f"{root}/*/*")
    assert f"{root}/2024-02/clickstream-eswiki-2024-02.tsv.gz" in [n.removeprefix("file:") for n in names]
    assert len(names) == 5
    assert rows(bronze.read_dumps(spark, root), *BRONZE.names) == rows(raw, *BRONZE.names)
    counts = lake.ingest_dumps(root, lang="es")
    assert (counts["rows_read"], counts["rows_clean"]) == (240, 240)
    whole = Lakehouse(spark, fresh_dir(spark, "whole"))
    whole.ingest(raw.filter("lang = 'es'"))
    assert rows(lake.silver(), *SILVER.names) == rows(whole.silver(), *SILVER.names)
    assert lake.ingest_dumps(root, profile="lenient", skip_existing=True)["rows_clean"] == 160
    assert lake.ingest_dumps(root, skip_existing=True)["partitions"] == []
    kept = lake.silver().filter("lang = 'es'")
    assert rows(kept, *SILVER.names) == rows(whole.silver(), *SILVER.names)
    assert lake.silver().filter("lang = 'en' and curr_title like 'T\\\\_%'").count() == 160


def test_parts_of_a_dump_do_not_bound_the_tasks(spark, lake, monkeypatch):
    """A large partition goes to more tasks than it has parts, and loses no line."""
    monkeypatch.setattr(landing, "TASK_BYTES", 16 << 10, raising=False)
    root = fresh_dir(spark, "parts")
    number = F.col("id").cast("string")
    big = spark.range(40_000, numPartitions=8).select(
        F.lit("es").alias("lang"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.concat(F.lit("P_"), number).alias("prev"), F.concat(F.lit("T_"), F.md5(number)).alias("curr"), F.lit("link").alias("type"), F.lit("7").alias("n"),
    )
    small = big.filter("id < 100").withColumn("month", F.lit(2))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    land_dumps(big.unionByName(small), root, parts=2)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert len(files.glob(spark, f"{root}/2024-01/*")) > 4
    assert len(files.glob(spark, f"{root}/2024-02/*")) >= 2
    report = lake.ingest_dumps(root)
    assert [(p[2], p[3]) for p in report["partitions"]] == [(1, 40_000), (2, 100)]
    rows_of = bronze.read_dumps(spark, root).select("prev", "curr")
    assert rows_of.distinct().count() == 40_000 and lake.silver().count() == report["rows_clean"]


def test_ingest_skips_finished_partitions(lake, raw):
    lake.ingest(raw.filter("lang = 'es'"))
    before = rows(lake.silver(), *SILVER.names)
    lake.ingest(raw.withColumn("n", F.lit("1")), skip_existing=True)
    assert rows(lake.silver().filter("lang = 'es'"), *SILVER.names) == before
    assert {r.n for r in lake.silver().filter("lang = 'en'").collect()} == {1}


def test_empty_partitions_leave_earlier_rows_alone(lake, raw):
    lake.ingest(raw)
    before = rows(lake.silver(), *SILVER.names)
    lake.ingest(raw.filter("lang = 'es'").withColumn("n", F.lit("0")))
    assert rows(lake.silver(), *SILVER.names) == before


def test_noise_only_replaces_and_counts_as_done(lake, raw):
    lake.ingest(raw)
    lake.build_gold()
    noise = raw.filter("lang = 'es'").withColumn("curr", F.lit("Special:x"))
    lake.ingest(noise)
    assert {r.lang for r in lake.silver().select("lang").distinct().collect()} == {"en"}
    assert lake.build_gold(min_edges=10**6, skip_existing=False)
    assert lake.gold("edges_monthly").count() == 0
    assert {r.lang for r in lake.gold("article_popularity").collect()} == {"en"}
    assert lake.build_gold(min_edges=10**6) == []
    lake.build_insights()
    assert lake.insight("edges_6m").count() == 0


def test_one_broken_file_does_not_stop_the_others(spark, lake, raw):
    root = fresh_dir(spark, "broken").removeprefix("file:")
    land_dumps(raw, root)
    good = f"{root}/2024-02/clickstream-eswiki-2024-02.tsv.gz"
    with open(good, "rb") as file:
        content = file.read()
    with open(f"{root}/2024-02/clickstream-frwiki-2024-02.tsv.gz", "wb") as file:
        file.write(content[:len(content) // 2])
    with open(f"{root}/odd-name.tsv.gz", "wb") as file:
        file.write(content)
    report = lake.ingest_dumps(root)
    assert [p.rsplit("/", 1)[1] for p in report["unreadable"]] == ["clickstream-frwiki-2024-02.tsv.gz"]
    assert [p.rsplit("/", 1)[1] for p in report["rejected"]] == ["odd-name.tsv.gz"]
    assert report["superseded"] == []
    whole = Lakehouse(spark, fresh_dir(spark, "whole"))
    whole.ingest(raw)
    assert rows(lake.silver(), *SILVER.names) == rows(whole.silver(), *SILVER.names)
    assert sum(p[3] for p in report["partitions"]) == report["rows_read"]


def test_any_other_error_ends_the_ingest(spark, lake, raw, monkeypatch):
    """A job that fails for another reason does not make its files damaged ones."""
    root = fresh_dir(spark, "failing")
    land_dumps(raw, root)
    lake.ingest_dumps(root)
    before = rows(lake.silver(), *SILVER.names)
    land_dumps(raw.withColumn("n", F.lit("9")), f"{root}/zz")
    real = bronze.scan_batch

    def failing(spark_, batch):
        return real(spark_, batch).withColumn("n", F.when(F.col("n") == "9", F.raise_error(F.lit("disk full"))).otherwise(F.col("n")))

    monkeypatch.setattr(bronze, "scan_batch", failing)
    with pytest.raises(Exception, match="disk full"):
        lake.ingest_dumps(root)
    assert rows(lake.silver(), *SILVER.names) == before


def test_many_damaged_files_in_small_batches(spark, lake, raw):
    root = fresh_dir(spark, "damaged")
    land_dumps(raw, root)
    land_dumps(raw.filter("lang = 'es'"), f"{root}/zz", cut=True)
    land_dumps(raw.filter("lang = 'en'").withColumn("n", F.lit("1")), f"{root}/zz")
    found = [f for f in bronze.inspect_files(spark, root) if f.accepted]
    for size in (1, 4, 1000):
        staged, records = ingest.stage_files(spark, found, "strict", batch_files=size)
        assert [r.complete for r in records] == ["/zz/" not in r.file.path or "eswiki" not in r.file.path for r in records]
        counts = {r.file.path: (r.rows_read, r.rows_clean) for r in records}
        seen = staged.groupBy("file").agg(F.count("*").alias("n"), F.count_if("kept").alias("k")).collect()
        assert {found[r.file].path: (r.n, r.k) for r in seen} == {p: c for p, c in counts.items() if c[0]}
    report = lake.ingest_dumps(root)
    assert len(report["unreadable"]) == 3 and len(report["superseded"]) == 2
    assert {r.n for r in lake.silver().filter("lang = 'en'").collect()} == {1}
    states = dict(rows(lake.ingest_log().groupBy("state").count()))
    assert states == {"taken": 5, "superseded": 2, "unreadable": 3}


def test_no_exchange_of_raw_lines(spark, raw):
    root = fresh_dir(spark, "plain")
    land_dumps(raw, root)
    found = [f for f in bronze.inspect_files(spark, root) if f.accepted]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = plan_of(bronze.scan(spark, found, batch_files=2))
    finally:
        spark.conf.set(key, before)
    assert plan.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    many = bronze.batches([found[0]] * 200_000)
    assert len(many) == 196 and max(map(len, many)) <= bronze.BATCH_FILES and many[-1][-1][0] == 199_999


def test_stream_takes_each_file_once(spark, lake, raw):
    root = fresh_dir(spark, "stream")
    land_dumps(raw.filter("lang = 'es'"), root, parts=2)
    lake.stream_dumps(root, files_at_once=2)
    log = lake.ingest_log()
    first = {r.path for r in log.collect()}
    assert len(first) == 6 and log.select("ingest").distinct().count() == 3
    lake.stream_dumps(root)
    assert lake.ingest_log().select("ingest").distinct().count() == 3
    # a late dump of one month, earlier in path order than the one taken, and one that comes later
    land_dumps(raw.filter("lang = 'es' and month = 1").withColumn("n", F.lit("8")), f"{root}/2000-00")
    land_dumps(raw.filter("lang = 'es' and month = 2").withColumn("n", F.lit("9")), f"{root}/zz")
    lake.stream_dumps(root)
    whole = Lakehouse(spark, fresh_dir(spark, "whole"))
    whole.ingest(raw.filter("lang = 'es'").withColumn("n", F.when(F.col("month") == 2, "9").otherwise(F.col("n"))))
    assert rows(lake.silver(), *SILVER.names) == rows(whole.silver(), *SILVER.names)
    new = {r.path for r in lake.ingest_log().filter("ingest = 'stream-3'").collect()}
    assert len(new) == 2 and not new & first


class Stopping(Lakehouse):
    """Stops before one of the tables is written."""

    at = "referrers_top"

    def _write_version(self, log, frame, topic, *rest):
        if topic == self.at:
            raise RuntimeError("stopped")
        return super()._write_version(log, frame, topic, *rest)


def test_a_stopped_build_leaves_the_old_version(spark, lake, raw):
    lake.ingest(raw)
    with pytest.raises(RuntimeError):
        Stopping(spark, lake.root).build_gold()
    assert all(rows(lake.gold(t)) == [] for t in GOLD) and lake.build_gold(topn=5)
    lake.build_insights()
    before = contents(lake)
    with pytest.raises(RuntimeError):
        Stopping(spark, lake.root).build_gold(topn=2, skip_existing=False)
    stopping = Stopping(spark, lake.root)
    stopping.at = "trending_mom"
    with pytest.raises(RuntimeError):
        stopping.build_insights(topn_all_time=1, skip_existing=False)
    assert contents(lake) == before
    lake.vacuum()
    assert contents(lake) == before
    folders = files.glob(spark, f"{lake.gold_path('article_top')}/*/*/*/commit=*")
    assert len(folders) == 5 and len(files.glob(spark, f"{lake.root}/gold/_commits/*")) == 1


def test_an_empty_insight_is_a_version(spark, lake, raw):
    lake.ingest(raw.filter("month != 1"))  # no month follows another one
    lake.build_gold()
    with pytest.warns(UserWarning, match="trending_mom: no rows"):
        lake.build_insights()
    assert rows(lake.insight("trending_mom")) == [] and len(lake.insight_log.partitions("trending_mom")) == 2
    assert lake._pending_window("trending_mom", "article_popularity", 2, None, True) == []
    assert lake.insight("edges_6m").count() > 0
    lake.build_gold(min_edges=10**6, skip_existing=False)
    lake.build_insights(skip_existing=False)
    assert rows(lake.insight("edges_6m")) == [] and rows(lake.insight("referrers_6m")) == []
    assert lake.insight("top10_by_year").count() > 0


def test_insights_grow_by_month(spark, lake, raw, monkeypatch):
    whole = Lakehouse(spark, fresh_dir(spark, "whole"))
    whole.ingest(raw)
    whole.build_gold()
    whole.build_insights()
    read, part = [], Lakehouse._gold_part
    monkeypatch.setattr(Lakehouse, "_gold_part", lambda self, topic, periods: (read.append((topic, sorted(periods))), part(self, topic, periods))[1])
    for year, month in MONTHS:
        lake.ingest(raw.filter((F.col("year") == year) & (F.col("month") == month)))
        lake.build_gold()
        read.clear()
        assert {k[1] for k in lake.update_totals()} == {year}
        assert {p[1:] for _, periods in read for p in periods} == {(year, month)}
        assert lake.update_totals() == []
    grown = {t: rows(lake.state(t)) for t in ("yearly_totals", "all_time_totals")}
    # a month that comes again is not counted twice
    lake.ingest(raw.filter("year = 2024 and month = 1"))
    lake.build_gold(year=2024, month=1, skip_existing=False)
    assert {k for k in lake.update_totals()} == {("en", 2024), ("es", 2024)}
    assert {t: rows(lake.state(t)) for t in grown} == grown
    popularity = whole.gold("article_popularity")
    assert grown["all_time_totals"] == rows(popularity.groupBy("lang", "curr_id").agg(F.sum("total_clicks").alias("c")))
    assert grown["yearly_totals"] == rows(popularity.groupBy("lang", "year", "curr_id").agg(F.sum("total_clicks").alias("c")))


def test_kept_totals_are_ranked_as_they_are(spark, lake, raw, monkeypatch):
    """The totals hold each id once, by partition: nothing is summed, staged or counted for a cutoff again."""
    from clickweir.operators import insights as I

    lake.ingest(raw)
    lake.build_gold(topn=5)
    staged, real = [], I.stage
    monkeypatch.setattr(I, "stage", lambda df, label: (staged.append(label), real(df, label))[1])
    lake.build_insights(incremental=True, topn_all_time=7)
    assert staged == ["month-changes"]
    monkeypatch.undo()
    popularity = lake.gold("article_popularity")
    yearly, ever = I.top10_of_totals(lake.state("yearly_totals")), I.all_time_top_of_totals(lake.state("all_time_totals"), 7)
    assert rows(yearly, "lang", "year", "curr_id", "clicks_year", "rn") == rows(I.top10_by_year(popularity), "lang", "year", "curr_id", "clicks_year", "rn")
    assert rows(ever, "lang", "curr_id", "clicks_all_time") == rows(I.all_time_top(popularity, 7), "lang", "curr_id", "clicks_all_time")
    assert [lake.insight(t).count() for t in ("top10_by_year", "all_time_top")] == [yearly.count(), ever.count()]
    columns = GOLD["article_top"].names
    assert rows(lake.gold("article_top"), *columns) == rows(G.article_top(popularity, 5), *columns)
    for ranked in (yearly, ever, G.article_top(popularity, 5, by_month=True)):
        plan = plan_of(ranked)
        assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_finding_nothing_to_do_runs_no_job(spark, lake, raw):
    lake.ingest(raw)
    lake.build_gold()
    spark.sparkContext.setJobGroup("nothing-to-do", "")
    try:
        assert lake.build_gold() == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("nothing-to-do")) == []


def test_profile_of_merged_months(spark, lake, raw):
    from clickweir.operators import quality

    for year, month in MONTHS[:2]:
        lake.ingest(raw.filter((F.col("year") == year) & (F.col("month") == month)))
        lake.build_gold()
        assert rows(lake.profile_languages()) == rows(quality.profile_languages(lake.silver()))


def test_a_table_is_not_replaced_by_its_own_rows(spark, lake, raw):
    lake.ingest(raw)
    path = fresh_dir(spark, "self")
    tables.create_table(spark, "self_test", SILVER, path)
    tables.replace_partitions(lake.silver(), "self_test")
    with pytest.raises(ValueError):
        tables.replace_partitions(spark.table("self_test").filter("lang = 'es'"), "self_test")


def test_month_folders_are_padded(spark, lake, raw):
    lake.ingest(raw)
    folders = files.hive_partitions(spark, lake.silver_path, ["lang", "year", "month"])
    assert ("es", "2024", "01") in folders
    assert lake.silver().schema["month"].dataType.simpleString() == "int"


def test_managed_table_replaces_only_its_partitions(spark, lake, raw):
    lake.ingest(raw)
    path = fresh_dir(spark, "table")
    tables.create_table(spark, "replace_test", SILVER, path)
    tables.create_table(spark, "replace_test", SILVER, path)
    tables.replace_partitions(lake.silver(), "replace_test")
    one = lake.silver().filter("lang = 'es' and month = 1").withColumn("n", F.lit(1))
    tables.replace_partitions(one, "replace_test")
    found = spark.table("replace_test")
    assert {r.n for r in found.filter("lang = 'es' and month = 1").collect()} == {1}
    others = "not (lang = 'es' and month = 1)"
    assert rows(found.filter(others), *SILVER.names) == rows(lake.silver().filter(others), *SILVER.names)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_catalog_table_and_views(spark, lake, raw):
    lake.ingest(raw)
    table = tables.refresh_table(spark, "refresh_test", SILVER, lake.silver_path)
    assert table.count() == lake.silver().count()
    lake.register_views()
    assert spark.sql("SELECT count(*) FROM clickstream_silver").first()[0] == table.count()
    assert spark.sql("SELECT * FROM gs_trending_mom").count() == 0


def test_large_partition_is_written_by_several_tasks(spark):
    """One language and month with nearly all rows, small ones beside it."""
    row = F.col("id")
    df = spark.range(400_000).select(
        F.when(row % 100 == 0, "en").otherwise("es").alias("lang"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.md5(row.cast("string")).alias("t"))
    path = fresh_dir(spark, "skewed")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        tables.write_partitions(df.repartition(16), path)
    finally:
        spark.conf.set(key, before)
    assert len(files.glob(spark, f"{path}/lang=es/*/*/part-*")) > 4
    assert len(files.glob(spark, f"{path}/lang=en/*/*/part-*")) < 4
    assert spark.read.parquet(path).count() == 400_000


def test_period_lists():
    periods = [("en", 2023, 12), ("es", 2023, 9), ("es", 2024, 1), ("es", 2024, 2)]
    assert increments.newest_periods(periods) == [("es", 2024, 2)]
    assert increments.newest_periods([]) == []
    assert increments.pick_periods(periods, year=2024, month=1) == [("es", 2024, 1)]
    assert layers.latest_window(periods, 5) == [("en", 2023, 12), ("es", 2024, 1), ("es", 2024, 2)]
    assert layers.latest_window(periods, 6) == periods


def test_listing_and_plan(spark):
    base = "http://h/other/clickstream"
    pages = spark.createDataFrame([
        (f"{base}/", '<a href="../">up</a><a href="2024-01/">1</a><a href="2024-02">2</a><a href="2024-03/">x</a><a href="2023-12/">x</a>'),
        (f"{base}/2024-01/", '<a href="clickstream-eswiki-2024-01.tsv.gz">f</a><a href="clickstream-eswiki-2024-01.tsv">g</a>'
                             '<a href="clickstream-eswiki-2023-11.tsv.gz">another month</a>'),
        (f"{base}/2024-02", '<a href="clickstream-enwiki-2024-02.tsv.gz">f</a><a href="clickstream-eswiki-2024-02.tsv.gz">f</a>'),
        (f"{base}/2023-12/", '<a href="clickstream-zh-min-nanwiki-2023-12.tsv.gz">f</a>'),
        (f"{base}/2024-03/", ""),
    ], "url string, html string")
    months = listing.listed_months(pages)
    assert rows(months) == [("2023-12",), ("2024-01",), ("2024-02",), ("2024-03",)]
    available = listing.listed_files(pages)
    assert rows(available, "site", "dump_month") == [
        ("enwiki", "2024-02"), ("eswiki", "2024-01"), ("eswiki", "2024-02"), ("zh-min-nanwiki", "2023-12")]
    none = available.limit(0)

    def plan(present=none, **options):
        return rows(listing.acquisition_plan(available, present, months, **options), "site", "dump_month")

    assert len(plan()) == len(plan(latest=0)) == 4
    assert plan(since="2024-02") == [("enwiki", "2024-02"), ("eswiki", "2024-02")]
    # the latest of the listed months has no file
    assert plan(latest=3) == [("enwiki", "2024-02"), ("eswiki", "2024-01"), ("eswiki", "2024-02")]
    assert plan(latest=2, sites=["eswiki"]) == [("eswiki", "2024-02")]
    assert plan(available.filter("site = 'eswiki'")) == [("enwiki", "2024-02"), ("zh-min-nanwiki", "2023-12")]
    one = listing.acquisition_plan(available, none, months, since="2024-02", sites=["eswiki"]).first()
    assert one["file_url"] == f"{base}/2024-02/clickstream-eswiki-2024-02.tsv.gz"
    assert one["target"] == "2024-02/clickstream-eswiki-2024-02.tsv.gz"


def test_shared_folder_and_shuffle_size(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shuffle_partitions(0) == 0
    assert shuffle_partitions(1 << 30) == 32
    assert shuffle_partitions(100 << 40) == 100 << 15


def session_without_folder(master):
    context = SimpleNamespace(master=master, applicationId=f"test-{master}")
    return SimpleNamespace(conf={}, sparkContext=context)


def test_only_local_sessions_get_a_temporary_folder():
    local = session_without_folder("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError):
        shared_dir(session_without_folder("yarn"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_limit_early(spark, lake, raw):
    from clickweir.operators import insights as I

    lake.ingest(raw)
    lake.build_gold()
    lake.build_insights()
    top = plan_of(G.article_top(lake.gold("article_popularity"), 20))
    assert top.count("WindowGroupLimit") == 2 and top.rindex("Partial") > top.rindex("Exchange hashpartitioning")
    # the cutoff is looked up in a broadcast frame, so only rows that pass it are shuffled
    assert top.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in top.split("Exchange hashpartitioning")[1]
    assert "dynamicpruning" in plan_of(I.window_pair_totals(lake.gold("edges_monthly")))
    yearly = plan_of(lake.insight("top10_by_year").filter("lang = 'es' and year = 2024"))
    assert "(lang" in yearly.split("PartitionFilters")[1].split("PushedFilters")[0]
    lake.register_views()
    asked = plan_of(spark.sql("SELECT * FROM top_of_year('es', 2024) WHERE rn < 3"))
    filters = asked.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "(lang" in filters and "(year" in filters
    both = spark.sql("SELECT l.lang, t.curr_title FROM VALUES ('es'), ('en') AS l(lang), LATERAL leader_of_each_year(l.lang) AS t")
    assert {r.lang for r in both.collect()} == {"en", "es"}
    assert "partial_max" in plan_of(lake.silver().groupBy("lang").agg(F.max("n")))
    assert "PushedFilters: [IsNotNull(n), GreaterThan(n,0)]" in plan_of(layers.read_positive(lake.silver()))
