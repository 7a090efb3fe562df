"""The registered queries: name -> (spark, folder) -> DataFrame.

Every query reads whole tables. Operators take the layer below them as written by the
earlier jobs, as they do in production.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.checks.landing import land_dumps
from clickweir.checks.workbench import GOLD_OPTIONS, INSIGHT_OPTIONS, Workbench, workbench
from clickweir.functions import periods as P
from clickweir.functions import titles as T
from clickweir.operators import analytics as N
from clickweir.operators import cleaning
from clickweir.operators import dictionary as ids
from clickweir.operators import gold as G
from clickweir.operators import insights as I
from clickweir.operators import quality as Q
from clickweir.plans import ingest
from clickweir.plans.lakehouse import Lakehouse
from clickweir.schemas import DICTIONARY, INSIGHTS, PERIOD, SILVER
from clickweir.session import fresh_dir, stage
from clickweir.sinks import tables
from clickweir.sources import bronze, layers, listing
from clickweir.streaming import increments

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Callable[[Workbench], DataFrame]] = {}


def _query(build: Callable[[Workbench], DataFrame]) -> Callable[[Workbench], DataFrame]:
    _registered[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    def bind(build: Callable[[Workbench], DataFrame]) -> Query:
        return lambda spark, folder: build(workbench(spark, folder))

    return {name: bind(build) for name, build in _registered.items()}


# -- sources ------------------------------------------------------------------------


@_query
def bronze_scan_strict(w: Workbench) -> DataFrame:
    return bronze.read_dumps(w.spark, w.dumps, one_file_per_partition=False)


@_query
def bronze_scan_lenient(w: Workbench) -> DataFrame:
    rows = bronze.read_dumps(w.spark, w.dumps, allow_name_form=False, one_file_per_partition=False)
    readable = rows.filter(cleaning.readable("lenient"))
    return readable.withColumn("n", F.col("n").try_cast("int"))


@_query
def bronze_manifest(w: Workbench) -> DataFrame:
    return bronze.with_partition(w.dump_paths())


@_query
def bronze_manifest_folder_form(w: Workbench) -> DataFrame:
    return bronze.with_partition(w.dump_paths(), allow_name_form=False)


@_query
def bronze_rejects(w: Workbench) -> DataFrame:
    return bronze.with_partition(w.dump_paths()).filter("not accepted").select("path")


@_query
def bronze_select_partitions(w: Workbench) -> DataFrame:
    accepted = bronze.with_partition(w.dump_paths()).filter("accepted").drop("accepted")
    return bronze.select_partitions(accepted, lang="eu", year=2000)


@_query
def bronze_first_files(w: Workbench) -> DataFrame:
    return bronze.first_files(w.dump_paths(), 25)


@_query
def bronze_last_file(w: Workbench) -> DataFrame:
    accepted = bronze.with_partition(w.dump_paths()).filter("accepted").drop("accepted")
    return bronze.last_file_per_partition(accepted)


@_query
def listing_links(w: Workbench) -> DataFrame:
    return listing.links(w.table("pages")).groupBy("href").agg(F.count("*").alias("uses"))


@_query
def listing_months(w: Workbench) -> DataFrame:
    return listing.listed_months(w.index_pages())


@_query
def listing_files(w: Workbench) -> DataFrame:
    return listing.listed_files(w.index_pages())


@_query
def acquisition_plan(w: Workbench) -> DataFrame:
    return listing.acquisition_plan(
        listing.listed_files(w.index_pages()),
        w.present_files(),
        listing.listed_months(w.index_pages()),
        since="1996-07",
        latest=40,
        sites=["euwiki", "afwiki", "amwiki"],
    )


@_query
def silver_table_scan(w: Workbench) -> DataFrame:
    return w.silver


@_query
def silver_partition_scan(w: Workbench) -> DataFrame:
    return layers.read_positive(bronze.select_partitions(w.silver, lang="eu", year=2000))


@_query
def language_list(w: Workbench) -> DataFrame:
    return w.built.languages()


# -- cleaning -----------------------------------------------------------------------


@_query
def silver_strict(w: Workbench) -> DataFrame:
    return cleaning.clean(w.raw, "strict")


@_query
def silver_lenient(w: Workbench) -> DataFrame:
    return cleaning.clean(w.raw, "lenient")


@_query
def silver_from_dumps(w: Workbench) -> DataFrame:
    return cleaning.clean(bronze_scan_strict(w), "strict")


@_query
def silver_dedup_max(w: Workbench) -> DataFrame:
    return cleaning.keep_largest(w.lenient)


@_query
def qc_counts_strict(w: Workbench) -> DataFrame:
    return Q.cleaning_counts(w.raw, "strict")


@_query
def qc_counts_lenient(w: Workbench) -> DataFrame:
    return Q.cleaning_counts(w.raw, "lenient")


@_query
def partition_row_counts(w: Workbench) -> DataFrame:
    return Q.partition_counts(w.silver)


@_query
def profile_lang(w: Workbench) -> DataFrame:
    return Q.profile_languages(w.silver)


@_query
def profile_lang_merged(w: Workbench) -> DataFrame:
    """The profile from states of single months, half of them added later."""
    lake = w.other_lake(with_silver=False)
    tables.write_partitions(w.silver.filter("year < 1997"), lake.silver_path)
    lake.build_gold()
    lake.profile_languages()
    tables.write_partitions(w.silver.filter("year >= 1997"), lake.silver_path)
    lake.build_gold()
    return lake.profile_languages()


@_query
def profile_range(w: Workbench) -> DataFrame:
    return Q.profile_range(w.silver)


@_query
def profile_type(w: Workbench) -> DataFrame:
    return Q.profile_types(w.silver)


@_query
def profile_top_global(w: Workbench) -> DataFrame:
    return Q.profile_top_titles(w.silver)


@_query
def title_functions(w: Workbench) -> DataFrame:
    """Every raw title and type with its normal form and the outcome of each rule."""
    return w.raw.select("curr", "type").distinct().select(
        "curr",
        "type",
        T.normalise_title(F.col("curr")).alias("title"),
        T.normalise_type(F.concat(F.lit(" "), F.upper("type"), F.lit(" "))).alias("kind"),
        T.is_noise(F.col("curr")).alias("is_noise"),
        (F.length("curr") > 0).alias("has_title"),
        F.col("type").isin(T.REFERRAL_TYPES).alias("known_type"),
    )


@_query
def period_functions(w: Workbench) -> DataFrame:
    """Month arithmetic on every month that occurs."""
    return w.period_keys().select(
        "lang", "year", "month",
        P.month_text().alias("month_text"),
        P.month_index().alias("month_index"),
        P.index_year(P.month_index() - 5).alias("from_year"),
        P.index_month(P.month_index() - 5).alias("from_month"),
        F.date_format(F.add_months(P.month_start(), 1), "yyyy-MM-dd").alias("next_start"),
        P.partition_key().alias("partition_key"),
    )


# -- sinks --------------------------------------------------------------------------


def _last_year(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") >= 2000)


def _one_year(df: DataFrame) -> DataFrame:
    return df.filter((F.col("lang") == "eu") & (F.col("year") == 2000) & (F.col("month") <= 3))


@_query
def partition_replace(w: Workbench) -> DataFrame:
    """Strict Silver in a managed table, its months from 2000 on replaced by lenient rows."""
    path = fresh_dir(w.spark, "replace")
    name = "replace_" + path.rsplit("-", 1)[1]
    tables.create_table(w.spark, name, SILVER, path)
    tables.replace_partitions(w.silver, name)
    tables.replace_partitions(_last_year(w.lenient), name)
    return w.spark.table(name).select(*SILVER.names)


@_query
def partition_overwrite(w: Workbench) -> DataFrame:
    """The same replacement on a plain partitioned path."""
    path = fresh_dir(w.spark, "overwrite")
    tables.write_partitions(w.silver, path)
    tables.write_partitions(_last_year(w.lenient), path)
    return layers.read_layer(w.spark, path, SILVER)


@_query
def skip_existing(w: Workbench) -> DataFrame:
    """Lenient months from 2000 on are kept; all other months are added from strict rows."""
    path = fresh_dir(w.spark, "skip")
    tables.write_partitions(_last_year(w.lenient), path)
    tables.write_missing(w.silver, path)
    return layers.read_layer(w.spark, path, SILVER)


@_query
def partition_export(w: Workbench) -> DataFrame:
    path = fresh_dir(w.spark, "export")
    tables.export_partitions(w.silver, path, (F.col("lang") == "eu") & (F.col("year") == 2000))
    return layers.read_layer(w.spark, path, SILVER)


@_query
def pending_partitions(w: Workbench) -> DataFrame:
    """Silver months still to do when an output holds only one language and year."""
    path = fresh_dir(w.spark, "partial")
    tables.export_partitions(w.silver, path, (F.col("lang") == "eu") & (F.col("year") == 2000))
    return increments.pending_periods(w.silver, [layers.read_layer(w.spark, path, SILVER)])


@_query
def silver_reingest_noise_only(w: Workbench) -> DataFrame:
    """Months from 2000 on come again with noise titles only, which empties them."""
    lake = w.other_lake()
    lake.ingest(_last_year(w.raw).withColumn("curr", F.lit("Special:Noise")))
    return lake.silver()


@_query
def ingest_split_dumps(w: Workbench) -> DataFrame:
    """Every partition's dump in several numbered files, all of which count."""
    root, lake = fresh_dir(w.spark, "split"), w.other_lake(with_silver=False)
    land_dumps(w.raw, root, parts=3)
    lake.ingest_dumps(root)
    return lake.silver()


@_query
def ingest_last_file_empty(w: Workbench) -> DataFrame:
    """Later dumps without a readable row do not take the place of earlier ones."""
    root, lake = fresh_dir(w.spark, "late"), w.other_lake(with_silver=False)
    land_dumps(w.raw, root)
    land_dumps(_last_year(w.raw).withColumn("n", F.lit("0")), f"{root}/zz")
    lake.ingest_dumps(root)
    return lake.silver()


@_query
def ingest_lenient(w: Workbench) -> DataFrame:
    lake = w.other_lake(with_silver=False)
    lake.ingest_dumps(w.dumps, profile="lenient")
    return lake.silver()


@_query
def ingest_header_rows(w: Workbench) -> DataFrame:
    """Every dump has a header line that only its title gives away."""
    root, lake = fresh_dir(w.spark, "headers"), w.other_lake(with_silver=False)
    header = w.period_keys().select(
        *PERIOD, F.lit("prev_id").alias("prev"), F.lit("curr_id").alias("curr"), F.lit("link").alias("type"), F.lit("7").alias("n"),
    )
    land_dumps(w.raw.unionByName(header), root)
    lake.ingest_dumps(root, profile="lenient")
    return lake.silver()


@_query
def ingest_report(w: Workbench) -> DataFrame:
    """Rows read, kept and filtered per partition, as the ingest of the dumps has recorded them."""
    lake = w.other_lake(with_silver=False)
    lake.ingest_dumps(w.dumps)
    return ingest.partition_counts(lake.ingest_log())


@_query
def ingest_truncated_file(w: Workbench) -> DataFrame:
    """Later dumps of a language and year break off; the earlier dumps of their months stand in."""
    root, lake = fresh_dir(w.spark, "cut"), w.other_lake(with_silver=False)
    land_dumps(w.raw, root)
    land_dumps(_one_year(w.raw).withColumn("n", F.lit("7")), f"{root}/zz", cut=True)
    lake.ingest_dumps(root)
    return lake.silver()


@_query
def ingest_file_log(w: Workbench) -> DataFrame:
    """What becomes of intact, superseded, damaged and misnamed dump files: how many, with how many rows."""
    root, lake = fresh_dir(w.spark, "log"), w.other_lake(with_silver=False)
    land_dumps(w.raw, root)
    land_dumps(_last_year(w.raw), f"{root}/aa")
    land_dumps(_one_year(w.raw), f"{root}/zz", cut=True)
    lake.ingest_dumps(root)
    return lake.ingest_log().groupBy("state").agg(
        F.count_distinct("uri").alias("dumps"), F.sum("rows_read").alias("rows_read"), F.sum("rows_clean").alias("rows_clean"),
    )


@_query
def stream_ingest(w: Workbench) -> DataFrame:
    """Dumps up to 1999 first, those from 2000 on and later dumps of 1999 by a second run."""
    root, lake = fresh_dir(w.spark, "stream"), w.other_lake(with_silver=False)
    old = w.raw.filter("year < 2000")
    land_dumps(old.withColumn("n", F.when(F.col("year") == 1999, "1").otherwise(F.col("n"))), f"{root}/aa")
    lake.stream_dumps(root, files_at_once=100)
    land_dumps(_last_year(w.raw), f"{root}/aa")
    land_dumps(w.raw.filter("year = 1999"), f"{root}/bb")
    lake.stream_dumps(root, files_at_once=100)
    lake.stream_dumps(root)
    return lake.silver()


@_query
def catalog_refresh(w: Workbench) -> DataFrame:
    w.silver.schema  # written before the table is made
    name = "silver_" + w.lake.root.rsplit("-", 1)[1]
    table = tables.refresh_table(w.spark, name, SILVER, w.lake.silver_path)
    return Q.partition_counts(table)


@_query
def catalog_views(w: Workbench) -> DataFrame:
    """SQL text with parameters over the registered insight views."""
    w.finished.register_views()
    return w.spark.sql(
        "SELECT t.lang, t.year, t.curr_title, t.clicks_year, a.clicks_all_time "
        "FROM gs_top10_by_year t JOIN gs_all_time_top a USING (lang, curr_title) "
        "WHERE t.rn <= :places",
        args={"places": 5},
    )


# -- dictionary ---------------------------------------------------------------------


@_query
def title_statistics(w: Workbench) -> DataFrame:
    return ids.title_stats(layers.read_positive(w.silver))


@_query
def dictionary_backfill(w: Workbench) -> DataFrame:
    return ids.backfill(w.stats)


@_query
def dictionary_increment(w: Workbench) -> DataFrame:
    """Months from 1998 on first, the older ones late: early ids must not move."""
    silver = layers.read_positive(w.silver)
    path = fresh_dir(w.spark, "increment")
    first = ids.backfill(ids.title_stats(silver.filter(F.col("year") >= 1998)))
    tables.write_partitions(first, path, ["lang"])
    known = layers.read_layer(w.spark, path, DICTIONARY)
    late = stage(ids.title_stats(silver.filter(F.col("year") < 1998)), "late-stats")
    added = ids.number_titles(ids.match_titles(late, known).filter("id is null"), known)
    return known.unionByName(added)


@_query
def new_titles(w: Workbench) -> DataFrame:
    """Titles of the lenient Silver that the dictionary does not hold."""
    matched = ids.match_titles(ids.title_stats(w.lenient), w.dictionary)
    return matched.filter("id is null").select("lang", "title")


@_query
def largest_ids(w: Workbench) -> DataFrame:
    return ids.largest_ids(w.dictionary)


@_query
def hot_titles(w: Workbench) -> DataFrame:
    return ids.hot_titles(w.stats, w.dictionary, limit=512)


@_query
def encode_ids(w: Workbench) -> DataFrame:
    return w.encoded()


@_query
def encode_ids_cold(w: Workbench) -> DataFrame:
    """Every id from the shuffled lookup."""
    return ids.encode_ids(layers.read_positive(w.silver), w.dictionary)


@_query
def encode_ids_mixed(w: Workbench) -> DataFrame:
    """A few hot titles answered by broadcast, all others by the shuffled lookup."""
    hot = stage(ids.hot_titles(w.stats, w.dictionary, limit=512), "hot-titles")
    return ids.encode_ids(layers.read_positive(w.silver), w.dictionary, hot)


@_query
def encode_ids_foreign(w: Workbench) -> DataFrame:
    """Rows without a referrer or with unknown titles, as another writer might leave them."""
    rows = w.raw.select(
        *PERIOD,
        F.replace("prev", F.lit("_"), F.lit(" ")).alias("prev_title"),
        F.replace("curr", F.lit("_"), F.lit(" ")).alias("curr_title"),
        F.col("n").try_cast("long").alias("n"),
    ).filter("n > 0")
    numbered = stage(rows.withColumn("row_no", F.monotonically_increasing_id()), "foreign")
    return ids.encode_ids(numbered, w.dictionary, w.hot, row_no="row_no")


@_query
def referrers_top_foreign(w: Workbench) -> DataFrame:
    """Unknown referrers take no place among the strongest."""
    return G.referrers_top(G.pair_totals(encode_ids_foreign(w)), 2, 7)


@_query
def edges_monthly_foreign(w: Workbench) -> DataFrame:
    return G.edges_monthly(G.pair_totals(encode_ids_foreign(w)), 10)


@_query
def decode_ids(w: Workbench) -> DataFrame:
    popularity = w.gold("article_popularity")
    return ids.decode_ids(popularity, w.dictionary, ids.hot_ids(popularity, w.dictionary))


@_query
def decode_ids_cold(w: Workbench) -> DataFrame:
    """Both titles from the shuffled lookup."""
    return ids.decode_ids(w.gold("edges_monthly"), w.dictionary)


@_query
def decode_ids_mixed(w: Workbench) -> DataFrame:
    edges = w.gold("edges_monthly")
    return ids.decode_ids(edges, w.dictionary, ids.hot_ids(edges, w.dictionary, limit=512))


# -- Gold ---------------------------------------------------------------------------


@_query
def pair_totals(w: Workbench) -> DataFrame:
    return G.pair_totals(w.encoded())


@_query
def article_popularity(w: Workbench) -> DataFrame:
    return G.article_popularity(w.pairs)


@_query
def article_top(w: Workbench) -> DataFrame:
    return w.gold("article_top")


@_query
def referrers_top(w: Workbench) -> DataFrame:
    return w.gold("referrers_top")


@_query
def edges_monthly(w: Workbench) -> DataFrame:
    return w.gold("edges_monthly")


@_query
def latest_month_only(w: Workbench) -> DataFrame:
    """Silver of the latest month found in any language, as the Gold job selects it."""
    w.silver.schema  # written before its folders are listed
    path = w.lake.silver_path
    newest = increments.newest_periods(layers.list_periods(w.spark, path))
    return layers.read_periods(w.spark, path, SILVER, newest)


@_query
def gold_latest_month(w: Workbench) -> DataFrame:
    """Popularity of the latest month only, from a build without edges and referrers."""
    lake = w.other_lake()
    lake.build_gold(latest_month=True, edges=False, referrers=False)
    popularity = lake.gold("article_popularity").unionByName(
        # tables that were not asked for have no rows
        lake.gold("edges_monthly").select(*PERIOD, "curr_id", F.col("total_transitions").alias("total_clicks"))
    )
    return ids.decode_ids(popularity, lake.dictionary())


@_query
def gold_rebuilt_higher_threshold(w: Workbench) -> DataFrame:
    """A second build with a higher threshold leaves nothing of the first one behind."""
    lake = w.other_lake()
    lake.build_gold(**GOLD_OPTIONS)
    lake.build_gold(skip_existing=False, **GOLD_OPTIONS | {"min_edges": 40})
    return lake.gold("edges_monthly")


class _Failing(Lakehouse):
    """Stops between the writes of a build."""

    def _write_version(self, log, rows, topic, *rest):
        if topic == "edges_monthly":
            raise RuntimeError("stopped")
        return super()._write_version(log, rows, topic, *rest)


@_query
def gold_after_failed_rebuild(w: Workbench) -> DataFrame:
    """A rebuild that stops between two tables leaves readers on the old version of all."""
    lake = w.other_lake()
    lake.build_gold(**GOLD_OPTIONS)
    with suppress(RuntimeError):
        _Failing(w.spark, lake.root).build_gold(skip_existing=False, **GOLD_OPTIONS | {"topn": 3, "topm": 1})
    return lake.gold("referrers_top")


@_query
def insights_rebuilt_empty(w: Workbench) -> DataFrame:
    """Rows of each insight after Gold has lost all its edges: nothing old is left of the windows."""
    lake = w.other_lake()
    lake.build_gold(**GOLD_OPTIONS)
    lake.build_insights(**INSIGHT_OPTIONS)
    lake.build_gold(skip_existing=False, **GOLD_OPTIONS | {"min_edges": 10**9})
    lake.build_insights(skip_existing=False, **INSIGHT_OPTIONS)
    counts = [lake.insight(t).agg(F.count("*").alias("row_count")).select(F.lit(t).alias("topic"), "row_count") for t in INSIGHTS]
    return reduce(DataFrame.unionAll, counts)


# -- insights -----------------------------------------------------------------------


@_query
def latest_period(w: Workbench) -> DataFrame:
    return I.latest_period(w.gold("article_popularity"))


@_query
def window_periods(w: Workbench) -> DataFrame:
    latest = I.latest_period(w.gold("edges_monthly"))
    return I.window_periods(latest, 6).drop("_last")


@_query
def years_listed(w: Workbench) -> DataFrame:
    return w.gold("article_popularity").select("lang", "year").distinct()


@_query
def top10_by_year(w: Workbench) -> DataFrame:
    return w.insight("top10_by_year")


@_query
def top10_by_year_ids(w: Workbench) -> DataFrame:
    """Without a dictionary the title column shows the id."""
    return I.with_titles(I.top10_by_year(w.gold("article_popularity")))


@_query
def top10_by_year_incremental(w: Workbench) -> DataFrame:
    """Months up to June 1998 first; the later ones are added to the totals."""
    return w.grown.insight("top10_by_year")


@_query
def all_time_top_incremental(w: Workbench) -> DataFrame:
    return w.grown.insight("all_time_top")


@_query
def all_time_top(w: Workbench) -> DataFrame:
    return w.insight("all_time_top")


@_query
def edges_6m(w: Workbench) -> DataFrame:
    return w.insight("edges_6m")


@_query
def trending_mom(w: Workbench) -> DataFrame:
    return w.insight("trending_mom")


@_query
def referrers_6m(w: Workbench) -> DataFrame:
    return w.insight("referrers_6m")


# -- queries on the insight tables ----------------------------------------------------


@_query
def n01_top_of_year(w: Workbench) -> DataFrame:
    return N.top_of_year(w.insight("top10_by_year"), "eu", 2000)


@_query
def n02_top_of_years(w: Workbench) -> DataFrame:
    return N.top_of_years(w.insight("top10_by_year"), "eu", [1999, 2000])


@_query
def n03_all_time(w: Workbench) -> DataFrame:
    return N.all_time_leaders(w.insight("all_time_top"), "eu")


@_query
def n04_compare_languages(w: Workbench) -> DataFrame:
    return N.compare_languages(w.insight("top10_by_year"), ["eu", "as", "af"], 2000)


@_query
def n05_new_in_top(w: Workbench) -> DataFrame:
    return N.new_in_top(w.insight("top10_by_year"), "eu", 2000, 1999)


@_query
def n06_fastest_growth(w: Workbench) -> DataFrame:
    return N.fastest_growth(w.insight("trending_mom"), "mi")


@_query
def n07_most_years(w: Workbench) -> DataFrame:
    return N.most_years_in_top(w.insight("top10_by_year"), "eu")


@_query
def n08_popular_in_both(w: Workbench) -> DataFrame:
    return N.popular_in_both(w.insight("top10_by_year"), "eu", "as", 2000)


@_query
def n09_leaders(w: Workbench) -> DataFrame:
    return N.leader_of_each_year(w.insight("top10_by_year"), "eu")


@_query
def n10_comebacks(w: Workbench) -> DataFrame:
    return N.comebacks(w.insight("top10_by_year"), "eu")


@_query
def n11_leader_margin(w: Workbench) -> DataFrame:
    return N.leader_margin(w.insight("top10_by_year"), "eu", 2000)


# -- the same as SQL text with arguments -----------------------------------------------


def _sql(w: Workbench, text: str) -> DataFrame:
    assert w.views
    return w.spark.sql(text)


@_query
def n01_top_of_year_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM top_of_year('eu', 2000)")


@_query
def n02_top_of_years_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM top_of_years('eu', array(1999, 2000))")


@_query
def n03_all_time_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM all_time_leaders('eu')")


@_query
def n04_compare_languages_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM compare_languages(array('eu', 'as', 'af'), 2000)")


@_query
def n05_new_in_top_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM new_in_top('eu', 2000, 1999)")


@_query
def n06_fastest_growth_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM fastest_growth('mi')")


@_query
def n07_most_years_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM most_years_in_top('eu')")


@_query
def n08_popular_in_both_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM popular_in_both('eu', 'as', 2000)")


@_query
def n09_leaders_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM leader_of_each_year('eu')")


@_query
def n10_comebacks_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM comebacks('eu')")


@_query
def n11_leader_margin_sql(w: Workbench) -> DataFrame:
    return _sql(w, "SELECT * FROM leader_margin('eu', 2000)")
