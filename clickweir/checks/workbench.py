"""One lakehouse per session and input folder, built layer by layer on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.operators import cleaning, gold
from clickweir.operators import dictionary as ids
from clickweir.plans.lakehouse import Lakehouse
from clickweir.session import fresh_dir, stage, tune
from clickweir.checks.landing import land_dumps
from clickweir.sinks import tables
from clickweir.sources import files, layers
from clickweir.sources.star_schema import clicks_raw

# Thresholds and list lengths of the registered queries.
GOLD_OPTIONS = {"topn": 20, "topm": 2, "min_edges": 10, "min_referrers": 7}
INSIGHT_OPTIONS = {"topn_all_time": 20, "topm_referrers": 3, "topn_edges": 150, "topn_trending": 5}

_open: dict[tuple[str, str], "Workbench"] = {}


def workbench(spark: SparkSession, folder: str) -> "Workbench":
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _open:
        _open[key] = Workbench(tune(spark, files.total_bytes(spark, key[1])), key[1])
    return _open[key]


class Workbench:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.lake = Lakehouse(spark, fresh_dir(spark, "lake"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def raw(self) -> DataFrame:
        """Raw edges, computed afresh by every query that asks for them."""
        return clicks_raw(self.spark, self.folder)

    @cached_property
    def dumps(self) -> str:
        """Folder with all raw edges as compressed dump files."""
        root = fresh_dir(self.spark, "bronze")
        land_dumps(self.raw, root)
        return root

    @cached_property
    def lenient(self) -> DataFrame:
        return stage(cleaning.clean(self.raw, "lenient"), "lenient")

    @cached_property
    def silver(self) -> DataFrame:
        self.lake.ingest(self.raw)
        return self.lake.silver()

    def other_lake(self, with_silver: bool = True) -> Lakehouse:
        """A lakehouse of its own, with the same Silver or none."""
        lake = Lakehouse(self.spark, fresh_dir(self.spark, "lake"))
        if with_silver:
            tables.write_partitions(self.silver, lake.silver_path)
        return lake

    @cached_property
    def stats(self) -> DataFrame:
        return stage(ids.title_stats(layers.read_positive(self.silver)), "title-stats")

    @cached_property
    def dictionary(self) -> DataFrame:
        self.lake.extend_dictionary(self.stats)
        return self.lake.dictionary()

    @cached_property
    def hot(self) -> DataFrame:
        return stage(ids.hot_titles(self.stats, self.dictionary), "hot-titles")

    def encoded(self) -> DataFrame:
        return ids.encode_ids(layers.read_positive(self.silver), self.dictionary, self.hot)

    @cached_property
    def pairs(self) -> DataFrame:
        totals = gold.pair_totals(layers.read_positive(self.silver))
        return stage(ids.encode_ids(totals, self.dictionary, self.hot), "pair-totals")

    @cached_property
    def built(self) -> Lakehouse:
        """The lakehouse with Gold."""
        self.dictionary.schema  # Silver and the dictionary come first
        self.lake.build_gold(**GOLD_OPTIONS)
        return self.lake

    def gold(self, topic: str) -> DataFrame:
        return self.built.gold(topic)

    @cached_property
    def finished(self) -> Lakehouse:
        """The lakehouse with Gold and insights."""
        self.built.build_insights(**INSIGHT_OPTIONS)
        return self.built

    @cached_property
    def grown(self) -> Lakehouse:
        """A lakehouse whose insights grew in two steps."""
        lake = self.other_lake(with_silver=False)
        late = (F.col("year") * 12 + F.col("month")) > 1998 * 12 + 6
        for rows in (self.silver.filter(~late), self.silver.filter(late)):
            tables.write_partitions(rows, lake.silver_path)
            lake.build_gold(**GOLD_OPTIONS)
            lake.build_insights(**INSIGHT_OPTIONS, incremental=True)
        return lake

    @cached_property
    def views(self) -> bool:
        """Views and table functions of the finished lakehouse are registered."""
        self.finished.register_views()
        return True

    def insight(self, topic: str) -> DataFrame:
        return self.finished.insight(topic)

    # -- inputs of the acquisition and file-selection operators, derived from raw -----

    def period_keys(self) -> DataFrame:
        return self.raw.select("lang", "year", "month").distinct()

    def dump_paths(self) -> DataFrame:
        """Paths in every accepted and rejected form for each (lang, month)."""
        ym = F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM")
        named = F.concat(F.lit("clickstream-"), F.col("lang"), F.lit("wiki-"), ym)
        short = F.concat(F.lit("clickstream-"), F.col("lang"), F.lit("-"), ym)
        forms = [
            F.concat(F.lit("/bronze/"), ym, F.lit("/"), named, F.lit(".tsv.gz")),
            F.concat(F.lit("/bronze/misc/"), named, F.lit(".tsv")),
            F.concat(F.lit("/bronze/misc/"), short, F.lit(".tsv")),
            F.concat(F.lit("/bronze/bad-dir/"), named, F.lit(".tsv")),
            F.concat(F.lit("/bronze/"), ym, F.lit("/other-"), F.col("lang"), F.lit(".tsv")),
        ]
        return self.period_keys().select(F.explode(F.array(*forms)).alias("path"))

    def index_pages(self) -> DataFrame:
        """A page for each month, with its files, a file of the next month and month links.

        The next month's file doesn't belong there; some linked months have no page.
        """
        first = F.make_date("year", "month", F.lit(1))
        ym, later = F.date_format(first, "yyyy-MM"), F.date_format(F.add_months(first, 1), "yyyy-MM")

        def file(month) -> Column:
            return F.concat(F.lit('<a href="clickstream-'), F.col("lang"), F.lit("wiki-"), month, F.lit('.tsv.gz">dump</a>'))

        html = F.concat(
            F.lit('<a href="../">up</a><a href="'), ym, F.lit('/">month</a><a href="'), later, F.lit('">next</a>'),
            file(ym), file(later), F.lit('<a href="readme.html">notes</a>'),
        )
        return self.period_keys().select(F.concat(F.lit("http://dumps.example/"), ym, F.lit("/")).alias("url"), html.alias("html"))

    def present_files(self) -> DataFrame:
        """Dump files taken as already fetched: months with a count of 49 or more."""
        ym = F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM")
        name = F.concat(F.lit("clickstream-"), F.col("lang"), F.lit("wiki-"), ym, F.lit(".tsv.gz"))
        busy = self.silver.filter(F.col("n") >= 49).select("lang", "year", "month").distinct()
        return busy.select(ym.alias("dump_month"), name.alias("file"))
