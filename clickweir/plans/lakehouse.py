"""The lakehouse: layer paths and the jobs that move data from layer to layer.

Each job is a few Spark jobs over all selected partitions at once. Whatever several
outputs share is written once to the shared folder and read back.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import dictionary as ids
from clickweir.operators import gold as G
from clickweir.operators import insights as I
from clickweir.operators import quality
from clickweir.operators.cleaning import clean, readable
from clickweir.plans import ingest, sql_queries
from clickweir.schemas import PERIOD
from clickweir.session import scratch, stage, tuned
from clickweir.sinks import tables
from clickweir.sinks.commits import CommitLog, new_token
from clickweir.sources import bronze, files, layers
from clickweir.streaming import increments


def _together(jobs: list[Callable[[], None]]) -> None:
    """Submit independent writes at once, so one's tail overlaps another's start."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        # each job sees the caller's scratch list
        for done in [pool.submit(copy_context().run, job) for job in jobs]:
            done.result()


class Lakehouse:
    """Layered tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- paths and readers -------------------------------------------------------

    @property
    def ingest_path(self) -> str:
        return f"{self.root}/_ingests"

    @property
    def silver_path(self) -> str:
        return f"{self.root}/silver"

    @property
    def dictionary_path(self) -> str:
        return f"{self.root}/gold/dimensions/articles"

    def gold_path(self, topic: str) -> str:
        return f"{self.root}/gold/{topic}"

    def insight_path(self, topic: str) -> str:
        return f"{self.root}/insights/{topic}"

    def silver(self) -> DataFrame:
        return layers.read_layer(self.spark, self.silver_path, schemas.SILVER)

    def dictionary(self) -> DataFrame:
        return layers.read_layer(self.spark, self.dictionary_path, schemas.DICTIONARY)

    def gold(self, topic: str) -> DataFrame:
        """The last published version of a Gold table."""
        return self.gold_log.read(topic, schemas.GOLD[topic], PERIOD)

    def insight(self, topic: str) -> DataFrame:
        """The last published version of an insight table."""
        return self.insight_log.read(topic, schemas.INSIGHTS[topic], schemas.INSIGHT_PARTITIONS[topic])

    @property
    def gold_log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/gold")

    @property
    def insight_log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/insights")

    @property
    def state_log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/state")

    def state(self, topic: str, keys: list[tuple] | None = None) -> DataFrame:
        """The last published version of a table that grows by month."""
        return self.state_log.read(topic, schemas.STATES[topic], schemas.STATE_PARTITIONS[topic], keys)

    def vacuum(self) -> None:
        """Remove the versions of Gold and insight tables that are no longer read."""
        self.gold_log.vacuum({topic: PERIOD for topic in schemas.GOLD})
        self.insight_log.vacuum(schemas.INSIGHT_PARTITIONS)
        self.state_log.vacuum(schemas.STATE_PARTITIONS)

    def languages(self) -> DataFrame:
        """Languages with popularity or edges."""
        return layers.list_languages(self.gold("article_popularity"), self.gold("edges_monthly"))

    # -- Bronze -> Silver --------------------------------------------------------

    def ingest_dumps(
        self, folder: str, profile: str = "strict", skip_existing: bool = False, **selection
    ) -> dict[str, object]:
        """Clean the dump files below ``folder`` into Silver; returns a report.

        ``selection`` is lang, year, month and limit. The strict profile also takes the
        month from a file name, the lenient one only from the folder. Files of finished
        partitions are not opened.

        Every file is decoded once, into staged rows and a record of its counts. Of several
        dumps of a partition the last complete one with a readable row counts; a file that
        cannot be decoded takes its dump out and doesn't stop the others, while any other
        error ends the job. The records are kept, see ``ingest_log``. The report has
        ``partitions`` (lang, year, month, rows read, clean and filtered), their totals
        ``rows_read`` and ``rows_clean``, and the paths that were ``rejected`` by name,
        ``superseded`` and ``unreadable``.
        """
        done = layers.list_periods(self.spark, self.silver_path) if skip_existing else None
        with tuned(self.spark, files.total_bytes(self.spark, folder)), scratch(self.spark):
            found = bronze.inspect_files(
                self.spark, folder, allow_name_form=profile == "strict", done=done, **selection
            )
            return self._ingest_files(found, profile, uuid.uuid4().hex)

    def _ingest_files(
        self, found: list[Row], profile: str, label: str, taken: dict[tuple, str] | None = None
    ) -> dict[str, object]:
        """Stage, choose, write, record. ``taken``: the dumps that partitions hold already."""
        accepted, rejected = [f for f in found if f.accepted], [f for f in found if not f.accepted]
        staged, records = ingest.stage_files(self.spark, accepted, profile)
        best = ingest.choose(records, taken)
        new = {r.file.dump for r in records if best.get((r.file.lang, r.file.year, r.file.month)) == r.file.dump}
        periods = sorted({(r.file.lang, r.file.year, r.file.month) for r in records if r.file.dump in new})
        if periods:
            rows = ingest.silver_rows(staged, records, new, profile)
            tables.write_partitions(rows, self.silver_path, sort_by=("curr_title",), handled=periods)
        if found:
            log = ingest.file_log(self.spark, records, rejected, new, best)
            log.coalesce(1).write.mode("overwrite").parquet(f"{self.ingest_path}/ingest={label}")
        totals = {p: [0, 0] for p in periods}
        for r in records:
            if r.file.dump in new:
                here = totals[r.file.lang, r.file.year, r.file.month]
                here[0], here[1] = here[0] + r.rows_read, here[1] + r.rows_clean
        return {
            "rows_read": sum(read for read, _ in totals.values()),
            "rows_clean": sum(kept for _, kept in totals.values()),
            "partitions": [(*p, read, kept, read - kept) for p, (read, kept) in totals.items()],
            "rejected": [f.path for f in rejected],
            "superseded": [
                r.file.path for r in records
                if r.complete and best.get((r.file.lang, r.file.year, r.file.month), r.file.dump) != r.file.dump
            ],
            "unreadable": [r.file.path for r in records if not r.complete],
        }

    def ingest_log(self) -> DataFrame:
        """What became of every dump file that an ingest has seen, with its counts of rows."""
        if not files.glob(self.spark, f"{self.ingest_path}/ingest=*"):
            return ingest.file_log(self.spark, [], [], set(), {}).withColumn("ingest", F.lit(""))
        return self.spark.read.option("basePath", self.ingest_path).parquet(f"{self.ingest_path}/ingest=*")

    def stream_dumps(
        self, folder: str, profile: str = "strict", pattern: str = "*.tsv.gz", files_at_once: int = bronze.BATCH_FILES
    ) -> None:
        """Take in the dump files below ``folder`` that no earlier call has read, then stop.

        A streaming query finds them: its checkpoint, beside Silver, remembers all files that
        it has listed, and hands out a bounded number of new ones at a time. Only their names
        flow through it; content is read by the ingest of each batch. A late dump replaces the
        one that its partition holds if it comes later in path order, and a late part of a
        dump brings the dump's earlier parts with it. A batch that is repeated after a crash
        writes the same partitions and the same records again.
        """
        listed = (
            self.spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_at_once)
            .load(folder).select("path", F.col("_metadata.file_path").alias("uri"))
        )

        def take(batch: DataFrame, number: int) -> None:
            label = f"stream-{number}"
            named = bronze.with_dump(bronze.with_partition(batch, allow_name_form=profile == "strict"))
            found = named.orderBy("path").collect()
            before = self.ingest_log().filter((F.col("ingest") != label) & (F.col("state") != "rejected"))
            held = {
                (r.lang, r.year, r.month): r.dump
                for r in before.filter("state = 'taken'").groupBy(*PERIOD).agg(F.max("dump").alias("dump")).collect()
            }
            dumps = sorted({f.dump for f in found if f.accepted})
            parts = before.filter(F.col("dump").isin(dumps)).select("path", "uri").distinct()
            parts = bronze.with_dump(bronze.with_partition(parts, allow_name_form=profile == "strict"))
            have = {f.path for f in found}
            found += [f for f in parts.collect() if f.path not in have]
            with tuned(self.spark), scratch(self.spark):
                self._ingest_files(found, profile, label, held)

        query = (
            listed.writeStream.foreachBatch(take).trigger(availableNow=True)
            .option("checkpointLocation", f"{self.root}/_stream").start()
        )
        query.awaitTermination()

    def ingest(self, rows: DataFrame, profile: str = "strict", skip_existing: bool = False) -> None:
        """Clean raw edges into Silver, replacing the partitions they belong to.

        A partition without a readable row is left alone; one whose readable rows are all
        noise becomes empty. ``skip_existing`` leaves finished partitions out before anything
        is shuffled.
        """
        with tuned(self.spark):
            if skip_existing:
                done = layers.list_periods(self.spark, self.silver_path)
                rows = tables.without_existing(rows, layers.periods_frame(self.spark, done))
            # The pass that writes also notes the partitions with readable rows. A set does
            # not change if a task is run again.
            seen = Observation()
            period = F.when(readable(profile), F.struct(*PERIOD))
            watched = rows.observe(seen, F.collect_set(period).alias("periods"))

            def handled() -> list[increments.Period]:
                try:
                    found = seen.get["periods"]
                except Py4JJavaError:
                    # The planner saw that no row can be kept, and so read none.
                    found = rows.filter(readable(profile)).select(*PERIOD).distinct().collect()
                return [tuple(p) for p in found]

            tables.write_partitions(clean(watched, profile), self.silver_path, sort_by=("curr_title",), handled=handled)

    # -- Silver -> Gold ----------------------------------------------------------

    def build_gold(
        self,
        lang: str | None = None,
        year: int | None = None,
        month: int | None = None,
        latest_month: bool = False,
        skip_existing: bool = True,
        topn: int = 1000,
        topm: int = 50,
        min_edges: int = 1,
        min_referrers: int = 1,
        edges: bool = True,
        referrers: bool = True,
    ) -> list[tuple[str, int, int]]:
        """Extend the dictionary and write the Gold tables; returns the months done.

        The dictionary is appended to before anything is written with its ids. A crash
        in between leaves it ahead of the tables, which is harmless: a rerun finds the
        titles present. The tables are written as a new version and published together.
        """
        topics = ["article_popularity", "article_top"]
        topics += ["referrers_top"] if referrers else []
        topics += ["edges_monthly"] if edges else []
        periods = layers.list_periods(self.spark, self.silver_path)
        if skip_existing:
            periods = increments.periods_to_do(periods, [self.gold_log.partitions(t) for t in topics])
        periods = increments.pick_periods(periods, lang, year, month)
        if latest_month:
            every = layers.list_periods(self.spark, self.silver_path)
            newest = increments.newest_periods(increments.pick_periods(every, lang, year, month))
            periods = [p for p in periods if p in set(newest)]
        if not periods:
            return []

        with tuned(self.spark, files.total_bytes(self.spark, self.silver_path)), scratch(self.spark):
            self._build_gold(periods, topics, topn, topm, min_edges, min_referrers)
        return periods

    def _build_gold(
        self, periods: list[increments.Period], topics: list[str], topn: int, topm: int, min_edges: int, min_referrers: int
    ) -> None:
        silver = layers.read_positive(
            layers.read_periods(self.spark, self.silver_path, schemas.SILVER, periods)
        )
        stats = stage(ids.title_stats(silver), "title-stats")
        entries = self.extend_dictionary(stats, sorted({p[0] for p in periods}))
        hot = stage(ids.hot_titles(stats, entries), "hot-titles")
        # Summed by title first: the lookups then see each pair once, however many rows
        # or copies of rows it had. Titles and ids correspond, so the totals stay apart.
        pairs = stage(ids.encode_ids(G.pair_totals(silver), entries, hot), "pair-totals")

        token, changes = new_token(), {}

        def write(topic: str, rows: DataFrame) -> None:
            changes[topic] = self._write_version(self.gold_log, rows, topic, PERIOD, token, periods, ("curr_id",))

        def popularity_and_top() -> None:
            write("article_popularity", G.article_popularity(pairs))
            written = self.gold_log.read_version("article_popularity", schemas.GOLD["article_popularity"], PERIOD, token)
            write("article_top", G.article_top(written, topn, by_month=True))

        jobs = [popularity_and_top]
        if "referrers_top" in topics:
            jobs.append(lambda: write("referrers_top", G.referrers_top(pairs, topm, min_referrers)))
        if "edges_monthly" in topics:
            jobs.append(lambda: write("edges_monthly", G.edges_monthly(pairs, min_edges)))
        _together(jobs)
        self.gold_log.publish(changes)

    def _write_version(
        self, log: CommitLog, rows: DataFrame, topic: str, by: list[str], token: str, handled: list[tuple], sort_by: tuple[str, ...]
    ) -> dict[tuple, str | None]:
        return log.write(rows, topic, by, token, handled, sort_by)

    def extend_dictionary(self, stats: DataFrame, languages: list[str] | None = None) -> DataFrame:
        """Append the titles of ``stats`` that the dictionary lacks, with new ids.

        Returns the dictionary rows of exactly those titles. The whole dictionary is
        read once, here, and a sieve of the titles at hand keeps most of it out of the
        join; encoding then works with the rows it needs. ``languages``
        names those that occur in ``stats``, so that no others are read.
        """
        known = self.dictionary()
        if languages is not None:
            known = known.filter(F.col("lang").isin(languages))
        if files.hive_partitions(self.spark, self.dictionary_path, ["lang"]):
            likely = ids.sifted(known, stats, ["lang", "title"])
            matched = stage(ids.match_titles(stats, likely), "matched-titles")
            unseen = matched.filter(F.col("id").isNull())
            found = matched.filter(F.col("id").isNotNull()).select(*schemas.DICTIONARY.names)
            fresh = ids.number_titles(unseen, known)
        else:
            fresh, found = ids.backfill(stats), None
        # Written once before the append: numbering reads the folder that then grows.
        fresh = stage(fresh, "new-titles")
        tables.write_partitions(fresh, self.dictionary_path, ["lang"], ("id",), mode="append")
        return fresh if found is None else found.unionByName(fresh)

    # -- Gold -> insights --------------------------------------------------------

    def build_insights(
        self,
        languages: list[str] | None = None,
        topn_all_time: int = 500,
        topn_trending: int = 1000,
        topn_edges: int = 100_000,
        topm_referrers: int = 50,
        skip_existing: bool = True,
        incremental: bool = False,
    ) -> None:
        """Write the five insight tables for the given languages (default: all).

        With ``skip_existing`` the partitions already written are left out, so the
        Gold rows of finished languages are not even read. Without it, partitions whose Gold
        rows are gone become empty. All five tables are published together; a table that
        turns out to have no rows is warned about, and counts as done.

        ``incremental`` brings the yearly and all-time lists up to date: the new months are
        added to kept totals (``update_totals``), and only years and languages with new months
        are ranked, from the totals. The lists of the latest months follow as usual.
        """
        if incremental:
            with tuned(self.spark), scratch(self.spark):
                changed = self.update_totals()
            changed = [k for k in changed if languages is None or k[0] in languages]

        def popularity(periods: list[increments.Period]) -> DataFrame:
            return self._gold_part("article_popularity", periods)

        def window(topic: str, source: str, months: int) -> list[increments.Period]:
            return self._pending_window(topic, source, months, languages, skip_existing)

        yearly = changed if incremental else self._pending_years(languages, skip_existing)
        whole = changed if incremental else self._pending_languages(languages, skip_existing)
        trending = window("trending_mom", "article_popularity", 2)
        paired = {topic: window(topic, "edges_monthly", 6) for topic in ("edges_6m", "referrers_6m")}
        months = sorted({p for periods in paired.values() for p in periods})
        pending = sorted({p[0] for periods in (yearly, whole, trending, months) for p in periods})
        gone = {} if skip_existing else self._without_gold(languages)
        if not pending:
            if any(gone.values()):
                self.insight_log.publish(gone)
            return
        size = files.total_bytes(self.spark, f"{self.root}/gold")
        with tuned(self.spark, size), scratch(self.spark):
            totals = stage(I.window_pair_totals(self._gold_part("edges_monthly", months)), "window-totals")

            def of(topic: str) -> DataFrame:
                return totals.filter(F.col("lang").isin(sorted({p[0] for p in paired[topic]})))

            def best_of_years() -> DataFrame:
                return I.top10_of_totals(self.state("yearly_totals", yearly)) if incremental else I.top10_by_year(popularity(yearly))

            def best_ever() -> DataFrame:
                if not incremental:
                    return I.all_time_top(popularity(whole), topn_all_time)
                return I.all_time_top_of_totals(self.state("all_time_totals", sorted({k[:1] for k in whole})), topn_all_time)

            winners: dict[str, DataFrame] = {}

            def rank(topic: str, build: Callable[[], DataFrame]) -> Callable[[], None]:
                def run() -> None:
                    winners[topic] = stage(build(), topic)

                return run

            _together([
                rank("edges_6m", lambda: I.busiest_pairs(of("edges_6m"), topn_edges)),
                rank("referrers_6m", lambda: I.strongest_referrers(of("referrers_6m"), topm_referrers)),
                rank("top10_by_year", best_of_years),
                rank("all_time_top", best_ever),
                rank("trending_mom", lambda: I.trending_mom(popularity(trending), topn_trending)),
            ])
            # One look at the dictionary, of the pending languages, labels all insights.
            entries = self.dictionary().filter(F.col("lang").isin(pending))
            labels = stage(ids.used_entries([*winners.values()], entries), "labels")
            handled = {
                "top10_by_year": {p[:2] for p in yearly}, "all_time_top": {p[:1] for p in whole},
                "trending_mom": layers.latest_window(trending, 1),
                **{topic: layers.latest_window(periods, 1) for topic, periods in paired.items()},
            }
            token, changes = new_token(), gone

            def write(topic: str) -> None:
                keys = sorted(handled[topic])
                rows = I.with_titles(winners[topic], labels).select(*schemas.INSIGHTS[topic].names)
                order = {"top10_by_year": ("rn",), "referrers_6m": ("curr_title", "rn")}.get(topic, ())
                written = self._write_version(self.insight_log, rows, topic, schemas.INSIGHT_PARTITIONS[topic], token, keys, order)
                changes[topic] = changes.get(topic, {}) | written
                if keys and not any(written.values()):
                    warnings.warn(f"{topic}: no rows for any of {len(keys)} partitions", stacklevel=2)

            _together([partial(write, topic) for topic in winners])
            self.insight_log.publish(changes)

    def update_totals(self) -> list[tuple[str, int]]:
        """Add Gold months that are new since the last call to the yearly and all-time totals.

        Returns the (lang, year) with new rows. Only the new months are read, and the totals of
        their years and languages. Where a month that is already in the totals has got another
        version, its year is summed up anew from its months, and its language from its years.
        """
        log, gold = self.state_log, self.gold_log.snapshot().get("article_popularity", {})
        seen = log.snapshot().get("seen", {})
        new = [p for p, token in gold.items() if p not in seen and token]
        other = [p for p, token in gold.items() if p in seen and seen[p] != token]
        keys = sorted({p[:2] for p in [*new, *other]})
        if not keys:
            if fresh := {p: token for p, token in gold.items() if p not in seen}:
                log.publish({"seen": fresh})
            return []
        anew = {p[:2] for p in other}
        months = [p for p in gold if p[:2] in anew] + [p for p in new if p[:2] not in anew]
        token, names = new_token(), schemas.STATES["yearly_totals"].names

        def summed(parts: list[DataFrame], by: list[str]) -> DataFrame:
            rows = parts[0].select(*by, "curr_id", "total_clicks").unionByName(parts[1].select(*by, "curr_id", "total_clicks"))
            return rows.groupBy(*by, "curr_id").agg(F.sum("total_clicks").alias("total_clicks"))

        added = self._gold_part("article_popularity", months)
        langs, redone = sorted({k[:1] for k in keys}), {k[:1] for k in anew}
        changes: dict[str, dict] = {}

        def write(topic: str, rows: DataFrame, handled: list[tuple]) -> None:
            changes[topic] = log.write(rows, topic, schemas.STATE_PARTITIONS[topic], token, handled)

        def write_years() -> None:
            write("yearly_totals", summed([self.state("yearly_totals", [k for k in keys if k not in anew]), added], ["lang", "year"]), keys)

        plain = [k for k in langs if k not in redone]
        ever = summed([self.state("all_time_totals", plain), added.filter(F.col("lang").isin([x for (x,) in plain]))], ["lang"])
        if not redone:
            _together([write_years, lambda: write("all_time_totals", ever, langs)])
            log.publish(changes | {"seen": dict(gold)})
            return keys
        write_years()
        fresh_years = log.read_version("yearly_totals", schemas.STATES["yearly_totals"], ["lang", "year"], token)
        kept_years = self.state("yearly_totals", [k for k in log.partitions("yearly_totals") if k[:1] in redone and k not in keys])
        again = kept_years.unionByName(fresh_years.filter(F.col("lang").isin([x for (x,) in redone]))).select(*names)
        ever = ever.unionByName(again.groupBy("lang", "curr_id").agg(F.sum("total_clicks").alias("total_clicks")))
        write("all_time_totals", ever, langs)
        log.publish(changes | {"seen": dict(gold)})
        return keys

    def profile_languages(self) -> DataFrame:
        """Rows, clicks and distinct targets per language, from states of single months.

        Months whose Gold version is not yet in the states are read, no others.
        """
        log, gold = self.state_log, self.gold_log.snapshot().get("article_popularity", {})
        seen = log.snapshot().get("profiled", {})
        months = [p for p, token in gold.items() if seen.get(p, "") != token]
        if months:
            silver = layers.read_periods(self.spark, self.silver_path, schemas.SILVER, months)
            state = quality.profile_state(silver, self._gold_part("article_popularity", months))
            written = log.write(state.select(*schemas.STATES["profiles"].names), "profiles", PERIOD, new_token(), months)
            log.publish({"profiles": written, "profiled": {p: gold[p] for p in months}})
        return quality.merged_profile(self.state("profiles"))

    def _without_gold(self, languages: list[str] | None) -> dict[str, dict[tuple, None]]:
        """Published partitions of insights for which no Gold rows are left."""
        gone = {}
        for topic, by in schemas.INSIGHT_PARTITIONS.items():
            source = "edges_monthly" if topic in ("edges_6m", "referrers_6m") else "article_popularity"
            width = 2 if topic == "top10_by_year" else 1
            left = {p[:width] for p in self._gold_periods(source, None)}
            known = {p[:width] for p in self.gold_log.partitions(source)}
            gone[topic] = {
                key: None for key in self.insight_log.partitions(topic, filled=True)
                if key[:width] in known - left and (languages is None or key[0] in languages)
            }
        return gone

    def _gold_part(self, topic: str, periods: list[increments.Period]) -> DataFrame:
        return self.gold_log.read(topic, schemas.GOLD[topic], PERIOD, periods)

    def _gold_periods(self, topic: str, languages: list[str] | None):
        periods = self.gold_log.partitions(topic, filled=True)
        return [p for p in periods if languages is None or p[0] in languages]

    def _pending_years(self, languages, skip_existing: bool) -> list[increments.Period]:
        periods = self._gold_periods("article_popularity", languages)
        if skip_existing:
            have = set(self.insight_log.partitions("top10_by_year"))
            periods = [p for p in periods if p[:2] not in have]
        return periods

    def _pending_languages(self, languages, skip_existing: bool) -> list[increments.Period]:
        periods = self._gold_periods("article_popularity", languages)
        if skip_existing:
            have = {lang for (lang,) in self.insight_log.partitions("all_time_top")}
            periods = [p for p in periods if p[0] not in have]
        return periods

    def _pending_window(
        self, topic: str, source: str, months: int, languages, skip_existing: bool
    ) -> list[increments.Period]:
        """The Gold months a windowed insight needs, found from the logs."""
        periods = self._gold_periods(source, languages)
        if skip_existing:
            have = set(self.insight_log.partitions(topic))
            finished = {p[0] for p in layers.latest_window(periods, 1) if p in have}
            periods = [p for p in periods if p[0] not in finished]
        return layers.latest_window(periods, months)

    # -- catalog -----------------------------------------------------------------

    def register_views(self) -> None:
        """Temporary views over every layer; insight views are named ``gs_<table>``.

        The analytical queries become table functions of SQL, see ``sql_queries``.
        """
        self.silver().createOrReplaceTempView("clickstream_silver")
        self.dictionary().createOrReplaceTempView("articles")
        for topic in schemas.GOLD:
            self.gold(topic).createOrReplaceTempView(topic)
        for topic in schemas.INSIGHTS:
            self.insight(topic).createOrReplaceTempView(f"gs_{topic}")
        for statement in sql_queries.FUNCTIONS.values():
            self.spark.sql(statement)
