"""Dump files to staged rows, each file decoded once, damaged files told apart from a damaged job.

The files are read in batches of bounded size, one Spark job each. A job writes the readable
rows of its files and, in the same pass, counts them by file: a histogram of file numbers with
a bin for each is an exact count, and as the job has no shuffle each task counts once. So the
written rows and a record for every file exist before anything is chosen or replaced.

A job that fails because a file's compressed content cannot be decoded is run again without
that file, in smaller batches at once, until the damaged files of the batch are known; files of
other batches are not read again. Any other error (a lost store, a full disk, an unknown column) ends the ingest, so that
it can never pass for a damaged file.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from clickweir.operators import cleaning
from clickweir.schemas import PERIOD, SILVER, STAGED
from clickweir.session import staging_dir
from clickweir.sources import bronze

TOGETHER = 8


@dataclass
class FileRecord:
    """What became of one dump file."""

    file: Row
    rows_read: int = 0
    rows_clean: int = 0
    complete: bool = True


def stage_files(spark: SparkSession, manifest: list[Row], profile: str, batch_files: int = bronze.BATCH_FILES) -> tuple[DataFrame, list[FileRecord]]:
    """The readable rows of the files that can be decoded, and a record of every file.

    The rows have the columns of Silver, ``file`` (the place in ``manifest``) and ``kept``; what
    does not survive cleaning is there to be counted and has no content.
    """
    records = [FileRecord(f) for f in manifest]
    parts: list[str] = []

    def decode(batch: list[tuple[int, Row]]) -> None:
        path, seen = staging_dir(spark, "dump-rows"), Observation()
        rows = cleaning.marked(bronze.scan_batch(spark, batch), profile).observe(
            seen,
            F.histogram_numeric("file", F.lit(batch_files + 1)).alias("rows_read"),
            F.histogram_numeric(F.when(F.col("kept"), F.col("file")), F.lit(batch_files + 1)).alias("rows_clean"),
        )
        try:
            rows.select(*STAGED.names).write.option("compression", "zstd").parquet(path)
        except Exception as error:
            damaged = bronze.undecodable(error)
            if damaged is None:
                raise
            rest = [x for x in batch if x[1].uri != damaged and len(batch) > 1]
            for i, _ in (x for x in batch if x not in rest):
                records[i].complete = False
            step = -(-len(rest) // TOGETHER)
            _all_of(decode, [rest[i:i + step] for i in range(0, len(rest), step or 1)])
            return
        for name, bins in seen.get.items():
            for place in bins or []:
                record = records[round(place["x"])]
                setattr(record, name, getattr(record, name) + round(place["y"]))
        parts.append(path)

    for batch in bronze.batches(manifest, batch_files):
        decode(batch)
    if not parts:
        return spark.createDataFrame([], STAGED), records
    return spark.read.schema(STAGED).parquet(*parts), records


def _all_of(job, inputs: list) -> None:
    if not inputs:
        return
    with ThreadPoolExecutor(max_workers=TOGETHER) as pool:
        for done in [pool.submit(copy_context().run, job, x) for x in inputs]:
            done.result()


def choose(records: list[FileRecord], taken: dict[tuple, str] | None = None) -> dict[tuple, str]:
    """The dump that each partition takes: the last one, in path order, that is complete and has a readable row.

    ``taken`` names the dumps that partitions hold already; they stay unless a later one comes.
    """
    damaged = {r.file.dump for r in records if not r.complete}
    best = dict(taken or {})
    for r in records:
        period = (r.file.lang, r.file.year, r.file.month)
        if r.rows_read and r.file.dump not in damaged:
            best[period] = max(r.file.dump, best.get(period, r.file.dump))
    return best


def silver_rows(staged: DataFrame, records: list[FileRecord], chosen: set[str], profile: str) -> DataFrame:
    """Silver of the files of the chosen dumps."""
    places = [i for i, r in enumerate(records) if r.file.dump in chosen and r.rows_clean]
    rows = staged.filter(F.col("kept") & F.col("file").isin(places)) if places else staged.limit(0)
    rows = rows.select(*SILVER.names)
    return cleaning.keep_largest(rows) if profile == "strict" else rows


def file_log(spark: SparkSession, records: list[FileRecord], rejected: list[Row], chosen: set[str], taken: dict[tuple, str]) -> DataFrame:
    """One row for each file: its dump, partition, counts and what became of it."""
    damaged = {r.file.dump for r in records if not r.complete}

    def state(r: FileRecord) -> str:
        if not r.complete:
            return "unreadable"
        if r.file.dump in chosen:
            return "taken"
        best = taken.get((r.file.lang, r.file.year, r.file.month), r.file.dump)
        return "incomplete" if r.file.dump in damaged else "superseded" if best != r.file.dump else "empty"

    rows = [(r.file.path, r.file.uri, r.file.dump, r.file.lang, r.file.year, r.file.month, r.rows_read, r.rows_clean, state(r)) for r in records]
    rows += [(f.path, f.uri, None, None, None, None, 0, 0, "rejected") for f in rejected]
    shape = "path string, uri string, dump string, lang string, year int, month int, rows_read long, rows_clean long, state string"
    return spark.createDataFrame(rows, shape)


def partition_counts(log: DataFrame) -> DataFrame:
    """Rows read, kept and filtered of each partition that was written, from the log of its files."""
    taken = log.filter(F.col("state") == "taken").groupBy(*PERIOD).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_clean").alias("rows_clean"),
    )
    return taken.withColumn("rows_filtered", F.col("rows_read") - F.col("rows_clean"))
