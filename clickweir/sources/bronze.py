"""Raw clickstream dumps: discovery, file selection and the tab-separated scan.

A dump file has no header and four tab-separated fields: prev, curr, type, n. The
partition (lang, year, month) comes from the path, never from the content.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.functions.paths import dump_partition
from clickweir.schemas import BRONZE
from clickweir.sources.layers import in_periods

FIELDS = ["prev", "curr", "type", "n"]
FILES = "uri string, lang string, year int, month int"
# Dump files of one scan. Their lookup frame stays far below any broadcast limit.
BATCH_FILES = 1024


def discover(spark: SparkSession, root: str) -> DataFrame:
    """All dump files below ``root``: ``*.tsv.gz``, or ``*.tsv`` only if there are none.

    The listing runs as a Spark scan that never opens the files' content.
    """

    def listing(pattern: str) -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern)
            .load(root)
            .select("path", F.col("_metadata.file_path").alias("uri"))
        )

    packed = listing("*.tsv.gz")
    return listing("*.tsv") if packed.isEmpty() else packed


def with_partition(files: DataFrame, allow_name_form: bool = True) -> DataFrame:
    """Add lang, year, month and ``accepted``; rejected paths keep NULLs."""
    found = dump_partition(F.col("path"), allow_name_form)
    return files.withColumn("_found", found).select(
        "*",
        F.col("_found.lang").alias("lang"),
        F.col("_found.year").alias("year"),
        F.col("_found.month").alias("month"),
        F.col("_found").isNotNull().alias("accepted"),
    ).drop("_found")


def select_partitions(
    df: DataFrame,
    lang: str | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Keep the given partition values; on a partitioned table this prunes folders."""
    wanted = {"lang": lang, "year": year, "month": month}
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def first_files(files: DataFrame, count: int) -> DataFrame:
    return files.orderBy("path").limit(count)


def with_dump(manifest: DataFrame) -> DataFrame:
    """Add ``dump``, the path without extension: the numbered parts of one dump share it."""
    return manifest.withColumn("dump", F.regexp_replace("path", r"(\.\d+)?\.tsv(\.gz)?$", ""))


def last_file_per_partition(manifest: DataFrame) -> DataFrame:
    """The files of one dump per (lang, year, month): the last one in path order, with all its parts."""
    latest = Window.partitionBy("lang", "year", "month").orderBy(F.desc("dump"))
    return (
        with_dump(manifest).withColumn("_place", F.rank().over(latest))
        .filter(F.col("_place") == 1)
        .drop("_place", "dump")
    )


def batches(manifest: list[Row], batch_files: int = BATCH_FILES) -> list[list[tuple[int, Row]]]:
    """The files, numbered by their place, in batches of bounded size."""
    numbered = list(enumerate(manifest))
    return [numbered[i:i + batch_files] for i in range(0, len(numbered), batch_files)]


def scan_batch(spark: SparkSession, batch: list[tuple[int, Row]]) -> DataFrame:
    """Rows of some numbered dump files (path, uri, lang, year, month), with ``file``, their number.

    Every field is read as text, so one reader serves both cleaning profiles. Quotes
    are literal, short rows are padded with NULL, an empty field is NULL, and rows with
    more than four fields are dropped. A file's partition is looked up in a broadcast frame
    with a row for each file, which the size of a batch bounds; no line is shuffled for it.
    """
    files = spark.createDataFrame([(i, m.uri, m.lang, m.year, m.month) for i, m in batch], f"file int, {FILES}")
    # Exploding a one-element array keeps each line one row, and makes the split fields a
    # column of their own. Without it the optimizer would push every later rule below the
    # projection and split the line anew for each of them (measured: three times slower).
    lines = spark.read.text([m.path for _, m in batch]).select(
        F.explode(F.array(F.split("value", "\t", -1))).alias("parts"),
        F.col("_metadata.file_path").alias("uri"),
    )
    fields = [F.nullif(F.get("parts", F.lit(i)), F.lit("")).alias(f) for i, f in enumerate(FIELDS)]
    return (
        lines.filter(F.size("parts") <= len(FIELDS))
        .join(F.broadcast(files), "uri")
        .select("lang", "year", "month", *fields, "file")
    )


def scan(spark: SparkSession, manifest: list[Row], batch_files: int = BATCH_FILES) -> DataFrame:
    """Rows of all dump files in ``manifest``, batch by batch in one frame."""
    if not manifest:
        return spark.createDataFrame([], BRONZE)
    parts = [scan_batch(spark, batch).drop("file") for batch in batches(manifest, batch_files)]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows


def undecodable(error: Exception) -> str | None:
    """The file whose compressed content could not be decoded, if that made a job fail.

    The first cause was then raised by a decompressor. What a store or a network raises comes
    from below the decompressor, and so do errors of any other kind from elsewhere; for them
    the answer is None. Where no file is named it is empty.
    """
    cause, path = getattr(error, "java_exception", None) or getattr(error, "_origin", None), ""
    while cause is not None:
        named = re.match(r"\[FAILED_READ_FILE\.\S+\] Encountered error while reading file (\S+)\.\s", f"{cause.getMessage()} ")
        path = named[1] if named else path
        if cause.getCause() is None:
            frames = cause.getStackTrace()
            inside = len(frames) and frames[0].getClassName().startswith("org.apache.hadoop.io.compress.")
            return path if inside else None
        cause = cause.getCause()
    return None


def select_files(
    spark: SparkSession,
    root: str,
    lang: str | None = None,
    year: int | None = None,
    month: int | None = None,
    limit: int | None = None,
    allow_name_form: bool = True,
    one_file_per_partition: bool = True,
    done: list[tuple[str, int, int]] | None = None,
) -> list[Row]:
    """The dump files to read below ``root``, without those of the partitions ``done``.

    Only this list reaches the driver, which needs it to plan the scan.
    """
    accepted = [f for f in inspect_files(spark, root, limit, allow_name_form, lang, year, month, done) if f.accepted]
    return last_dumps(accepted) if one_file_per_partition else accepted


def inspect_files(
    spark: SparkSession,
    root: str,
    limit: int | None = None,
    allow_name_form: bool = True,
    lang: str | None = None,
    year: int | None = None,
    month: int | None = None,
    done: list[tuple[str, int, int]] | None = None,
) -> list[Row]:
    """All dump files below ``root`` in path order, of the wanted partitions or ``accepted`` by none."""
    found = discover(spark, root)
    if limit is not None:
        found = first_files(found, limit)
    manifest = with_dump(with_partition(found, allow_name_form))
    wanted = select_partitions(manifest.filter("accepted"), lang, year, month)
    if done:
        wanted = wanted.filter(~in_periods(done))
    return wanted.union(manifest.filter("not accepted")).orderBy("path").collect()


def last_dumps(manifest: list[Row]) -> list[Row]:
    """The files of the last dump of each partition."""
    last: dict[tuple, str] = {}
    for f in manifest:
        last[f.lang, f.year, f.month] = max(f.dump, last.get((f.lang, f.year, f.month), f.dump))
    return [f for f in manifest if last[f.lang, f.year, f.month] == f.dump]


def read_dumps(spark: SparkSession, root: str, **selection) -> DataFrame:
    """Rows of the selected dump files (see ``select_files``), one task per gzip file."""
    return scan(spark, select_files(spark, root, **selection))
