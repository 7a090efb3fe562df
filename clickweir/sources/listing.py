"""Dump listings: links out of index pages, and the plan of files still to fetch.

Fetching itself is not a Spark job; these operators start from a table of pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed formats of the index pages and of dump file names.
LINK = r'href="([^"]+)"'
MONTH_LINK = r"^\d{4}-\d{2}/?$"
FILE_LINK = r"^clickstream-([a-z-]+)-(\d{4}-\d{2})\.tsv\.gz$"


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every link of every page, one row each, with the page's other columns."""
    others = [c for c in pages.columns if c != html]
    found = F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))
    return pages.select(*others, F.explode(found).alias("href"))


def listed_months(pages: DataFrame) -> DataFrame:
    """Distinct months an index page links to."""
    return (
        links(pages)
        .filter(F.col("href").rlike(MONTH_LINK))
        .select(F.rtrim(F.col("href"), F.lit("/")).alias("dump_month"))
        .distinct()
    )


def listed_files(pages: DataFrame, url: str = "url") -> DataFrame:
    """Distinct dump files on the page of their own month: file, site, month and URL.

    A month's page has a URL that ends in the month; a link to a file of another month
    doesn't count there.
    """
    found = links(pages.select(F.col(url).alias("page"), "html")).filter(F.col("href").rlike(FILE_LINK))
    files = found.select(
        F.col("href").alias("file"),
        F.regexp_extract("href", FILE_LINK, 1).alias("site"),
        F.regexp_extract("href", FILE_LINK, 2).alias("dump_month"),
        F.rtrim(F.col("page"), F.lit("/")).alias("page"),
    )
    own = F.substring_index("page", "/", -1) == F.col("dump_month")
    return files.filter(own).select(
        "file", "site", "dump_month", F.concat_ws("/", "page", "file").alias("file_url"),
    ).distinct()


def acquisition_plan(
    available: DataFrame,
    present: DataFrame,
    months: DataFrame,
    since: str | None = None,
    latest: int | None = None,
    sites: list[str] | None = None,
) -> DataFrame:
    """Files to fetch: rows of ``available`` not in ``present``, with the ``target`` path.

    ``since`` keeps months from 'YYYY-MM' on, ``latest`` the last so many of the listed
    ``months`` that are left, with files or without (0 or None keeps all), ``sites`` only the
    named ones.
    """
    wanted = months.select("dump_month").distinct()
    if since:
        wanted = wanted.filter(F.col("dump_month") >= since)
    if latest:
        wanted = wanted.orderBy(F.desc("dump_month")).limit(latest)
    plan = available.join(wanted, "dump_month", "left_semi")
    if sites:
        plan = plan.filter(F.col("site").isin(sites))
    missing = plan.join(present.select("dump_month", "file"), ["dump_month", "file"], "left_anti")
    return missing.withColumn("target", F.concat_ws("/", "dump_month", "file"))
