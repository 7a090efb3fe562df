"""Bronze -> Silver cleaning, in a strict and a lenient profile.

All rules look at the *raw* values: titles still carry underscores and the type is
neither trimmed nor lower-cased when it is tested. Only the output is normalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.functions import titles as T
from clickweir.schemas import PERIOD, SILVER

PROFILES = ("strict", "lenient")


def _count() -> Column:
    """The count as an integer; text that is not one gives NULL."""
    return F.col("n").try_cast("int")


def readable(profile: str) -> Column:
    """Rows that count as read, before any cleaning rule."""
    if profile == "strict":
        return F.col("curr").isNotNull() & _count().isNotNull() & (_count() > 0)
    return F.col("curr").isNotNull() & F.col("n").isNotNull() & (F.col("curr") != T.HEADER_SENTINEL)


def keepable(profile: str, prefixes=T.NOISE_PREFIXES, fragments=T.NOISE_FRAGMENTS) -> Column:
    """Rows that survive cleaning.

    The strict profile also drops noise titles and self-loops; comparing with a NULL
    referrer is not true, so rows without one go as well.
    """
    rule = readable(profile) & F.col("type").isin(T.REFERRAL_TYPES) & (F.length("curr") > 0)
    if profile == "strict":
        noise = T.is_noise(F.col("curr"), prefixes, fragments)
        return rule & ~noise & (F.col("curr") != F.col("prev"))
    return rule & (_count() > 0) & F.col("prev").isNotNull()


def clean(bronze: DataFrame, profile: str = "strict", **noise) -> DataFrame:
    """Silver rows of ``bronze``.

    ``strict`` normalises titles and keeps the largest count among duplicates, which
    costs one shuffle with map-side combine. ``lenient`` is filter and projection only.
    """
    kept = bronze.filter(keepable(profile, **noise)).select(*PERIOD, *_values(profile))
    return kept if profile == "lenient" else keep_largest(kept)


def marked(bronze: DataFrame, profile: str = "strict", **noise) -> DataFrame:
    """Readable rows with ``kept``; those that cleaning drops have partition and file only.

    What is kept is Silver but for the strict profile's duplicates.
    """
    kept = F.coalesce(keepable(profile, **noise), F.lit(False))
    rows = bronze.filter(readable(profile)).withColumn("kept", kept)
    values = [F.when(F.col("kept"), v).alias(name) for name, v in zip(SILVER.names[3:], _values(profile), strict=True)]
    return rows.select("file", "kept", *PERIOD, *values)


def _values(profile: str) -> list[Column]:
    """Titles, type and count as Silver has them."""
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}")
    if profile == "lenient":
        columns = [F.col("prev"), F.col("curr"), F.col("type"), _count()]
    else:
        columns = [T.normalise_title(F.col("prev")), T.normalise_title(F.col("curr")), T.normalise_type(F.col("type")), _count()]
    return [c.alias(name) for c, name in zip(columns, SILVER.names[3:], strict=True)]


def keep_largest(silver: DataFrame) -> DataFrame:
    """One row per edge and type, with the largest count."""
    keys = [c for c in SILVER.names if c != "n"]
    return silver.groupBy(*keys).agg(F.max("n").alias("n"))
