"""Title, referral-type and title-column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They decide which rows survive cleaning.
REFERRAL_TYPES = ["link", "external", "other"]
NOISE_PREFIXES = ["Special:", "User:", "File:", "Talk:", "Category:"]
NOISE_FRAGMENTS = ["404"]
HEADER_SENTINEL = "curr_id"


def normalise_title(title: Column) -> Column:
    """Underscores become spaces; surrounding spaces are removed."""
    return F.trim(F.replace(title, F.lit("_"), F.lit(" ")))


def normalise_type(kind: Column) -> Column:
    return F.lower(F.trim(kind))


def is_noise(
    title: Column,
    prefixes: list[str] = NOISE_PREFIXES,
    fragments: list[str] = NOISE_FRAGMENTS,
) -> Column:
    """True for pages of excluded namespaces and for error-page titles."""
    tests = [title.startswith(p) for p in prefixes] + [title.contains(f) for f in fragments]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def title_column(df: DataFrame, side: str) -> Column | None:
    """The best text column a Gold frame offers for ``side`` ('curr' or 'prev').

    A title column wins over a name column, and a bare id is shown as text.
    ``None`` means the frame has none of them.
    """
    for suffix in ("title", "name", "id"):
        if f"{side}_{suffix}" in df.columns:
            return F.col(f"{side}_{suffix}").cast("string")
    return None
