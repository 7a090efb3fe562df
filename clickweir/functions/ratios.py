"""Ratios in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_delta(now: Column, before: Column) -> Column:
    """Change in percent; NULL unless the earlier value is positive."""
    return F.when(before > 0, (now - before) * F.lit(100.0) / before)


def pct_share(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100.0)
