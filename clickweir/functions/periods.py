"""Month arithmetic on (year, month) columns.

A month is also handled as one integer, ``year * 12 + month``, so that windows of
calendar months are plain integer ranges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(year: str | Column = "year", month: str | Column = "month") -> Column:
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return year * 12 + month


def index_year(index: Column) -> Column:
    return F.floor((index - 1) / 12).cast("int")


def index_month(index: Column) -> Column:
    return (F.pmod(index - 1, F.lit(12)) + 1).cast("int")


def month_start(year: str = "year", month: str = "month") -> Column:
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def month_text(year: str = "year", month: str = "month") -> Column:
    """'YYYY-MM'."""
    return F.concat(
        F.lpad(F.col(year).cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad(F.col(month).cast("string"), 2, "0"),
    )


def window_months(last: Column, months: int) -> Column:
    """Array of the first days of the ``months`` calendar months ending at ``last``."""
    return F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))


def partition_key(year: str = "year", month: str = "month") -> Column:
    """'lang/year/month' as one text value, for set membership on partition columns."""
    return F.concat_ws("/", F.col("lang"), F.col(year).cast("string"), F.col(month).cast("string"))
