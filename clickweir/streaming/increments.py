"""Which months are still to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.schemas import PERIOD

Period = tuple[str, int, int]


def pending_periods(source: DataFrame, outputs: list[DataFrame]) -> DataFrame:
    """Months of ``source`` that at least one of ``outputs`` lacks; frames with a row per month.

    Tables serve as well: only their partition columns are looked at.
    """
    done = outputs[0].select(*PERIOD).distinct()
    for more in outputs[1:]:
        done = done.join(more.select(*PERIOD), PERIOD, "left_semi")
    return source.select(*PERIOD).distinct().join(done, PERIOD, "left_anti").orderBy(*map(F.col, PERIOD))


def periods_to_do(periods: list[Period], outputs: list[list[Period]]) -> list[Period]:
    """``pending_periods`` of lists, as the layers' listings and logs give them."""
    done = set(outputs[0]).intersection(*outputs[1:])
    return sorted(set(periods) - done)


def newest_periods(periods: list[Period]) -> list[Period]:
    """Only the latest month found in any language."""
    last = max(((year, month) for _, year, month in periods), default=None)
    return [p for p in periods if p[1:] == last]


def pick_periods(
    periods: list[Period],
    lang: str | None = None,
    year: int | None = None,
    month: int | None = None,
) -> list[Period]:
    wanted = (lang, year, month)
    return [p for p in periods if all(w is None or w == v for w, v in zip(wanted, p))]
