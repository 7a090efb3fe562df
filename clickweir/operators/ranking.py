"""Top rows per group that stay parallel however large a group is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clickweir.session import stage

# A coarse level tells numbers apart that differ by more than about 1 / STEPS of their size.
STEPS = 256
TEXT_START = 2


def _sort_key(name: str) -> Column:
    return F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc_nulls_last(name)


def top_n(df: DataFrame, group: list[str], order: list[str], n: int, rank: str | None = "rn") -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``rank``.

    ``order`` names columns, with a minus sign for descending ones, and has to be total (end in
    a unique column); nulls are last. Spark turns ``row_number() <= n`` into a group limit ahead
    of the shuffle, so a task sends at most n rows of a group. That serves many small groups.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*map(_sort_key, order)))
    ranked = df.withColumn("_place", place).filter(F.col("_place") <= n)
    if rank is None:
        return ranked.drop("_place")
    return ranked.withColumn(rank, F.col("_place").cast("long")).drop("_place")


def _coarse(df: DataFrame, name: str) -> Column:
    """A value that never falls along the order, with few different ones."""
    column = name.lstrip("-")
    if isinstance(df.schema[column].dataType, StringType):
        if name != column:
            raise ValueError("texts are ranked in ascending order only")
        return F.substring(F.col(column), 1, TEXT_START)
    value = F.col(column).cast("double")
    steps = F.signum(value) * F.floor(STEPS * F.log2(F.abs(value) + 1))
    return F.coalesce(-steps if name != column else steps, F.lit(float("inf")))


def _exact(name: str) -> Column:
    """The value itself, so that smaller is better."""
    return -F.col(name[1:]) if name.startswith("-") else F.col(name)


def candidates(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """Rows that can be among the first ``n`` of their group: those, and few more.

    ``df`` should be a written table, as it is read once for each level. A level counts the
    rows of a group by a coarse form of the first column of ``order``, then, within the value
    that holds the n-th row, by the column itself, then by a coarse form of the second column.
    Counts are combined on the map side and summed up from the best; a group has few different
    values at a level, whatever its rows. What is worse than the cutoff goes without a shuffle.
    There is a cutoff for each group, so their frame is no larger than the list of groups, and
    it is broadcast.
    """
    levels = [_coarse(df, order[0]), _exact(order[0])]
    if len(order) > 1:
        levels.append(_coarse(df, order[1]))
    names = [f"_cut{i}" for i in range(len(levels))]
    rows = df.withColumns({f"_level{i}": level for i, level in enumerate(levels)})
    cuts = None
    for i, name in enumerate(names):
        level = f"_level{i}"
        if cuts is None:
            counted = rows.withColumn("_before", F.lit(0).cast("long"))
        else:
            same = [F.col(f"_level{j}").eqNullSafe(F.col(names[j])) for j in range(i)]
            counted = rows.join(F.broadcast(cuts), group).filter(reduce(lambda a, b: a & b, same))
        keys = [*group, "_before", *names[:i]]
        counts = counted.groupBy(*keys, level).agg(F.count("*").alias("_size"))
        so_far = Window.partitionBy(*group).orderBy(F.asc_nulls_last(level)).rowsBetween(Window.unboundedPreceding, 0)
        upto = counts.withColumn("_upto", F.col("_before") + F.sum("_size").over(so_far))
        found = upto.filter((F.col("_upto") >= n) & (F.col("_upto") - F.col("_size") < n))
        cuts = stage(found.select(
            *group, (F.col("_upto") - F.col("_size")).alias("_before"), *names[:i], F.col(level).alias(name),
        ), "cutoff")

    def upto_cut(i: int) -> Column:
        level, cut = F.col(f"_level{i}"), F.col(names[i])
        if i == len(names) - 1:
            return (level <= cut) | cut.isNull()
        return (level < cut) | (cut.isNull() & level.isNotNull()) | (level.eqNullSafe(cut) & upto_cut(i + 1))

    kept = rows.join(F.broadcast(cuts.withColumn("_has", F.lit(True))), group, "left")
    return kept.filter(F.col("_has").isNull() | upto_cut(0)).select(*df.columns)


def top_n_of_few(df: DataFrame, group: list[str], order: list[str], n: int, rank: str | None = "rn") -> DataFrame:
    """``top_n`` for few groups of many rows, all of them in every task.

    Only rows up to each group's cutoff are shuffled, whatever the number of tasks: n rows and
    those that the last level does not tell from the n-th.
    """
    return top_n(candidates(df, group, order, n), group, order, n, rank)
