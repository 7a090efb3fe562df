"""Read language, year and month out of dump file paths.

Two forms are understood:
  .../<YYYY>-<MM>/<any>-<lang>wiki[-...].tsv[.gz]      month from the folder
  .../<folder without dash>/<any>-<lang>[wiki]-<YYYY>-<MM>.tsv[.gz]   all from the name
The second form is accepted only where ``allow_name_form`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dump_partition(path: Column, allow_name_form: bool = True) -> Column:
    """Struct (lang, year, month) for a dump path, NULL when the path is unexpected."""
    steps = F.split(path, "/")
    folder = F.split(F.try_element_at(steps, F.lit(-2)), "-")
    stem = F.regexp_replace(F.element_at(steps, -1), r"\.tsv(\.gz)?", "")
    words = F.split(stem, "-")

    site = F.get(words, F.lit(1))
    lang = F.replace(site, F.lit("wiki"), F.lit(""))

    def number(value: Column) -> Column:
        return value.try_cast("int")

    by_folder = F.struct(
        F.when(site.contains("wiki"), lang).alias("lang"),
        number(F.get(folder, F.lit(0))).alias("year"),
        number(F.get(folder, F.lit(1))).alias("month"),
    )
    by_name = F.struct(
        lang.alias("lang"),
        number(F.get(words, F.lit(2))).alias("year"),
        number(F.get(words, F.lit(3))).alias("month"),
    )
    has_month_folder = F.size(folder) > 1
    found = F.when(has_month_folder, by_folder)
    if allow_name_form:
        found = found.otherwise(by_name)
    complete = (
        found["lang"].isNotNull() & found["year"].isNotNull() & found["month"].isNotNull()
    )
    return F.when(complete, found)
