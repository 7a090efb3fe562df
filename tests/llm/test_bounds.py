"""What a step leaves on disk."""

import os

import pytest
from pyspark.sql import functions as F

from clickweir.llm import line_templates
from clickweir.llm.frames import FREED_SHUFFLES, saved
from clickweir.session import shared_dir


def _shuffle_files(spark):
    names = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {x for x in names.split() if os.path.basename(x).startswith("shuffle_")}


@pytest.mark.parametrize("own", ["false", "true"])
def test_a_saved_table_leaves_no_shuffle_files(spark, own):
    spark.conf.set(FREED_SHUFFLES, own)
    try:
        before = _shuffle_files(spark)
        copy = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "bounds")
        assert not _shuffle_files(spark) - before
        assert copy.count() == 7
        assert spark.conf.get(FREED_SHUFFLES) == own
    finally:
        spark.conf.unset(FREED_SHUFFLES)


def test_line_dedup_removes_what_it_staged_but_the_lines_found(spark):
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    body = "one line that all documents hold, word for word\n"
    docs = spark.createDataFrame([(i, f"{body}only {i}") for i in range(4)], "doc_id long, text string")
    out = line_templates.drop_recurring(docs)
    assert [x.split("-")[1] for x in set(os.listdir(folder)) - before] == ["dropped"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: f"{body}only 0"} | {i: f"only {i}" for i in (1, 2, 3)}
