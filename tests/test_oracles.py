"""Every registered query against its SQL twin in a second engine."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from clickweir.checks.oracles import all_oracles
from clickweir.checks.registry import all_queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


_SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_equals_the_layered_query(spark):
    layered = QUERIES["n01_top_of_year"](spark, "/root/testdata/sf0.001")
    assert entry(spark).collect() == layered.collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for slow in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    twin = duck.execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    kinds = {d[0]: str(d[1]) for d in twin.description}
    assert sorted(frame.columns) == sorted(columns)
    assert {c: _SAME_TYPE[t] for c, t in frame.dtypes} == kinds
    expected = _rows(columns, twin.fetchall())
    found = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(expected) > 0
    assert found == expected
