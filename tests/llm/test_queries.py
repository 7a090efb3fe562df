"""Registered queries against their SQL, and the pipeline."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clickweir.llm import order_minhash, pii_spans
from clickweir.llm.queries import ORACLES, QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    twin = duck.execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    assert sorted(frame.columns) == sorted(columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert got == sorted(twin.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op1_lines", "op3_quality"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        assert kept.dtypes == docs.dtypes
        counts.append(kept.count())
    assert counts[0] >= counts[1] >= 0.95 * counts[0]  # language ID keeps what it can place
    assert counts[2] == counts[1] and counts[4] == counts[3]
    assert 0 < counts[3] < counts[2]
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert pieces.select("doc_id").distinct().count() == counts[4]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").where("start = 0").select("doc_id").collect())) == sorted(
        map(tuple, pieces.where("start = 0").select("doc_id").collect()))


def test_pipeline_keeps_only_its_stages(spark):
    import os

    from clickweir.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    rows = corpus_pipeline.run(spark, FOLDER)
    left = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(shared_dir(spark))) - before)
    assert left == sorted(f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES[:-1])
    assert rows.count() > 0


def test_pipeline_stages_of_odd_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, words string, node string, found_language string"
    rows = [(1, None, None, None, None, "w", "n", "l"), (2, "", "en", "s", 0, "w", "n", "l"), (3, "some plain text here", "en", "s", 20, "w", "n", "l"), (3, "some plain text here", "en", "s", 20, "w", "n", "l"), (4, "noch ein Text", "de", "s", 1, None, None, None)]
    for frame in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, FOLDER)
            assert out.dtypes == frame.dtypes
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).collect()


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Each stage against another way to its result, then run() against the last one."""
    named = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER).toPandas()
    con = duckdb.connect()
    con.register("documents", named)
    texts = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, text FROM ({ORACLES['op1_lines']})").fetchall()}

    codes = {d: order_minhash.shingles(next(iter(order_minhash._word_codes(pa.array([t or ""]))))) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            alike = texts[a] == texts[b] or (len(codes[a]) and len(codes[b]) and order_minhash.alignment_distance(codes[a], codes[b], 0.2 + 1e-9) is not None)
            if alike:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    kept = {d: texts[d] for d in ids if find(d) == d}

    tokenizer, want = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), {}
    for d, text in kept.items():
        base = pii_spans.base_spans(text or "")
        masked = pii_spans._masked(text or "", base + pii_spans.more_spans(text or "", base))
        want[d] = np.array([*tokenizer.encode(masked, add_special_tokens=False).ids, 1], "<u4")
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert set(got) == set(want)
    for d, pieces in got.items():
        at = 0
        for start, length, crc, tokens in sorted(pieces):
            assert start == at and tokens == len(want[d]) and crc == zlib.crc32(want[d][start:start + length].tobytes())
            at += length
        assert at == len(want[d])
