"""The registered queries against their SQL, the pipeline's stages, and native plans."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tools.check import TABLES, rows_of
from veilmark.llm import queries
from veilmark.llm.scratch import clear, stored


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    yield connection
    connection.close()


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, small, db, name):
    df = queries.QUERIES[name](spark, small)
    result = db.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["op4_personal_data", "op8_license_scan", "op10_exact_duplicates"])
def test_native_plans(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), name)
        counts.append(docs.count())
        assert name == "packing" or docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 and counts[4] > 0
    whole = corpus_pipeline.run(spark, small)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_pipeline_on_odd_rows(spark, small, documents, odd_rows):
    docs = documents(odd_rows).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stored(stage(spark, docs, small), "odd")
    assert docs.count() > 0
    for rows in ([],):
        empty = documents(rows).select("doc_id", "text", "lang", "source", "n_chars")
        assert all(stage(spark, empty, small).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_stored_tables_are_deleted(spark, tmp_path):
    df = stored(spark.range(3), "test")
    assert df.count() == 3
    path = df.inputFiles()[0]
    clear()
    import os

    assert not os.path.exists(path.removeprefix("file://"))
