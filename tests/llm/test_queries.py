"""Every registered query on the smallest driver tables: SQL where there is one, row counts elsewhere."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tools.check_oracles import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")
TABLE = {"op4_warc": "pages", "op5_embedding_dedup": "embeddings"}
NAMES = [n for n in entry.queries() if n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    found = entry.queries()[name](spark, FOLDER)
    if name in entry.oracle_sql():
        assert compare(found, con, entry.oracle_sql()[name])[0] == "ok"
    else:
        assert found.count() == con.execute(f"select count(*) from {TABLE.get(name, 'documents')}").fetchall()[0][0]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialized(stage(spark, docs, FOLDER), name)
        assert out.columns == docs.columns and out.count() <= before
        docs, before = out, out.count()
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert tokens.count() == before > 0 and tokens.filter("n_tokens <> size(ids)").count() == 0


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, FOLDER), name)
    assert docs.count() == 0 and docs.columns[0] == "doc_id"
