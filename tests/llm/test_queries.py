"""Registered queries: oracle parity where SQL can express them, and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fundflow.llm.common import read
from fundflow.llm.oracle import LLM_ORACLE_SQL
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(LLM_ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(LLM_ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want) > 0
    assert digest(df.columns, got)[1] == digest(columns, want)[1]


@pytest.mark.parametrize("name", ["op1_pii", "op2_sentencepiece", "op6_quality", "op10_secrets", "op13_language"])
def test_one_row_per_document(spark, name):
    assert queries()[name](spark, SF).count() == read(spark, SF, "documents").count()


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    columns, last = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        n = docs.count()
        assert 0 < n <= last
        last = n
    pieces = queries()["pipeline"](spark, SF)
    assert pieces.select("doc_id").distinct().count() == last
