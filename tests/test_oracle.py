"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


#: The optional subpackage tests its own queries.
NAMES = sorted(set(queries()) - set(LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["TaxYear", "Municipality", "Fund", "Taxes_Diverted_TIF"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
