"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    """Those of the optional text operators without one are tested against brute force."""
    text = {*E.llm.QUERIES, "pipeline"} if E.llm else set()
    assert set(E.queries()) - text == set(E.oracle_sql()) - text
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(norm(s)) == digest(norm(o))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ward_id", "window_start", "window_end", "total_kwh_consumed",
                          "avg_power_factor", "peak_voltage"]
    assert df.count() > 0
