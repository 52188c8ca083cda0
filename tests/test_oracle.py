"""Every registered query against its DuckDB oracle on the smallest scale
factor (the driver repeats this at sf0.01)."""

import sys

import duckdb
import pytest

import __spark_entry__ as E
from zonelake.plans.registry import registered

sys.path.insert(0, "tools")
from check_oracle import TABLES, rows_of  # noqa: E402

@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, sf_small, name):
    sdf = E.queries()[name](spark, sf_small).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    sc, sr = rows_of(sdf)
    oc, orows = rows_of(odf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows


def test_every_query_has_a_stable_schema(spark, sf_small):
    for name, fn in registered().items():
        df = fn(spark, sf_small)
        assert df.columns and len(df.columns) == len(set(df.columns)), name
        assert df.schema == fn(spark, sf_small).schema, name


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "percent_change" in df.columns
