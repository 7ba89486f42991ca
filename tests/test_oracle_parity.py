"""Every registered query against its SQL oracle (DuckDB) on the small tables."""

import duckdb
import pytest

import __spark_entry__ as E
from civicspark.plans import catalog, load_queries, oracle
from civicspark.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle.SQL) == set(catalog.QUERIES)
    assert set(load_queries.SQL) == set(load_queries.QUERIES)


QUERIES, SQL = {**catalog.QUERIES, **load_queries.QUERIES}, {**oracle.SQL, **load_queries.SQL}


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(df.columns, srows, True) == rows_of(ocols, orows, True)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["borough", "n_days", "requests", "corr_temp",
                                             "population", "low_rate"]
