"""Every analytics query vs its DuckDB oracle SQL at sf0.001 (names, row counts, values).

``tools/check_oracle.py`` does the same from the command line, for any key and size.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from clickforge.plans import catalog, oracle

SF001 = E.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    from tools.check_oracle import TABLES
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", list(oracle.queries()))
def test_query_matches_oracle(spark, con, key):
    from tools.check_oracle import canon
    df = E.queries()[key](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    drows = cur.fetchall()
    sc, sr = canon(df.columns, srows)
    dc, dr = canon([c[0] for c in cur.description], drows)
    assert sc == dc
    assert sr == dr


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
