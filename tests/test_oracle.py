"""Every registered query against its DuckDB oracle (same rule as the
driver's gate: same column names, same rows in any order)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, duck_type, rows_of  # noqa: E402

from stardw import catalog  # noqa: E402

from paths import SF_SMALL  # noqa: E402

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert {c: duck_type(t) for c, t in sdf.dtypes} == types
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    assert rows_of(cols, srows) == rows_of(cols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
