"""Every query of the library against its DuckDB oracle on the smallest scale factor.

The queries share one context, so the episode chain is built and stored once.
"""

import duckdb
import pytest

from claimsmith import queries as Q
from conftest import SF0001
from oracle.queries import oracle_sql
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def context(spark):
    return Q.Ctx(spark, SF0001)


@pytest.fixture(scope="module")
def sql():
    return oracle_sql()


@pytest.mark.parametrize("key", sorted(Q.QUERY_FUNCS))
def test_query_matches_oracle(duck, context, sql, key):
    sdf = Q.normalize(Q.QUERY_FUNCS[key](context))
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(sql[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows)[0] == digest(ocols, orows)[0]


def test_every_key_has_an_oracle(sql):
    assert set(Q.QUERY_FUNCS) == set(sql) and len(sql) >= 120


def test_entry_registers_every_key_and_its_oracle():
    import __spark_entry__ as E
    assert set(Q.QUERY_FUNCS) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"INDV_ID", "ADMIT", "DSCHRG", "COST_PER_DAY", "MEDIAN_ALL_FACILITY_COST"} <= set(df.columns)
