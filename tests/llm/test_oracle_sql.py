import duckdb
import pytest

from claimsmith.llm import oracle
from claimsmith.llm.queries import queries
from tests.llm.conftest import SF0001


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    want = con.sql(oracle.oracle_sql()[key])
    got = queries()[key](spark, SF0001)
    assert sorted(got.columns) == sorted(want.columns)
    cell = lambda v: f"{v:.9f}" if isinstance(v, float) else str(v)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted([cell(v) for v in r] for r in got.collect()) == sorted([cell(r[i]) for i in order] for r in want.fetchall())
