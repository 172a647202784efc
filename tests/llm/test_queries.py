"""The queries with SQL against DuckDB, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from voxloom.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = Counter(tuple(map(str, (r[c] for c in columns))) for r in df.collect())
    assert got
    if sql := queries.oracle_sql().get(name):
        cursor = duck.execute(sql)
        names = [x[0] for x in cursor.description]
        assert got == Counter(tuple(str(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = queries.queries()[name](spark, str(DATA))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
