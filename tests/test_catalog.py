"""Every query with SQL against DuckDB on the smallest tables; the others give rows of a stable schema."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from voxloom.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql:
        cursor = duck.execute(sql)
        names = [x[0] for x in cursor.description]
        assert sorted(names) == columns
        assert got == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = catalog.queries()[name](spark, str(DATA))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("rows_capped", "LessThan(row_index,25)", 5), ("length_filter", "GreaterThanOrEqual(audio_size,16000)", 4), ("pinned_source", "EqualTo(source,", 5),
        ("pending_reviews", "EqualTo(split,train)", 4), ("mixture_weights", "EqualTo(split,train)", 3),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    plan = catalog.queries()[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan
    schema = plan[plan.rindex("ReadSchema: struct<") :].split(">")[0]
    assert schema.count(":") - 1 <= columns, schema
