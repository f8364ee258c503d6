"""Every query of the feed with SQL gives what an independent engine gives, on the smallest tables."""

import math

import duckdb
import pytest

from headway.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, engine, name):
    df = registry.queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    result = engine.execute(registry.oracle_sql()[name])
    columns = [x[0] for x in result.description]
    assert sorted(columns) == names
    want = [tuple(plain(r[columns.index(c)]) for c in names) for r in result.fetchall()]
    assert order(got) == order(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF_DIR).collect() is not None
