import os

import pytest

from folioforge.plans import demo

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for name in os.listdir(FOLDER):
        out.sql(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    return out


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    return round(v, 6) if isinstance(v, float) else str(v) if v is not None else None


@pytest.mark.parametrize("name", sorted(demo.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = demo.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    result = con.sql(demo.oracle_sql()[name])
    assert sorted(result.columns) == cols
    at = [result.columns.index(c) for c in cols]
    assert sorted(str([plain(r[c]) for c in cols]) for r in df.collect()) == sorted(str([plain(x[k]) for k in at]) for x in result.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["c_custkey", "c_name", "current_price", "current_priority", "in_events"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_ladder_looks_up_whole_tables(spark):
    found = [r.journal_id for r in demo.resolve_ladder(spark, FOLDER).select("journal_id").collect() if r.journal_id < 1_000_000_000]
    assert {j % 6 for j in found} == set(range(6))
