import glob
import math
import os

import duckdb
import pytest

from leafloom.plans import registry


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6)) if math.isfinite(v) else str(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_rows_equal_sql(spark, sf, con, name):
    df = registry.QUERIES[name](spark, sf)
    rows = [r.asDict(True) for r in df.collect()]
    assert len(df.columns) == len(set(df.columns))
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    got = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    want = [dict(zip(names, r, strict=True)) for r in got.fetchall()]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    assert sorted(str([plain(r[c]) for c in columns]) for r in rows) == sorted(str([plain(r[c]) for c in columns]) for r in want)


def test_entry_runs_the_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 20


def test_everything_is_registered():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
