import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    import duckdb
    from tarmac.sources.testdata import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(df, cols=None):
    """Sorted tuples of a Spark DataFrame (order-insensitive comparisons)."""
    cols = cols or sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql, cols):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    return sorted((tuple(dict(zip(names, r))[c] for c in cols) for r in res.fetchall()), key=repr)
