"""Every registered query with an oracle equals DuckDB on the sf0.001 tables."""

import math

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
# streaming queries replay the tables through a running stream (slow); they are
# compared with the batch questions in test_streaming.py instead
BATCH_ORACLE = sorted(n for n in ORACLE if not n.startswith("stream_") and n != "sink_upsert_latest")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


@pytest.mark.parametrize("name", BATCH_ORACLE)
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck_small.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in res.fetchall()),
                  key=repr)
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_oracle_or_is_listed():
    # queries that SQL cannot state are listed here on purpose
    no_sql = {n for n in QUERIES if n not in ORACLE}
    assert no_sql == set(entry.NO_ORACLE)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "total_delay" in df.columns
