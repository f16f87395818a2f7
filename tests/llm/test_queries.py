"""Registered queries: oracle parity, and the pipeline against its operators on the small tables."""

import duckdb
import pytest

import corpus_pipeline
from tarmac.llm import queries, sql
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(sql.ORACLE[name])
    names = [d[0] for d in want.description]
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    rows = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)


def test_pipeline_stages(spark):
    """Each stage keeps whole rows of its input and does what its operator says."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {tuple(r) for r in docs.collect()}
        out = corpus_pipeline.materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen[name] = (docs.count(), out.count())
        if i < 4:
            assert out.columns == columns and {tuple(r) for r in out.collect()} <= before
        docs = out
    judged = queries.op7_quality_rules(spark, SF_SMALL).filter("kept").count()
    assert seen["quality"][1] == judged
    assert seen["exact"][1] <= seen["exact"][0] and seen["near"][1] <= seen["near"][0]
    assert seen["pieces"][0] == seen["pieces"][1] and docs.filter("not round_trip").count() == 0


def test_exact_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.exact_stage(spark, docs, SF_SMALL).collect()
    first = {}
    for r in docs.collect():
        key = " ".join([""] + r.text.split() + [""]) if r.text != r.text.strip() else " ".join(r.text.split())
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in out} == set(first.values())
