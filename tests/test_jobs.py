"""Batch jobs write keyed result tables that equal the questions."""

from tarmac.operators.lookup import lookup_many, lookup_question
from tarmac.plans.jobs import ingest_raw, run_batch
from tarmac.plans.questions import answer
from tests.test_sources import RAW


def test_ingest_and_run_batch(spark, tmp_path):
    fl = ingest_raw(spark, RAW, str(tmp_path / "flights"))
    assert fl.count() == 12
    paths = run_batch(fl, str(tmp_path / "results"))
    assert set(paths) == {"q1.1", "q1.2", "q1.3", "q2.1", "q2.2", "q2.3", "q2.4", "q3"}
    q12 = spark.read.parquet(paths["q1.2"])
    assert {r.unique_carrier: r.delay for r in q12.collect()} == {"AA": 11.0, "UA": 3.0}
    top = spark.read.parquet(paths["q2.1"] + "_top")
    got = lookup_many(top, ["origin"], [("CMI",), ("NOPE",)]).collect()
    assert {r.origin for r in got} == {"CMI"}
    route = lookup_question(spark.read.parquet(paths["q2.4"]), "q2.4", "CMI", "ORD").collect()
    assert len(route) == 1 and route[0].n_flights == 7
    assert spark.read.parquet(paths["q3"]).count() == answer(fl, "q3").count()
