"""Stored result tables: lookups prune buckets, push their filters, and can be opened by another session."""

from pyspark.sql import functions as F

from tarmac.operators.lookup import lookup_many, lookup_question
from tarmac.operators.trips import best_legs, both_periods, trips_of_offsets, two_leg_trips
from tarmac.plans.questions import answer, ranking
from tarmac.sinks.lookups import _name, open_lookup, write_lookup
from tarmac.sources.curated import curated_flights
from tests.conftest import SF_SMALL, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_point_lookup_opens_one_bucket(spark, tmp_path):
    result = answer(curated_flights(spark, SF_SMALL), "q2.4")
    path = write_lookup(result, str(tmp_path / "q24"), ["origin", "dest"])
    one = result.orderBy("origin", "dest").first()
    got = lookup_question(open_lookup(spark, path), "q2.4", one.origin, one.dest)
    assert [tuple(r) for r in got.select(*result.columns).collect()] == [tuple(one)]
    # pruning is shown only where the planner does not choose between bucketed and plain scans
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = _plan(lookup_question(open_lookup(spark, path), "q2.4", one.origin, one.dest))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in plan
    assert f"EqualTo(origin,{one.origin})" in plan and f"EqualTo(dest,{one.dest})" in plan
    assert lookup_question(open_lookup(spark, path), "q2.4", one.origin, "nowhere").count() == 0
    # as a later session would, without the table
    spark.sql(f"DROP TABLE {_name(path)}")
    assert rows(open_lookup(spark, path), result.columns) == rows(result, result.columns)


def test_many_keys_and_hot_first_key(spark, tmp_path):
    top = ranking(answer(curated_flights(spark, SF_SMALL), "q2.1"), "q2.1")
    path = write_lookup(top, str(tmp_path / "q21"), ["origin"], "delay")
    keys = [("NATION_0",), ("NATION_5",), ("NATION_0",), ("none",)]
    assert rows(lookup_many(open_lookup(spark, path), ["origin"], keys)) == rows(
        top.filter(F.col("origin").isin("NATION_0", "NATION_5")))
    hot = spark.range(500).select(F.lit("A").alias("origin"), F.col("id").cast("string").alias("dest"), "id")
    path = write_lookup(hot, str(tmp_path / "hot"), ["origin", "dest"])
    found = open_lookup(spark, path)
    assert found.count() == 500 and found.filter("origin = 'A' and dest = '77'").first().id == 77
    assert open_lookup(spark, write_lookup(hot.limit(0), str(tmp_path / "none"), ["origin"])).count() == 0


def test_trips_scan_flights_once(spark):
    flights = curated_flights(spark, SF_SMALL)
    trips = two_leg_trips(both_periods(flights))
    assert rows(trips) == rows(two_leg_trips(best_legs(flights)))
    trips.collect()
    final = _plan(trips).split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final


def test_offsets_in_one_join(spark):
    flights = curated_flights(spark, SF_SMALL)
    found = trips_of_offsets(both_periods(flights), [1, 2, 3])
    for d in (1, 2, 3):
        assert rows(found.filter(f"offset_days = {d}").drop("offset_days")) == rows(
            answer(flights, "q3", trip_offset_days=d))
