"""Two-leg trips: hand-written cases (ties, periods, offsets) and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from tarmac.operators.trips import best_legs, two_leg_trips
from tarmac.schema import FLIGHTS

D = dt.date(2008, 3, 4)
D2 = D + dt.timedelta(days=2)


def _flights(spark, rows):
    return spark.createDataFrame(rows, FLIGHTS)


def test_tie_on_delay_goes_to_earlier_departure(spark):
    f = _flights(spark, [
        (D, 2, "AA", "20", "CMI", "ORD", "0900", 0.0, 5.0),
        (D, 2, "UA", "10", "CMI", "ORD", "0700", 0.0, 5.0),   # same delay, earlier: wins
        (D, 2, "DL", "30", "CMI", "ORD", "0800", 0.0, 9.0),
    ])
    (row,) = best_legs(f).collect()
    assert (row.unique_carrier, row.flight_num, row.crs_dep_time) == ("UA", "10", "0700")


def test_trip_pairs_morning_with_afternoon_two_days_later(spark):
    f = _flights(spark, [
        (D, 2, "AA", "1", "CMI", "ORD", "0710", 0.0, 3.0),     # AM leg 1
        (D, 2, "AA", "2", "CMI", "ORD", "1300", 0.0, -9.0),    # PM on day 1: not a first leg
        (D2, 4, "UA", "3", "ORD", "LAX", "1950", 0.0, -2.0),   # PM leg 2
        (D2, 4, "UA", "4", "ORD", "LAX", "1000", 0.0, -20.0),  # AM on day 3: not a second leg
        (D2, 4, "UA", "5", "ORD", "SFO", "1200", 0.0, 1.0),    # 12:00 is afternoon
        (D + dt.timedelta(days=1), 3, "UA", "6", "ORD", "LAX", "1500", 0.0, -50.0),  # d+1
        (D, 2, "AA", "7", "CMI", "ORD", "0800", 0.0, None),    # cancelled: ignored
        (D2, 4, "UA", "8", "ORD", "LAX", "ab", 0.0, -60.0),   # bad time: ignored
    ])
    got = {(r.dest2, r.total_delay, r.flight1, r.flight2, r.datetime1, r.datetime2)
           for r in two_leg_trips(best_legs(f)).collect()}
    assert got == {
        ("LAX", 1.0, "AA 1", "UA 3", "2008-03-04 0710", "2008-03-06 1950"),
        ("SFO", 4.0, "AA 1", "UA 5", "2008-03-04 0710", "2008-03-06 1200"),
    }


def test_trip_plan_has_no_cartesian_and_one_exchange_for_join(spark):
    f = _flights(spark, [(D, 2, "AA", "1", "CMI", "ORD", "0710", 0.0, 3.0)])
    plan = two_leg_trips(best_legs(f))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "SortMergeJoin" in plan or "HashJoin" in plan


def test_offset_is_a_parameter(spark):
    d3 = D + dt.timedelta(days=3)
    f = _flights(spark, [
        (D, 2, "AA", "1", "CMI", "ORD", "0710", 0.0, 3.0),
        (d3, 5, "UA", "3", "ORD", "LAX", "1950", 0.0, -2.0),
    ])
    assert two_leg_trips(best_legs(f)).count() == 0
    (r,) = two_leg_trips(best_legs(f), offset_days=3).collect()
    assert r.dest2 == "LAX" and r.date1 == D


def test_result_independent_of_partitioning(spark):
    from tarmac.sources.curated import curated_flights
    from tests.conftest import SF_SMALL
    fl = curated_flights(spark, SF_SMALL)
    a = two_leg_trips(best_legs(fl))
    b = two_leg_trips(best_legs(fl.repartition(3, F.rand(7))))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
