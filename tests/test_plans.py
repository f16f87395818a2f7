"""Physical-plan properties the design relies on."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # let AQE finalize
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_key_uses_window_group_limit(spark):
    plan = _plan(entry.queries()["q2_3_top10"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    df = entry.queries()["q1_2_carrier_arrival"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "unique_carrier" in scan and "arr_delay" in scan
    assert "origin" not in scan and "crs_dep_time" not in scan
    assert "PushedFilters: [IsNotNull(unique_carrier)" in scan or "IsNotNull(arr_delay)" in scan


def test_year_scan_prunes_partitions(spark):
    df = entry.queries()["scan_year_prune"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_means_aggregate_partially_before_the_shuffle(spark):
    plan = _plan(entry.queries()["q2_1_carrier_departure_by_origin"](spark, SF_SMALL))
    assert "partial_avg" in plan and "HashAggregate" in plan


def test_trips_have_no_cartesian_product(spark):
    plan = _plan(entry.queries()["q3_two_leg_trips"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
