"""Streaming questions: final stream tables equal batch tables; late data is counted."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tarmac.operators.trips import best_legs
from tarmac.plans import oracle
from tarmac.plans.base import answers, base_aggregate
from tarmac.plans.questions import answer
from tarmac.sources.curated import curated_flights
from tarmac.sources.raw import write_clean_text, write_raw_csv
from tarmac.streaming import folder, pace, runner, sinks, source
from tarmac.streaming.pace import Pace
from tarmac.streaming.source import STREAM_SCHEMA, Replay
from tests.conftest import SF_SMALL, duck_rows, rows


@pytest.fixture(scope="module")
def flights(spark):
    return curated_flights(spark, SF_SMALL)


def _same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_stream_means_equal_batch(spark, flights, mode):
    got = runner.run_question(spark, flights, "q2.1", mode)
    assert _same(got, answer(flights, "q2.1"))


def test_stream_popularity_equals_batch(spark, flights):
    got = runner.run_question(spark, flights, "q1.1", "update")
    assert _same(got, answer(flights, "q1.1"))


def test_shared_scan_equals_separate_questions(spark, flights):
    tables = runner.run_all_questions(spark, flights)
    for name in tables:
        assert _same(tables[name], answer(flights, name))


def test_event_time_trips_equal_batch(spark, flights):
    assert _same(runner.run_best_legs(spark, flights), best_legs(flights))
    assert _same(runner.run_trips(spark, flights), answer(flights, "q3"))


def test_out_of_order_slices_are_dropped(spark, flights, duck_small):
    got = runner.run_late_data(spark, flights, slice_by="year")
    assert 0 < got.count() < best_legs(flights).count()
    cols = sorted(got.columns)
    assert rows(got, cols) == duck_rows(duck_small, oracle.late_legs_sql(), cols)


def test_undated_flights_stay_in_a_stream(spark):
    fl = spark.createDataFrame(
        [("2008-01-01", "A", "B"), ("2009-01-01", "A", "B"), (None, "A", "B")],
        "d string, origin string, dest string").selectExpr(
        "cast(d as date) flight_date", "1 day_of_week", "'C' unique_carrier", "'1' flight_num", "origin",
        "dest", "'0900' crs_dep_time", "0.0D dep_delay", "0.0D arr_delay")
    got = runner.run_question(spark, fl, "q1.1")
    assert {r.airport: r.cnt for r in got.collect()} == {"A": 3, "B": 3}
    assert runner.run_question(spark, fl.limit(0), "q1.1").count() == 0


def test_a_run_folder_is_added_to_and_resumed(spark, tmp_path):
    one = spark.createDataFrame([(y,) for y in range(2008, 2012)], "y int").selectExpr(
        "make_date(y, 1, 1) flight_date", "1 day_of_week", "'C' unique_carrier", "'1' flight_num",
        "'A' origin", "'B' dest", "'0900' crs_dep_time", "0.0D dep_delay", "0.0D arr_delay")
    first, rest = one.filter("flight_date < '2010-01-01'"), one.filter("flight_date >= '2010-01-01'")
    run = lambda df, **k: {r.airport: r.cnt for r in runner.run_question(
        spark, df, "q1.1", run_dir=str(tmp_path), **k).collect()}
    assert run(first) == {"A": 2, "B": 2}
    assert run(rest) == {"A": 4, "B": 4}
    assert run(one, resume=True) == {"A": 4, "B": 4}  # every slice is staged already


def test_upsert_is_idempotent_per_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    b0 = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "k string, v double")
    b1 = spark.createDataFrame([("B", 5.0), ("C", 3.0)], "k string, v double")
    sinks.upsert(b0, 0, table, ["k"])
    sinks.upsert(b1, 1, table, ["k"])
    sinks.upsert(b1, 1, table, ["k"])  # replayed batch
    got = {r.k: r.v for r in sinks.read_table(spark, table).collect()}
    assert got == {"A": 1.0, "B": 5.0, "C": 3.0}


@pytest.mark.parametrize("run", ["run_best_legs", "run_trips"])
def test_state_is_dealt_by_cores_and_size(spark, tmp_path, run):
    """Many shuffle partitions are not as many state stores, and the setting stays as it was."""
    fl = spark.createDataFrame(
        [(f"200{y}-01-0{d}", a, b, t) for y in (8, 9) for d in (1, 3) for a, b, t in
         (("A", "B", "0900"), ("B", "C", "1500"))], "d string, origin string, dest string, crs_dep_time string").selectExpr(
        "cast(d as date) flight_date", "1 day_of_week", "'C' unique_carrier", "'1' flight_num", "origin",
        "dest", "crs_dep_time", "0.0D dep_delay", "1.0D arr_delay")
    held, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 5))
    try:
        got = getattr(runner, run)(spark, fl, run_dir=str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores + 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert _same(got, best_legs(fl) if run == "run_best_legs" else answer(fl, "q3")) and got.count()
    for op in glob.glob(f"{tmp_path}/checkpoint/state/*"):
        assert len([n for n in os.listdir(op) if n.isdigit()]) == cores


def test_much_input_at_once_gets_more_state_partitions(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    with pace.state_partitions(spark, 1000 * pace.STATE_BYTES + 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1001"
    assert spark.conf.get("spark.sql.shuffle.partitions") == held


def test_all_slices_are_staged_in_one_pass(spark, flights, tmp_path):
    """The flights are read once, not once a slice; a watched folder gets whole slices one by one."""
    replay = Replay(flights, f"{tmp_path}/stage")
    first, second, *rest = replay.keys
    replay.write_slice(first)
    aside = replay.stage()
    assert sorted(os.path.basename(p) for p in glob.glob(f"{aside}/at=*")) == [f"at={k}" for k in (second, *rest)]
    assert os.listdir(replay.stage_dir) == [f"00000-{first}"]
    replay.write_slice(second)
    for k in rest:
        replay.write_slice(k)
    got = spark.read.schema(STREAM_SCHEMA).parquet(f"{replay.stage_dir}/*/*.parquet")
    assert _same(got.select(*flights.columns), flights)
    assert got.filter("slice is null or slice != cast(year(flight_date) as string)").count() == 0


def test_a_staged_slice_is_cut_into_row_groups_without_the_event_time(spark, flights, tmp_path, monkeypatch):
    """A slice in one file is still read by many tasks, and questions without event time do not take it."""
    monkeypatch.setattr(source, "GROUP_BYTES", 4_000)
    replay = Replay(flights.coalesce(1), f"{tmp_path}/stage")
    file, = glob.glob(f"{replay.stage()}/at={replay.keys[1]}/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
    assert "ts" not in pq.ParquetFile(file).schema_arrow.names
    for k in replay.keys:
        replay.write_slice(k)
    replay.write_sentinel()
    stream = source.read_stream(spark, replay.stage_dir)
    assert stream.schema.names == STREAM_SCHEMA.names
    run = (stream.writeStream.trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/out")
           .option("checkpointLocation", f"{tmp_path}/checkpoint").start())
    run.awaitTermination()
    got = spark.read.schema(STREAM_SCHEMA).parquet(f"{tmp_path}/out")
    assert _same(got.filter("slice != 'sentinel'").select(*flights.columns, "ts"), source.with_event_time(flights))
    assert sorted(r[0] for r in got.filter("slice = 'sentinel'").select(F.hour("ts")).collect()) == [0, 12]


# --- sinks that live long --------------------------------------------------------------

def test_a_table_stays_small_over_many_batches(spark, tmp_path):
    """Many batches of few keys: bounded manifests and versions, the latest row of every key."""
    table, want = str(tmp_path / "t"), {}
    for i in range(12):
        rows = [(f"k{(i * 7 + j) % 40}", i) for j in range(2)]
        want.update(rows)
        sinks.upsert(spark.createDataFrame(rows, "k string, v long").coalesce(1), i, table, ["k"], buckets=4)
    assert {r.k: r.v for r in sinks.read_table(spark, table).collect()} == want
    assert sinks.versions(spark, table) == [10, 11]
    assert len(os.listdir(f"{table}/data")) <= 4 + 2
    # of a replayed batch only its own buckets are written again, from the state before it
    sinks.upsert(spark.createDataFrame([("k0", -1)], "k string, v long"), 11, table, ["k"], buckets=4)
    assert sinks.read_table(spark, table).filter("v = -1").count() == 1


def test_upsert_of_null_keys_and_empty_batches(spark, tmp_path):
    table = str(tmp_path / "t")
    for i, rows in enumerate([[], [(None, 1), ("a", 2)], [(None, 3)], []]):
        sinks.upsert(spark.createDataFrame(rows, "k string, v long"), i, table, ["k"])
    assert {r.k: r.v for r in sinks.read_table(spark, table).collect()} == {None: 3, "a": 2}
    sinks.replace(spark.createDataFrame([], "k string, v long"), 4, table)
    assert sinks.read_table(spark, table).count() == 0


# --- folders of files ------------------------------------------------------------------

def _lots(flights, path, n=6):
    """``n`` clean files of about a sixth of the flights each."""
    for k in range(n):
        write_clean_text(flights.filter(F.abs(F.hash("flight_num")) % n == k).coalesce(1), f"{path}/{k}")
    return f"{path}/*"


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_a_folder_is_worked_through_in_bounded_batches(spark, flights, tmp_path, mode):
    files = _lots(flights, str(tmp_path / "in"))
    run = lambda: folder.start_question(spark, files, "q2.3", str(tmp_path / "run"), mode,
                                        Pace(available_now=True, max_files=2))
    job = run()
    assert _same(job.wait(), answer(flights, "q2.3"))
    sizes = job.progress.rows()
    assert len(sizes) == 3 and sum(sizes) == flights.count() and max(sizes) < flights.count()
    # started again, it reads nothing twice, and then only what has come
    again = run()
    assert _same(again.wait(), answer(flights, "q2.3")) and again.progress.rows() == []
    write_clean_text(flights.limit(10).coalesce(1), str(tmp_path / "in" / "new"))
    more = run()
    more.wait()
    assert more.counters()["input_rows"] == 10


def test_bytes_bound_a_batch_under_an_interval(spark, flights, tmp_path):
    files = _lots(flights, str(tmp_path / "in"))
    job = folder.start_question(spark, files, "q1.1", str(tmp_path / "run"),
                                pace=Pace(interval="200 milliseconds", max_bytes=1))
    try:
        assert _same(job.wait(), answer(flights, "q1.1"))
        assert len(job.progress.rows()) == 6  # a file at least in each
    finally:
        job.stop()
    with pytest.raises(ValueError):
        Pace(interval="1 second", available_now=True)


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_all_questions_over_a_folder(spark, flights, tmp_path, mode):
    files = _lots(flights, str(tmp_path / "in"), 2)
    job = folder.start_all_questions(spark, files, str(tmp_path / "run"), mode,
                                     Pace(available_now=True, max_files=1))
    got = job.wait()
    assert _same(got, answers(base_aggregate(flights)))
    assert len(sinks.versions(spark, str(tmp_path / "run" / "answers"))) == (2 if mode == "update" else 1)


def test_best_legs_over_a_folder_and_done_files_are_archived(spark, flights, tmp_path):
    for y in (1996, 1997, 1998):
        write_clean_text(flights.filter(F.year("flight_date") == y).coalesce(1), str(tmp_path / "in" / str(y)))
    job = folder.start_best_legs(spark, f"{tmp_path}/in/*", str(tmp_path / "run"),
                                 pace=Pace(available_now=True, max_files=1), archive_dir=str(tmp_path / "done"))
    got = job.wait()
    last = flights.filter(F.year("flight_date") == 1998).agg(F.max("flight_date")).first()[0]
    want = best_legs(flights.filter(F.year("flight_date").between(1996, 1998))).filter(F.col("flight_date") < last)
    assert _same(got, want)
    assert glob.glob(f"{tmp_path}/done/**/*.txt", recursive=True)


def test_raw_files_as_a_stream(spark, flights, tmp_path):
    write_raw_csv(flights, str(tmp_path / "in" / "a"))
    job = folder.start_question(spark, f"{tmp_path}/in/*", "q1.3", str(tmp_path / "run"),
                                pace=Pace(available_now=True), kind="raw", path_glob="*.csv")
    assert _same(job.wait(), answer(flights, "q1.3"))


# --- late flights ----------------------------------------------------------------------

def test_late_flights_are_counted_and_kept(spark, flights, duck_small):
    legs, late, counts = runner.run_late_flights(spark, flights)
    assert rows(legs, sorted(legs.columns)) == duck_rows(duck_small, oracle.late_legs_sql(), sorted(legs.columns))
    by_year = duck_small.execute(oracle.late_flights_sql()).fetchall()
    assert counts == {"flights": flights.count(), "late": sum(n for _, n in by_year), "undated": 0}
    assert late.count() == counts["late"]
