"""Raw CSV, clean file and zip archive sources, on hand-written inputs."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tarmac.operators.lookup import lookup_many, lookup_question
from tarmac.operators.curate import quality_counts
from tarmac.plans.questions import answer, question_input
from tarmac.sources import archives, raw
from tarmac.sources.archives import read_archives
from tarmac.sources.raw import curate_clean, curate_raw, read_clean, read_raw

from tests.conftest import rows

FIX = os.path.join(os.path.dirname(__file__), "fixtures")
RAW = os.path.join(FIX, "raw_sample.csv")


@pytest.fixture(scope="module")
def raw_flights(spark):
    return curate_raw(read_raw(spark, RAW)).persist()


def test_raw_scan_drops_headers_and_keeps_short_rows(spark, raw_flights):
    assert raw_flights.count() == 12
    short = raw_flights.filter(F.col("flight_num") == "111").collect()[0]
    assert short.origin is None and short.arr_delay is None


def test_quoted_city_with_comma_does_not_shift_columns(spark):
    r = read_raw(spark, RAW).filter(F.col("FlightNum") == "100").collect()[0]
    assert r.OriginCityName == "Champaign, IL" and r.Origin == "CMI" and r.Dest == "ORD"


def test_q1_1_counts_cancelled_flights_and_loops_twice(raw_flights):
    got = {r.airport: r.cnt for r in answer(raw_flights, "q1.1").collect()}
    assert got == {"CMI": 9, "ORD": 11}


def test_q1_2_drops_missing_and_non_numeric_delays(raw_flights):
    got = {r.unique_carrier: (r.delay, r.n_flights) for r in answer(raw_flights, "q1.2").collect()}
    assert got == {"AA": (11.0, 5), "UA": (3.0, 4)}


def test_q1_3_drops_weekdays_out_of_range(raw_flights):
    (r,) = answer(raw_flights, "q1.3").collect()
    assert r.weekday == "Thursday" and r.n_flights == 7
    assert r.delay == pytest.approx(47 / 7)


def test_required_columns_are_per_question(raw_flights):
    assert question_input(raw_flights, "q1.1").count() == 10
    assert question_input(raw_flights, "q2.4").count() == 8


def test_clean_file_split_keeps_surplus_in_last_field(spark):
    clean = read_clean(spark, os.path.join(FIX, "clean_sample.txt"))
    rows = {r.flight: r for r in clean.collect()}
    assert rows["200"].arr_delay == "-2.00;extra"
    assert rows["101"].dep_delay == "" and rows["101"].arr_delay == ""
    typed = {r.flight_num: r for r in curate_clean(clean).collect()}
    assert typed["100"].arr_delay == 10.0 and typed["101"].arr_delay is None
    assert typed["200"].arr_delay is None  # "-2.00;extra" is not a number


def _zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_archive_ingest_skips_html_and_keeps_same_named_archives(spark, tmp_path):
    csv_text = open(RAW).read()
    _zip(str(tmp_path / "a" / "On_Time_2008_1.zip"),
         {"On_Time_2008_1.csv": csv_text, "readme.html": "<html>not data</html>"})
    _zip(str(tmp_path / "b" / "On_Time_2008_1.zip"), {"On_Time_2008_1.csv": csv_text})
    rows = read_archives(spark, str(tmp_path))
    per_file = {r.source_file.rsplit("/", 2)[-2]: r.n for r in
                rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_file == {"a": 12, "b": 12}
    assert rows.filter(F.col("member").endswith(".html")).count() == 0
    fl = curate_raw(rows)
    got = {r.unique_carrier: (r.delay, r.n_flights) for r in answer(fl, "q1.2").collect()}
    assert got == {"AA": (11.0, 10), "UA": (3.0, 8)}


@pytest.mark.parametrize("header", ["", "Year,Quarter,Month\n", '"Year","Quarter"\n'])
def test_headers_are_found_by_value_in_both_readers(spark, tmp_path, header):
    line = lambda y: ",".join([str(y)] + [f'"v{i}"' for i in range(1, 55)]) + ",\n"
    text = header + line(2008) + header + line(2009) + line(2010)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text(text)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as zf:
        zf.writestr("a.csv", text)
    columns = ["Year", "Origin", "ArrDelay"]
    plain = rows(raw.read_raw(spark, str(tmp_path / "raw")).select(*columns))
    assert [r[2] for r in plain] == ["2008", "2009", "2010"]
    assert rows(archives.read_archives(spark, str(tmp_path)).select(*columns)) == plain


def test_lookups_refuse_unknown_parameters_and_keep_types(spark):
    table = spark.createDataFrame([("2008-01-01", "A")], "d string, origin string").selectExpr(
        "cast(d as date) date1", "origin")
    with pytest.raises(ValueError):
        lookup_question(table, "q2.4", orig="A")
    got = lookup_many(table, ["date1"], [("2008-01-01",), ("2008-01-02",)])
    assert got.schema == table.schema and got.count() == 1


def test_absent_and_unparsable_fields_differ(spark, tmp_path):
    line = open(RAW).read().splitlines()
    (tmp_path / "a.csv").write_text("\n".join(line) + "\n\n")
    got = read_raw(spark, str(tmp_path), corrupt="bad line")
    assert rows(got.drop("bad line")) == rows(read_raw(spark, RAW))
    short = [r["bad line"] for r in got.collect() if r["bad line"] is not None]
    assert len(short) == 1 and short[0] in line
    fl = curate_raw(got, faults="why", keep=["bad line"])
    assert rows(fl.drop("why", "bad line")) == rows(curate_raw(read_raw(spark, RAW)))
    told = [tuple(f) for r in fl.collect() for f in r.why]
    assert ("crs_dep_time", "ab") in told and all(v.strip() for _, v in told)
    (n,) = quality_counts(fl, ["arr_delay", "crs_dep_time"], faults="why", corrupt="bad line").collect()
    assert n.rows == 12 and n.corrupt_lines == 1
    assert n.unparsable_crs_dep_time == sum(c == "crs_dep_time" for c, _ in told)
    assert n.unparsable_arr_delay == sum(c == "arr_delay" for c, _ in told) > 0
    gone = fl.filter("arr_delay is null").count()
    assert n.missing_arr_delay + n.unparsable_arr_delay == gone


def test_a_large_archive_is_inflated_by_many_tasks(spark, tmp_path):
    text = open(RAW).read()
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as zf:
        for i in range(40):
            zf.writestr(f"{i}.csv", text, [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2][i % 3])
        zf.writestr("empty.csv", "")
        zf.writestr("folder/", "")
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for name in sizes:
        spark.conf.set(name, "1k")
    try:
        lines = archives.archive_lines(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len({r.task for r in lines}) > 4
    assert len(lines) == 40 * len(text.splitlines())
    assert {r.member for r in lines} == {f"{i}.csv" for i in range(40)}


def test_a_damaged_member_fails_the_job(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as zf:
        zf.writestr("a.csv", "some text that is stored as it is\n")
    raw_bytes = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(raw_bytes.replace(b"stored", b"storad"))
    with pytest.raises(Exception, match="CRC"):
        archives.archive_lines(spark, str(tmp_path)).collect()
