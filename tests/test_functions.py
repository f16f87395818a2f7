from pyspark.sql import functions as F

from tarmac.functions.columns import day_period, minute_of_day, to_double, weekday_name


def test_minute_of_day_and_period(spark):
    cases = ["0000", "1159", "1200", "2400", "930", "5", "ab", "", None, "12345", " 0730 "]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r.t: (r.m, r.p) for r in df.select(
        "t", minute_of_day("t").alias("m"), day_period(minute_of_day("t")).alias("p")).collect()}
    assert got["0000"] == (0, "AM")
    assert got["1159"] == (719, "AM")
    assert got["1200"] == (720, "PM")
    assert got["2400"] == (1440, "PM")
    assert got["930"] == (570, "AM")
    assert got["5"] == (5, "AM")
    assert got["ab"] == (None, None)
    assert got[""] == (None, None)
    assert got[None] == (None, None)
    assert got["12345"] == (None, None)
    assert got[" 0730 "] == (450, "AM")


def test_weekday_name_out_of_range_is_null(spark):
    df = spark.createDataFrame([(str(i),) for i in range(0, 9)] + [("x",)], "d string")
    got = {r.d: r.n for r in df.select("d", weekday_name("d").alias("n")).collect()}
    assert got["1"] == "Monday" and got["7"] == "Sunday"
    assert got["0"] is None and got["8"] is None and got["x"] is None


def test_to_double_is_lenient(spark):
    df = spark.createDataFrame([("-4.00",), ("",), ("abc",), (None,), ("12",)], "s string")
    got = [r.v for r in df.select(to_double("s").alias("v")).collect()]
    assert got == [-4.0, None, None, None, 12.0]
    assert dict(df.select(to_double(F.col("s")).alias("v")).dtypes)["v"] == "double"


def test_presentation_functions(spark):
    from decimal import Decimal

    from tarmac.functions.columns import format_delay, round3, to_decimal3
    df = spark.createDataFrame([(30.850746268656717,)], "d double")
    r = df.select(round3("d").alias("r"), to_decimal3("d").alias("x"),
                  format_delay("d").alias("t"), format_delay("d", 2).alias("t2")).collect()[0]
    assert r.r == 30.851 and r.x == Decimal("30.851") and r.t == "30.851" and r.t2 == "30.85"
