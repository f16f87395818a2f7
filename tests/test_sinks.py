"""Writers: hot directories and keys, exports with exact means."""

import datetime
import glob
from decimal import Decimal

from pyspark.sql import functions as F

from tarmac.plans.base import exact_answers
from tarmac.schema import FLIGHTS
from tarmac.sinks.export import export_results, read_export
from tarmac.sinks.tables import write_partitioned, write_result
from tests.conftest import rows


def _hot(spark):
    return spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 90).cast("string"))).alias("k"),
        F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_a_hot_directory_is_split_over_files(spark, tmp_path):
    df, path = _hot(spark), str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitioned(df, path, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/k=hot/*.parquet")) > 4
    # but for those that share the hot one's hash partition, the others are one file each
    files = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/k=k*")]
    assert sum(n > 1 for n in files) <= len(files) / 3
    back = spark.read.parquet(path).select("k", "v", "text")
    assert back.exceptAll(df).isEmpty() and back.count() == df.count()


def test_a_hot_first_key_is_ranged_over_files(spark, tmp_path):
    path = write_result(_hot(spark), str(tmp_path / "r"), ["k", "text"], "v")
    spans = [tuple(r) for r in spark.read.parquet(path).filter("k = 'hot'").groupBy(F.input_file_name()).agg(
        F.min("v"), F.max("v")).select("min(v)", "max(v)").collect()]
    spans.sort()
    assert len(spans) > 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_export_does_not_hang_on_the_order_of_summation(spark, tmp_path):
    day = datetime.date(2008, 1, 1)
    delays = [0.1, 0.2, 0.3, 1e12, -1e12, 0.0005, None] * 50 + [-0.5, -0.0015]
    flights = spark.createDataFrame(
        [(day, 2, "AA", str(i), "A,\"x\"", "B", "0900", d, d) for i, d in enumerate(delays)], FLIGHTS)
    units = [int((Decimal(str(d)).quantize(Decimal("0.001"), "ROUND_HALF_UP")) * 1000) for d in delays if d is not None]
    total, n = sum(units), len(units)
    want = Decimal((2 * abs(total) + n) // (2 * n)).copy_sign(total) / 1000
    for parts in (1, 7):
        dealt = flights.repartition(parts)
        (r,) = exact_answers(dealt, ["q1.2"]).collect()
        assert r.delay == want and r.n_flights == n
    path = export_results(flights, str(tmp_path / "e"))
    told = {(r.question, r.key1, r.key2, r.key3): (r.delay, r.n_flights) for r in read_export(spark, path).collect()}
    assert told["q2.4", 'A,"x"', "B", None] == (str(want.quantize(Decimal("0.001"))), n)
    assert told["q1.1", "B", None, None] == (None, len(delays))
    assert rows(read_export(spark, export_results(flights.repartition(5), str(tmp_path / "e2")))) == rows(
        read_export(spark, path))
