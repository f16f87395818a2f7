"""Raw on-time CSV and the 9-field clean file: scans and curation.

Raw files: comma-separated, text quoted, a header in every file, a
trailing comma.  Spark's CSV reader handles the quoting (no comma
repair), pads short rows with NULLs (PERMISSIVE) and reads empty fields
as NULL.  Header lines, quoted or not, are dropped by value wherever they
stand, so a file without one loses no row.  Only the
columns a job selects are parsed (CSV column pruning).

A value that is absent and one that cannot be read are told apart on demand:
``read_raw(corrupt=...)`` keeps the line of a row whose number of fields is
wrong, and ``curate_raw(faults=...)`` lists the fields whose text is no value of
their type, beside the typed columns that hold NULL for both.

Clean files: ``;``-separated text with 9 fields; a surplus ``;`` stays
inside the last field (split with a limit of 9).

Gzip input is not splittable (one task per file): convert to Parquet
once with ``curate_raw(...)`` + ``tarmac.sinks.tables.write_flights``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.columns import minute_of_day, to_double, to_int
from tarmac.schema import CLEAN_COLUMNS, CLEAN_TO_FLIGHTS, RAW, RAW_COLUMNS, RAW_TAIL, \
    RAW_TO_FLIGHTS


# How a raw line is parsed, by the scan and by the archive reader alike.
CSV_OPTIONS = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def is_header(first_field: Column) -> Column:
    """Whether a line is a header, from its first field."""
    return F.coalesce(F.trim(first_field) == F.lit(RAW_COLUMNS[0]), F.lit(False))


_COMPLETE = [len(RAW_COLUMNS) - 1, len(RAW_COLUMNS)]


def _separators(line: str) -> Column:
    """Number of commas outside quotes."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))


def read_raw(spark: SparkSession, paths: str | list[str], path_glob: str | None = None,
             corrupt: str | None = None) -> DataFrame:
    """Scan raw CSV files (all columns text).

    ``corrupt`` names one more column, with the whole line where it has not the
    fields of the layout, with or without the comma at the end, and NULL
    elsewhere.  All columns of a line are parsed then.
    """
    reader = spark.read
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if corrupt is None:
        rows = reader.schema(RAW).option("header", False).options(**CSV_OPTIONS).csv(paths)
        return rows.filter(~is_header(F.col(RAW_COLUMNS[0])))
    lines = reader.text(paths).filter(F.trim("value") != F.lit(""))
    rows = lines.select(F.from_csv("value", RAW.simpleString(), CSV_OPTIONS).alias("r"),
                        F.when(~_separators("value").isin(_COMPLETE), F.col("value")).alias(corrupt))
    return rows.filter(~is_header(F.col("r")[RAW_COLUMNS[0]])).select("r.*", corrupt)


def _text(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != F.lit(""), t)


def _typed(df: DataFrame, mapping: dict[str, str], extra: list | tuple = ()) -> DataFrame:
    src = {v: k for k, v in mapping.items()}
    return df.select(
        F.col(src["flight_date"]).try_cast("date").alias("flight_date"),
        to_int(src["day_of_week"]).alias("day_of_week"),
        _text(F.col(src["unique_carrier"])).alias("unique_carrier"),
        _text(F.col(src["flight_num"])).alias("flight_num"),
        _text(F.col(src["origin"])).alias("origin"),
        _text(F.col(src["dest"])).alias("dest"),
        _text(F.col(src["crs_dep_time"])).alias("crs_dep_time"),
        to_double(src["dep_delay"]).alias("dep_delay"),
        to_double(src["arr_delay"]).alias("arr_delay"),
        *extra,
    )


def _faults(mapping: dict[str, str]) -> Column:
    """Structs (column, value) of the fields whose text is there but is no value of the column's type."""
    src = {v: k for k, v in mapping.items()}
    read = {c: conv(F.col(src[c])) for c, conv in READ_AS.items()}
    each = [F.when(_text(F.col(src[c])).isNotNull() & v.isNull(),
                   F.struct(F.lit(c).alias("column"), F.col(src[c]).alias("value"))) for c, v in read.items()]
    return F.array_compact(F.array(*each))


#: How the columns that are not plain text are read.
READ_AS = {"flight_date": lambda c: c.try_cast("date"), "day_of_week": to_int, "crs_dep_time": minute_of_day,
           "dep_delay": to_double, "arr_delay": to_double}


def curate_raw(raw: DataFrame, faults: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Raw rows -> curated flights (schema FLIGHTS).  Missing / unparsable -> NULL.

    Rows are not dropped here: each question drops the rows that miss one
    of *its* columns (``tarmac.operators.curate.require``).  ``faults`` names
    one more column: the unparsable fields, as structs of column and text
    (an empty array: none).  ``keep`` names columns of ``raw`` to go along.
    """
    extra = [_faults(RAW_TO_FLIGHTS).alias(faults)] if faults else []
    return _typed(raw, RAW_TO_FLIGHTS, [*extra, *(keep or [])])


def parse_clean(lines: DataFrame) -> DataFrame:
    """Text lines (``value``), of a table or a stream, into the 9 text columns."""
    parts = F.split(F.col("value"), ";", len(CLEAN_COLUMNS))
    return lines.select(*[F.get(parts, i).alias(c) for i, c in enumerate(CLEAN_COLUMNS)])


def read_clean(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Scan ';'-separated clean files into the 9 text columns."""
    return parse_clean(spark.read.text(paths))


def curate_clean(clean: DataFrame) -> DataFrame:
    """Clean 9-field rows -> curated flights (schema FLIGHTS)."""
    return _typed(clean, CLEAN_TO_FLIGHTS)


def _delay_text(c: str) -> Column:
    """'-4.00' style text; empty for a missing delay."""
    return F.when(F.col(c).isNotNull(), F.format_string("%.2f", F.col(c))).otherwise(F.lit(""))


def clean_lines(flights: DataFrame) -> DataFrame:
    """Curated flights -> one ';'-joined text line each (the clean format)."""
    fields = [F.col("flight_date").cast("string"), F.col("day_of_week").cast("string"),
              F.col("origin"), F.col("dest"), F.col("unique_carrier"), F.col("flight_num"),
              F.col("crs_dep_time"), _delay_text("dep_delay"), _delay_text("arr_delay")]
    return flights.select(F.concat_ws(";", *[F.coalesce(f, F.lit("")) for f in fields])
                          .alias("value"))


def raw_rows(flights: DataFrame) -> DataFrame:
    """Curated flights -> the 55 raw text columns (+ empty tail), others NULL."""
    src = {v: k for k, v in RAW_TO_FLIGHTS.items()}
    derived = {
        src["flight_date"]: F.col("flight_date").cast("string"),
        src["day_of_week"]: F.col("day_of_week").cast("string"),
        src["unique_carrier"]: F.col("unique_carrier"),
        src["flight_num"]: F.col("flight_num"),
        src["origin"]: F.col("origin"),
        src["dest"]: F.col("dest"),
        src["crs_dep_time"]: F.col("crs_dep_time"),
        src["dep_delay"]: _delay_text("dep_delay"),
        src["arr_delay"]: _delay_text("arr_delay"),
        "Year": F.year("flight_date").cast("string"),
        "Month": F.month("flight_date").cast("string"),
        "DayofMonth": F.dayofmonth("flight_date").cast("string"),
    }
    cols = [derived.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    return flights.select(*cols, F.lit(None).cast("string").alias(RAW_TAIL))


def write_raw_csv(flights: DataFrame, path: str) -> str:
    """Write flights in the raw CSV layout (header in every file)."""
    (raw_rows(flights).write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
    return path


def write_clean_text(flights: DataFrame, path: str) -> str:
    clean_lines(flights).write.mode("overwrite").text(path)
    return path
