"""Schemas: raw on-time CSV, the 9-field clean file, the curated flight
table and the eight result tables with their keys.  Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The 55 columns of the public On-Time Performance CSV, in file order.
RAW_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "UniqueCarrier",
    "AirlineID", "Carrier", "TailNum", "FlightNum", "Origin", "OriginCityName", "OriginState",
    "OriginStateFips", "OriginStateName", "OriginWac", "Dest", "DestCityName", "DestState",
    "DestStateFips", "DestStateName", "DestWac", "CRSDepTime", "DepTime", "DepDelay",
    "DepDelayMinutes", "DepDel15", "DepartureDelayGroups", "DepTimeBlk", "TaxiOut",
    "WheelsOff", "WheelsOn", "TaxiIn", "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes",
    "ArrDel15", "ArrivalDelayGroups", "ArrTimeBlk", "Cancelled", "CancellationCode",
    "Diverted", "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance",
    "DistanceGroup", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
]
# Published files end each line with a comma: one more, empty, column.
RAW_TAIL = "_tail"
RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS + [RAW_TAIL]])

# The 9 ';'-separated fields of the clean stream file, in order.
CLEAN_COLUMNS = ["date", "dow", "origin", "dest", "carrier", "flight", "dep_time",
                 "dep_delay", "arr_delay"]
CLEAN = T.StructType([T.StructField(c, T.StringType(), True) for c in CLEAN_COLUMNS])

# The curated flight table every question reads.
FLIGHTS = T.StructType([
    T.StructField("flight_date", T.DateType(), True),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("unique_carrier", T.StringType(), True),
    T.StructField("flight_num", T.StringType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("dest", T.StringType(), True),
    T.StructField("crs_dep_time", T.StringType(), True),
    T.StructField("dep_delay", T.DoubleType(), True),
    T.StructField("arr_delay", T.DoubleType(), True),
])
FLIGHT_COLUMNS = [f.name for f in FLIGHTS.fields]

# Raw column -> curated column (what the curation step selects and renames).
RAW_TO_FLIGHTS = {
    "FlightDate": "flight_date",
    "DayOfWeek": "day_of_week",
    "UniqueCarrier": "unique_carrier",
    "FlightNum": "flight_num",
    "Origin": "origin",
    "Dest": "dest",
    "CRSDepTime": "crs_dep_time",
    "DepDelay": "dep_delay",
    "ArrDelay": "arr_delay",
}
CLEAN_TO_FLIGHTS = {
    "date": "flight_date",
    "dow": "day_of_week",
    "carrier": "unique_carrier",
    "flight": "flight_num",
    "origin": "origin",
    "dest": "dest",
    "dep_time": "crs_dep_time",
    "dep_delay": "dep_delay",
    "arr_delay": "arr_delay",
}


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_STR, _DBL, _LNG = T.StringType(), T.DoubleType(), T.LongType()

# Result tables: schema and primary key (key = group columns).
RESULTS: dict[str, tuple[T.StructType, list[str]]] = {
    "q1.1": (_s(("airport", _STR), ("cnt", _LNG)), ["airport"]),
    "q1.2": (_s(("unique_carrier", _STR), ("delay", _DBL), ("n_flights", _LNG)), ["unique_carrier"]),
    "q1.3": (_s(("weekday", _STR), ("delay", _DBL), ("n_flights", _LNG)), ["weekday"]),
    "q2.1": (_s(("origin", _STR), ("unique_carrier", _STR), ("delay", _DBL), ("n_flights", _LNG)),
             ["origin", "unique_carrier"]),
    "q2.2": (_s(("origin", _STR), ("dest", _STR), ("delay", _DBL), ("n_flights", _LNG)),
             ["origin", "dest"]),
    "q2.3": (_s(("origin", _STR), ("dest", _STR), ("unique_carrier", _STR), ("delay", _DBL),
                ("n_flights", _LNG)), ["origin", "dest", "unique_carrier"]),
    "q2.4": (_s(("origin", _STR), ("dest", _STR), ("delay", _DBL), ("n_flights", _LNG)),
             ["origin", "dest"]),
    "q3": (_s(("date1", T.DateType()), ("origin", _STR), ("dest1", _STR), ("dest2", _STR),
              ("total_delay", _DBL), ("datetime1", _STR), ("flight1", _STR),
              ("datetime2", _STR), ("flight2", _STR)), ["date1", "origin", "dest1", "dest2"]),
}


def result_key(question: str) -> list[str]:
    return list(RESULTS[question][1])
