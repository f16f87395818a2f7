"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement defines the ``flights`` view over the pre-registered test
tables as a CTE and then states the question in plain SQL.  Column names
and types match the Spark results one for one.
"""

from __future__ import annotations

import random

from tarmac.sources.testdata import FLIGHTS_SQL


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([FLIGHTS_SQL.strip()] + [c.strip() for c in ctes]) + "\n"


def present(*cols: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"{c} IS NOT NULL")
    return " AND ".join(parts)


def text_present(*cols: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND trim({c}) <> ''" for c in cols)


WEEKDAY_SQL = ("CASE day_of_week WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' "
               "WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' "
               "WHEN 6 THEN 'Saturday' WHEN 7 THEN 'Sunday' END")

MINUTE_SQL = ("CASE WHEN regexp_full_match(crs_dep_time, '\\s*[0-9]{1,4}\\s*') "
              "THEN (CAST(trim(crs_dep_time) AS INTEGER) // 100) * 60 "
              "+ CAST(trim(crs_dep_time) AS INTEGER) % 100 END")

Q11 = _with(f"""
endpoints AS (
  SELECT origin AS airport FROM flights WHERE {text_present('origin', 'dest')}
  UNION ALL
  SELECT dest AS airport FROM flights WHERE {text_present('origin', 'dest')}
)""") + "SELECT airport, CAST(count(*) AS BIGINT) AS cnt FROM endpoints GROUP BY airport"


def mean_sql(keys: list[str], measure: str, text_keys: list[str] | None = None) -> str:
    text_keys = keys if text_keys is None else text_keys
    k = ", ".join(keys)
    where = " AND ".join(x for x in [text_present(*text_keys), present(measure)] if x)
    return (_with() + f"SELECT {k}, avg({measure}) AS delay, CAST(count(*) AS BIGINT) AS n_flights "
            f"FROM flights WHERE {where} GROUP BY {k}")


Q12 = mean_sql(["unique_carrier"], "arr_delay")
Q13 = (_with(f"""
wd AS (SELECT {WEEKDAY_SQL} AS weekday, arr_delay FROM flights
       WHERE day_of_week IS NOT NULL AND arr_delay IS NOT NULL)""")
       + "SELECT weekday, avg(arr_delay) AS delay, CAST(count(*) AS BIGINT) AS n_flights "
         "FROM wd WHERE weekday IS NOT NULL GROUP BY weekday")
Q21 = mean_sql(["origin", "unique_carrier"], "dep_delay")
Q22 = mean_sql(["origin", "dest"], "dep_delay")
Q23 = mean_sql(["origin", "dest", "unique_carrier"], "arr_delay")
Q24 = mean_sql(["origin", "dest"], "arr_delay")


def _sub(sql: str) -> tuple[str, str]:
    """Split 'WITH ... SELECT ...' into (ctes-without-WITH, final select)."""
    head, _, select = sql.rpartition("\nSELECT ")
    return head[len("WITH "):], "SELECT " + select


def ranked_sql(sql: str, cols: list[str], order: str, partition: list[str] | None = None,
               k: int | None = None) -> str:
    ctes, select = _sub(sql)
    part = f"PARTITION BY {', '.join(partition)} " if partition else ""
    keep = f" WHERE rank <= {k}" if k is not None else ""
    return (f"WITH {ctes},\nresult AS ({select})\n"
            f"SELECT * FROM (SELECT {', '.join(cols)}, CAST(row_number() OVER ({part}ORDER BY {order}) "
            f"AS INTEGER) AS rank FROM result) t{keep}")


def best_legs_ctes(where: str = "") -> str:
    return f"""
timed AS (
  SELECT flight_date, origin, dest, arr_delay, crs_dep_time, unique_carrier, flight_num,
         {MINUTE_SQL} AS minute_of_day
  FROM flights
  WHERE flight_date IS NOT NULL AND arr_delay IS NOT NULL
    AND {text_present('origin', 'dest', 'crs_dep_time', 'unique_carrier', 'flight_num')}{where}
),
periods AS (
  SELECT *, CASE WHEN minute_of_day < 720 THEN 'AM' ELSE 'PM' END AS period
  FROM timed WHERE minute_of_day IS NOT NULL
),
legs AS (
  SELECT flight_date, period, origin, dest, arr_delay, crs_dep_time, unique_carrier, flight_num
  FROM (SELECT *, row_number() OVER (PARTITION BY flight_date, period, origin, dest
                                     ORDER BY arr_delay, minute_of_day, unique_carrier, flight_num) AS rn
        FROM periods) r
  WHERE rn = 1
)"""


def trips_sql(offset_days: int = 2, where: str = "") -> str:
    return _with(best_legs_ctes(where)) + f"""SELECT
  a.flight_date AS date1, a.origin AS origin, a.dest AS dest1, b.dest AS dest2,
  a.arr_delay + b.arr_delay AS total_delay,
  CAST(a.flight_date AS VARCHAR) || ' ' || a.crs_dep_time AS datetime1,
  a.unique_carrier || ' ' || a.flight_num AS flight1,
  CAST(b.flight_date AS VARCHAR) || ' ' || b.crs_dep_time AS datetime2,
  b.unique_carrier || ' ' || b.flight_num AS flight2
FROM legs a JOIN legs b
  ON a.period = 'AM' AND b.period = 'PM' AND a.dest = b.origin
 AND b.flight_date = a.flight_date + {int(offset_days)}"""


def trips_of_offsets_sql(offsets: list[int]) -> str:
    return "\nUNION ALL\n".join(f"SELECT *, {d} AS offset_days FROM ({trips_sql(d)}) t{d}" for d in offsets)


BEST_LEGS = _with(best_legs_ctes()) + "SELECT * FROM legs"
Q3 = trips_sql(2)

FLIGHT_COLS = ("flight_date, day_of_week, unique_carrier, flight_num, origin, dest, "
               "crs_dep_time, dep_delay, arr_delay")


def where(sql: str, cond: str) -> str:
    return f"SELECT * FROM ({sql}) q WHERE {cond}"


def years_ahead_sql(slices: int = 7, seed: int = 7) -> str:
    """The years that are later than all years staged before them in a shuffled replay."""
    order = list(range(slices))
    random.Random(seed).shuffle(order)
    ahead = [y for i, y in enumerate(order) if y == max(order[:i + 1])]
    return ("SELECT y FROM (SELECT y, row_number() OVER (ORDER BY y) - 1 AS i FROM "
            "(SELECT DISTINCT year(l_shipdate) AS y FROM lineitem)) "
            f"WHERE i IN ({', '.join(map(str, ahead))})")


def late_legs_sql() -> str:
    """Best legs of the years that are not late."""
    return where(BEST_LEGS, f"year(flight_date) IN ({years_ahead_sql()})")


def late_flights_sql() -> str:
    """Flights of the years that are late, by year."""
    return (_with() + "SELECT CAST(year(flight_date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS late_flights "
            f"FROM flights WHERE year(flight_date) NOT IN ({years_ahead_sql()}) GROUP BY year(flight_date)")


CURATE_REQUIRED = (_with() + "SELECT origin, dest, unique_carrier, arr_delay FROM flights WHERE "
                   + text_present("origin", "dest", "unique_carrier") + " AND arr_delay IS NOT NULL")
COMPLETE_ROWS = (_with() + f"SELECT {FLIGHT_COLS} FROM flights WHERE flight_date IS NOT NULL "
                 "AND day_of_week IS NOT NULL AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL AND "
                 + text_present("unique_carrier", "flight_num", "origin", "dest", "crs_dep_time"))
TIME_OF_DAY = (_with(f"""
timed AS (SELECT flight_date, flight_num, crs_dep_time, {MINUTE_SQL} AS minute_of_day
          FROM flights WHERE {text_present('crs_dep_time')})""")
               + "SELECT flight_date, flight_num, crs_dep_time, minute_of_day, "
                 "CASE WHEN minute_of_day < 720 THEN 'AM' ELSE 'PM' END AS period "
                 "FROM timed WHERE minute_of_day IS NOT NULL")
ROUTE_KEY = (_with() + "SELECT origin || '_' || dest AS route, origin, dest, avg(arr_delay) AS delay, "
             "CAST(count(*) AS BIGINT) AS n_flights FROM flights WHERE "
             + text_present("origin", "dest") + " AND arr_delay IS NOT NULL GROUP BY origin, dest")
YEAR_EXTRACT = (_with() + f"SELECT {FLIGHT_COLS} FROM flights WHERE year(flight_date) = 1998")
YEAR_TRIPS = trips_sql(2, " AND year(flight_date) = 1998")


def long_sql() -> str:
    """The seven result tables as one long table (question, key1..3, delay, n_flights)."""
    parts = [
        ("q1.1", Q11, ["airport"], "CAST(NULL AS DOUBLE)", "cnt"),
        ("q1.2", Q12, ["unique_carrier"], "delay", "n_flights"),
        ("q1.3", Q13, ["weekday"], "delay", "n_flights"),
        ("q2.1", Q21, ["origin", "unique_carrier"], "delay", "n_flights"),
        ("q2.2", Q22, ["origin", "dest"], "delay", "n_flights"),
        ("q2.3", Q23, ["origin", "dest", "unique_carrier"], "delay", "n_flights"),
        ("q2.4", Q24, ["origin", "dest"], "delay", "n_flights"),
    ]
    selects = []
    for name, sql, keys, delay, n in parts:
        ks = [f"CAST({k} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"] * (3 - len(keys))
        selects.append(f"SELECT '{name}' AS question, {ks[0]} AS key1, {ks[1]} AS key2, "
                       f"{ks[2]} AS key3, {delay} AS delay, {n} AS n_flights FROM ({sql}) t")
    return "\nUNION ALL\n".join(selects)


ALL_FLIGHTS = _with() + f"SELECT {FLIGHT_COLS} FROM flights"


def export_sql() -> str:
    """The seven tables with means from whole numbers of thousandths, rounded once, as text."""
    parts = [
        ("q1.1", "flights, (SELECT unnest([1, 2]) AS side)", ["CASE side WHEN 1 THEN origin ELSE dest END"], None,
         text_present("origin", "dest")),
        ("q1.2", "flights", ["unique_carrier"], "arr_delay", text_present("unique_carrier")),
        ("q1.3", "flights", [WEEKDAY_SQL], "arr_delay", "day_of_week BETWEEN 1 AND 7"),
        ("q2.1", "flights", ["origin", "unique_carrier"], "dep_delay", text_present("origin", "unique_carrier")),
        ("q2.2", "flights", ["origin", "dest"], "dep_delay", text_present("origin", "dest")),
        ("q2.3", "flights", ["origin", "dest", "unique_carrier"], "arr_delay",
         text_present("origin", "dest", "unique_carrier")),
        ("q2.4", "flights", ["origin", "dest"], "arr_delay", text_present("origin", "dest")),
    ]
    selects = []
    for name, source, keys, measure, there in parts:
        ks = ", ".join(f"{k} AS key{i + 1}" for i, k in enumerate(keys + ["CAST(NULL AS VARCHAR)"] * (3 - len(keys))))
        units = f"CAST(round({measure} * 1000) AS HUGEINT)" if measure else "CAST(NULL AS HUGEINT)"
        there += f" AND {measure} IS NOT NULL" if measure else ""
        selects.append(f"SELECT '{name}' AS question, {ks}, {units} AS u FROM {source} WHERE {there}")
    return _with("each AS (" + "\nUNION ALL\n".join(selects) + ")", """
sums AS (SELECT question, key1, key2, key3, CAST(sum(u) AS HUGEINT) AS t, CAST(count(*) AS BIGINT) AS n
         FROM each GROUP BY ALL)""", """
means AS (SELECT *, (2 * abs(t) + n) // (2 * n) AS m FROM sums)""") + (
        "SELECT question, key1, key2, key3, CASE WHEN t < 0 AND m > 0 THEN '-' ELSE '' END || (m // 1000) || '.' "
        "|| lpad(CAST(m % 1000 AS VARCHAR), 3, '0') AS delay, n AS n_flights FROM means")


def quality_sql() -> str:
    """What the stand-in lines hold: cut after ten fields (line number 7), or a word as delay (cancelled, 3)."""
    text = ["unique_carrier", "flight_num", "origin", "dest", "crs_dep_time"]
    late = ["flight_num", "origin", "dest", "crs_dep_time", "dep_delay", "arr_delay"]
    counts = ["CAST(count(*) AS BIGINT) AS rows", "CAST(count(*) FILTER (short) AS BIGINT) AS corrupt_lines"]
    for c in FLIGHT_COLS.split(", "):
        gone = f"({c} IS NULL" + (f" OR trim({c}) = ''" if c in text else "") + ")"
        gone += " AND NOT odd" if c == "arr_delay" else ""
        gone = f"short OR ({gone})" if c in late else gone
        wrong = {"arr_delay": "odd AND NOT short", "crs_dep_time": f"NOT short AND trim(crs_dep_time) <> '' AND "
                 f"({MINUTE_SQL}) IS NULL"}.get(c, "false")
        gone = f"({gone}) AND NOT ({wrong})"
        counts += [f"CAST(count(*) FILTER ({gone}) AS BIGINT) AS missing_{c}",
                   f"CAST(count(*) FILTER ({wrong}) AS BIGINT) AS unparsable_{c}"]
    return _with("lines AS (SELECT *, flight_num LIKE '%-7' AS short, "
                 "flight_num LIKE '%-3' AND arr_delay IS NULL AS odd FROM flights)") + (
        "SELECT " + ", ".join(counts) + " FROM lines")


QUALITY = quality_sql()
