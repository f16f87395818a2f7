"""Scalar column functions of the questions, all built-in JVM expressions.

Nothing here is a Python UDF: each helper returns a ``Column`` that stays
inside whole-stage code generation.  ANSI mode is on in Spark 4, so
conversions of untrusted text use ``try_cast`` / ``get`` (NULL instead of
an error) and the caller filters the NULLs away.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names indexed by DayOfWeek - 1 (1 = Monday).
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# A departure before minute 720 (12:00) is a morning leg.
NOON_MINUTE = 12 * 60
MORNING, AFTERNOON = "AM", "PM"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col: str | Column) -> Column:
    """Text -> double; NULL for empty or non-numeric text ("-4.00" -> -4.0)."""
    return _c(col).try_cast("double")


def to_int(col: str | Column) -> Column:
    """Text -> int; NULL for empty or non-numeric text."""
    return _c(col).try_cast("int")


def weekday_name(dow: str | Column) -> Column:
    """1..7 (1 = Monday) -> day name; NULL outside the range."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.get(names, to_int(dow) - 1)


def minute_of_day(hhmm: str | Column) -> Column:
    """``HHMM`` text -> minutes after midnight; NULL unless 1-4 digits.

    Short values are left-padded ("930" -> 09:30, "5" -> 00:05); "2400"
    gives 1440, which counts as afternoon.
    """
    t = _c(hhmm)
    n = t.try_cast("int")
    return F.when(t.rlike("^\\s*[0-9]{1,4}\\s*$"), F.floor(n / 100).cast("int") * 60 + n % 100)


def day_period(minute: str | Column) -> Column:
    """Minute of day -> 'AM' (< 12:00) or 'PM'; NULL for a NULL minute."""
    m = _c(minute)
    return F.when(m < NOON_MINUTE, F.lit(MORNING)).when(m.isNotNull(), F.lit(AFTERNOON))


def date_plus_days(date: str | Column, days: int) -> Column:
    return F.date_add(_c(date), days)


def route_key(origin: str | Column, dest: str | Column) -> Column:
    """Presentation key ``origin_dest``; grouping always uses the two columns."""
    return F.concat_ws("_", _c(origin), _c(dest))


def leg_label(left: str | Column, right: str | Column) -> Column:
    """``left + ' ' + right`` (date and time, or carrier and flight number)."""
    return F.concat_ws(" ", _c(left), _c(right))


def to_decimal3(col: str | Column) -> Column:
    """Export form of a delay: decimal(18,3); results stay double until exported."""
    return _c(col).cast("decimal(18,3)")


def round3(col: str | Column) -> Column:
    """Presentation rounding to 3 decimals (list pages and lookup printouts)."""
    return F.round(_c(col), 3)


def format_delay(col: str | Column, digits: int = 3) -> Column:
    """Delay as text with a fixed number of decimals ('%.3f'; the trip page uses 2)."""
    return F.format_string(f"%.{int(digits)}f", _c(col))
