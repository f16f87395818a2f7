from tarmac.functions.columns import (  # noqa: F401
    WEEKDAY_NAMES,
    date_plus_days,
    format_delay,
    day_period,
    leg_label,
    minute_of_day,
    round3,
    route_key,
    to_decimal3,
    to_double,
    to_int,
    weekday_name,
)
