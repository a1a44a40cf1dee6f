"""UTC day bounds of a flight date (T1) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Request window strings are ``yyyy-MM-dd'T'HH:mm``; the day is cut at midday and ends at 23:59.
DAY_START, MIDDAY, DAY_END = "T00:00", "T12:00", "T23:59"


def day_bounds(date_col) -> dict[str, Column]:
    """Start epoch, inclusive end epoch (next midnight minus one second) and the three window strings."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    start = F.unix_date(d).cast("bigint") * F.lit(86400)
    day = F.date_format(d, "yyyy-MM-dd")
    return {
        "start_epoch": start,
        "end_epoch": start + F.lit(86399),
        "start_str": F.concat(day, F.lit(DAY_START)),
        "midday_str": F.concat(day, F.lit(MIDDAY)),
        "end_str": F.concat(day, F.lit(DAY_END)),
    }


def parse_flight_date(text: str):
    """Driver-side validation of a requested date string (``yyyy-MM-dd``); raises on bad input."""
    import datetime

    if not text:
        raise ValueError("a date string must be provided")
    return datetime.datetime.strptime(text, "%Y-%m-%d").date()
