"""Row filters of the staging models (F1-F9). Null compares as unknown, so a null row is dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status classes of the schedule feed.
DEPARTED = "Departed"
ARRIVED_STATUSES = ["Arrived", "Approaching", "Delayed"]
OPERATOR = "IsOperator"
# Countries whose airports the daily load requests.
LOAD_COUNTRIES = ["DE", "FR", "CH", "AE"]


def not_cargo(c: str = "isCargo") -> Column:
    """``isCargo = FALSE``; null is dropped too."""
    return F.col(c) == F.lit(False)


def same_day(ts: str, date: str = "flight_date") -> Column:
    """The scheduled UTC day equals the flight date; a null schedule is dropped."""
    return F.to_date(F.col(ts)) == F.col(date)


def is_operator(c: str = "codeshare_status") -> Column:
    return F.col(c) == F.lit(OPERATOR)


def status_is(value: str, c: str = "status") -> Column:
    return F.col(c) == F.lit(value)


def status_in(values, c: str = "status") -> Column:
    return F.col(c).isin(list(values))


def status_not(value: str, c: str = "status") -> Column:
    return F.col(c) != F.lit(value)


def status_not_in(values, c: str = "status") -> Column:
    return ~F.col(c).isin(list(values))


def identified(cols=("callsign", "aircraft_mode_s")) -> Column:
    """At least one identifier present."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])


def unidentified(cols=("callsign", "aircraft_mode_s")) -> Column:
    """No identifier at all."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def country_in(countries=LOAD_COUNTRIES, c: str = "country") -> Column:
    return F.col(c).isin(list(countries))
