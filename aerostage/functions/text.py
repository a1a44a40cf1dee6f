"""Text clean-up (P3, P4) and airline code fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper(c) -> Column:
    return F.upper(_c(c))


def trim(c) -> Column:
    return F.trim(_c(c))


def upper_trim(c) -> Column:
    return F.upper(F.trim(_c(c)))


def airline_iata_fallback(iata, flight_number) -> Column:
    """IATA code, else the flight number's text before its first blank.

    A number without a blank yields ``''`` (a non-positive length gives the empty string).
    """
    n = _c(flight_number)
    return F.coalesce(_c(iata), F.left(n, F.instr(n, " ") - 1))


def airline_icao_fallback(icao, callsign) -> Column:
    """ICAO code, else the first three characters of the callsign."""
    return F.coalesce(_c(icao), F.left(_c(callsign), F.lit(3)))
