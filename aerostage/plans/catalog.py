"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through the adapters), so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerostage.plans import staging
from aerostage.session import prepare
from aerostage.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Fixed value: the batch time stamped on the airport dimension in registered queries.
AIRPORTS_LOADED_AT = dt.datetime(2025, 1, 1, 0, 0, 0)


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return deco


def raw(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False) -> DataFrame:
    return adapters.raw(spark, sf_dir, name, dealt)


def dep_base(spark, sf_dir) -> DataFrame:
    return staging.departures_base(raw(spark, sf_dir, "raw_departures"))


def arr_base(spark, sf_dir) -> DataFrame:
    return staging.arrivals_base(raw(spark, sf_dir, "raw_arrivals"))


# ---- staging models M1-M10 ---------------------------------------------------------------
@query("departures_base")
def q_departures_base(spark, sf_dir):
    """M3."""
    return dep_base(spark, sf_dir)


@query("departures_operator")
def q_departures_operator(spark, sf_dir):
    """M5 (flagship): pair-merged operator departures."""
    return staging.departures_operator(dep_base(spark, sf_dir))


@query("departures_not_departed")
def q_departures_not_departed(spark, sf_dir):
    """M4: operator departures whose status is not departed."""
    return staging.departures_not_departed(dep_base(spark, sf_dir))


@query("departures_unlinkable")
def q_departures_unlinkable(spark, sf_dir):
    """M6: departed operator rows with neither callsign nor mode-S."""
    return staging.departures_unlinkable(dep_base(spark, sf_dir))


@query("arrivals_base")
def q_arrivals_base(spark, sf_dir):
    """M7: newest record of each arrival identity."""
    return arr_base(spark, sf_dir)


@query("arrivals_operator")
def q_arrivals_operator(spark, sf_dir):
    """M8 (J2): pair-merged operator arrivals, ranked by reliability."""
    return staging.arrivals_operator(arr_base(spark, sf_dir))


@query("arrivals_not_arrived")
def q_arrivals_not_arrived(spark, sf_dir):
    """Operator arrivals whose status is not an arrived class."""
    return staging.arrivals_not_arrived(arr_base(spark, sf_dir))


@query("arrivals_unlinkable")
def q_arrivals_unlinkable(spark, sf_dir):
    """M9: arrived operator rows with neither callsign nor mode-S."""
    return staging.arrivals_unlinkable(arr_base(spark, sf_dir))


@query("airports")
def q_airports(spark, sf_dir):
    """M1: airport dimension, one row per upper-cased ICAO code, with its surrogate key."""
    return staging.airports(raw(spark, sf_dir, "raw_airports"), loaded_at=AIRPORTS_LOADED_AT)


@query("flights")
def q_flights(spark, sf_dir):
    """M2: observed flights, newest load of each (icao24, first seen)."""
    return staging.flights(raw(spark, sf_dir, "raw_flights"))


def queries() -> dict[str, Query]:
    # Import modules that register further queries.
    from aerostage.plans import catalog_more, catalog_nested, catalog_ops  # noqa: F401

    return dict(_REGISTRY)
