"""The declared checks once more, as SQL text for the oracle: written from the declarations, without the library's table.

Each line: model, check, kind and what it tests. ``rows``: a predicate of failing rows; ``values``: the column and the
predicate of its offending values; ``keys``: columns that may not repeat (``keys?`` ignores null keys).
"""

from __future__ import annotations

_DEP_KEYS = "flight_number, flight_date, airport_icao, departure_scheduled_utc, arrival_airport_icao, arrival_scheduled_utc"
_DEP_PAIR = "flight_number, flight_date, callsign, aircraft_mode_s, airport_icao, arrival_airport_icao"
_ARR_KEYS = "flight_number, flight_date, departure_airport_icao, departure_scheduled_utc, airport_icao, arrival_scheduled_utc"
_ARR_PAIR = "flight_number, flight_date, callsign, aircraft_mode_s, departure_airport_icao, airport_icao"
_ARRIVED = "('Arrived', 'Approaching', 'Delayed')"
_BOTH = "not_both_null(callsign,aircraft_mode_s) | rows | callsign IS NULL AND aircraft_mode_s IS NULL"
_NEITHER = "only_both_null(callsign,aircraft_mode_s) | rows | callsign IS NOT NULL OR aircraft_mode_s IS NOT NULL"

# The 57 declared checks.
DECLARED = f"""
stg_airports | not_null(airport_key) | rows | airport_key IS NULL
stg_airports | unique(airport_key) | keys? | airport_key
stg_airports | not_null(airport_icao) | rows | airport_icao IS NULL
stg_airports | unique(airport_icao) | keys? | airport_icao
stg_flights | not_null(icao24) | rows | icao24 IS NULL
stg_flights | not_null(first_seen_ts) | rows | first_seen_ts IS NULL
stg_flights | unique_combination_of_columns(icao24,first_seen_ts) | keys | icao24, first_seen_ts
stg_departures_base | not_null(flight_number) | rows | flight_number IS NULL
stg_departures_base | not_null(flight_date) | rows | flight_date IS NULL
stg_departures_base | not_null(airport_icao) | rows | airport_icao IS NULL
stg_departures_base | not_null(departure_scheduled_utc) | rows | departure_scheduled_utc IS NULL
stg_departures_base | unique_combination_of_columns({_DEP_KEYS.replace(' ', '')}) | keys | {_DEP_KEYS}
stg_departures_not_departed | not_null(flight_number) | rows | flight_number IS NULL
stg_departures_not_departed | not_null(flight_date) | rows | flight_date IS NULL
stg_departures_not_departed | not_null(airport_icao) | rows | airport_icao IS NULL
stg_departures_not_departed | not_accepted_values(status) | values | status IN ('Departed')
stg_departures_not_departed | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_departures_operator | not_null(flight_number) | rows | flight_number IS NULL
stg_departures_operator | not_null(flight_date) | rows | flight_date IS NULL
stg_departures_operator | not_null(airport_icao) | rows | airport_icao IS NULL
stg_departures_operator | not_null(departure_scheduled_utc) | rows | departure_scheduled_utc IS NULL
stg_departures_operator | accepted_values(status) | values | status NOT IN ('Departed')
stg_departures_operator | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_departures_operator | {_BOTH}
stg_departures_operator | unique_combination_of_columns({_DEP_PAIR.replace(' ', '')}) | keys | {_DEP_PAIR}
stg_departures_unlinkable | not_null(flight_number) | rows | flight_number IS NULL
stg_departures_unlinkable | not_null(flight_date) | rows | flight_date IS NULL
stg_departures_unlinkable | not_null(airport_icao) | rows | airport_icao IS NULL
stg_departures_unlinkable | not_null(departure_scheduled_utc) | rows | departure_scheduled_utc IS NULL
stg_departures_unlinkable | accepted_values(status) | values | status NOT IN ('Departed')
stg_departures_unlinkable | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_departures_unlinkable | {_NEITHER}
stg_arrivals_base | not_null(flight_number) | rows | flight_number IS NULL
stg_arrivals_base | not_null(flight_date) | rows | flight_date IS NULL
stg_arrivals_base | not_null(airport_icao) | rows | airport_icao IS NULL
stg_arrivals_base | not_null(arrival_scheduled_utc) | rows | arrival_scheduled_utc IS NULL
stg_arrivals_base | unique_combination_of_columns({_ARR_KEYS.replace(' ', '')}) | keys | {_ARR_KEYS}
stg_arrivals_not_arrived | not_null(flight_number) | rows | flight_number IS NULL
stg_arrivals_not_arrived | not_null(flight_date) | rows | flight_date IS NULL
stg_arrivals_not_arrived | not_null(airport_icao) | rows | airport_icao IS NULL
stg_arrivals_not_arrived | not_accepted_values(status) | values | status IN {_ARRIVED}
stg_arrivals_not_arrived | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_arrivals_operator | not_null(flight_number) | rows | flight_number IS NULL
stg_arrivals_operator | not_null(flight_date) | rows | flight_date IS NULL
stg_arrivals_operator | not_null(airport_icao) | rows | airport_icao IS NULL
stg_arrivals_operator | not_null(arrival_scheduled_utc) | rows | arrival_scheduled_utc IS NULL
stg_arrivals_operator | accepted_values(status) | values | status NOT IN {_ARRIVED}
stg_arrivals_operator | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_arrivals_operator | {_BOTH}
stg_arrivals_operator | unique_combination_of_columns({_ARR_PAIR.replace(' ', '')}) | keys | {_ARR_PAIR}
stg_arrivals_unlinkable | not_null(flight_number) | rows | flight_number IS NULL
stg_arrivals_unlinkable | not_null(flight_date) | rows | flight_date IS NULL
stg_arrivals_unlinkable | not_null(airport_icao) | rows | airport_icao IS NULL
stg_arrivals_unlinkable | not_null(arrival_scheduled_utc) | rows | arrival_scheduled_utc IS NULL
stg_arrivals_unlinkable | accepted_values(status) | values | status NOT IN {_ARRIVED}
stg_arrivals_unlinkable | accepted_values(codeshare_status) | values | codeshare_status NOT IN ('IsOperator')
stg_arrivals_unlinkable | {_NEITHER}
raw_departures | not_null(flight_date) | rows | flight_date IS NULL
raw_departures | not_null(airport_icao) | rows | airport_icao IS NULL
raw_arrivals | not_null(flight_date) | rows | flight_date IS NULL
raw_arrivals | not_null(airport_icao) | rows | airport_icao IS NULL
raw_flights | not_null(icao24) | rows | icao24 IS NULL
raw_flights | not_null(firstSeen) | rows | firstSeen IS NULL
raw_flights | unique_combination_of_columns(icao24,firstSeen) | keys | icao24, firstSeen
raw_airports | not_null(airport) | rows | airport IS NULL
raw_airports | unique(airport) | keys? | airport
"""


def declared(model: str) -> list[tuple[str, str, str]]:
    """(check, kind, what it tests) of one model."""
    lines = [[p.strip() for p in line.split(" | ")] for line in DECLARED.strip().splitlines()]
    return [(name, kind, what) for m, name, kind, what in lines if m == model]


def _first(what: str) -> str:
    return what.split(",")[0].split(" ")[0]


def counts_sql(models: dict[str, str]) -> str:
    """Failures of each check, as the test runner counts them. ``models``: model -> the CTE that holds it."""
    parts = []
    for model, cte in models.items():
        for name, kind, what in declared(model):
            if kind == "rows":
                body = f"SELECT count(*) AS n FROM {cte} WHERE {what}"
            elif kind == "values":
                body = f"SELECT count(DISTINCT {_first(what)}) AS n FROM {cte} WHERE {what}"
            else:
                known = f" WHERE {what} IS NOT NULL" if kind == "keys?" else ""
                body = f"SELECT count(*) AS n FROM (SELECT {what} FROM {cte}{known} GROUP BY {what} HAVING count(*) > 1) g"
            parts.append(f"SELECT '{model}' AS model, '{name}' AS check_name, CAST(n AS BIGINT) AS failures, n = 0 AS passed FROM ({body}) t")
    return "\nUNION ALL\n".join(parts)


def rows_sql(models: dict[str, str], columns: list[str]) -> str:
    """Failing rows of each check with ``columns`` of the model."""
    cols = ", ".join(f"t.{c}" for c in columns)
    parts = []
    for model, cte in models.items():
        for name, kind, what in declared(model):
            if kind in ("rows", "values"):
                body = f"SELECT * FROM {cte} WHERE {what}"
            else:
                known = f" AND {what} IS NOT NULL" if kind == "keys?" else ""
                body = f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY {what}) AS again FROM {cte}) w WHERE again > 1{known}"
            parts.append(f"SELECT '{model}' AS model, '{name}' AS check_name, {cols} FROM ({body}) t")
    return "\nUNION ALL\n".join(parts)
