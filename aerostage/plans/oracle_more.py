"""Oracle SQL for single-operator, reader, store, plan and KPI queries."""

from __future__ import annotations

from aerostage.plans.oracle import (
    AIRPORTS,
    ARR_BASE_CTES,
    ARR_IDENTITY,
    ARR_NOT_ARRIVED,
    ARR_OPERATOR,
    ARR_UNLINKABLE,
    ARRIVED,
    COMPLETE,
    DEP_BASE_CTES,
    DEP_FILTERED,
    DEP_NOT_DEPARTED,
    DEP_OPERATOR,
    DEP_UNLINKABLE,
    FLIGHTS,
    PAIR,
    RELIABILITY,
    departures,
    departures_merged,
    filtered,
    flight_columns,
    merged,
    newest,
    with_ctes,
)
from aerostage.plans.oracle_checks import counts_sql

_EPOCH = "TIMESTAMP '1970-01-01 00:00:00' + TRY_CAST(CAST({c} AS VARCHAR) AS BIGINT) * INTERVAL 1 SECOND"

_COMPLETENESS = f"CAST(NOT {COMPLETE} AS INTEGER)"
_STRICT = "CAST(" + " OR ".join(
    f"{c} IS NULL" for c in ("departure_revised_utc", "departure_runway_utc", "arrival_scheduled_utc",
                             "arrival_revised_utc", "arrival_runway_utc")) + " AS INTEGER)"

_IATA_FALLBACK_RAW = """COALESCE(airline_iata,
             CASE WHEN number IS NULL THEN NULL
                  WHEN strpos(number, ' ') = 0 THEN ''
                  ELSE left(number, strpos(number, ' ') - 1) END)"""


def single_operator_sql() -> dict[str, str]:
    dep, arr, fl, ap = ["raw_departures"], ["raw_arrivals"], ["raw_flights"], ["raw_airports"]
    classes = """
SELECT 'departure' AS direction, row_id, flight_date, airport_icao, status, codeshare_status FROM dep_base WHERE {d}
UNION ALL
SELECT 'arrival' AS direction, row_id, flight_date, airport_icao, status, codeshare_status FROM arr_base WHERE {a}"""
    both = lambda final: with_ctes(dep + arr, DEP_BASE_CTES + ARR_BASE_CTES, final)
    return {
        "filter_cargo": with_ctes(dep, [], "SELECT * FROM raw_departures WHERE isCargo = FALSE"),
        "filter_same_day": with_ctes(dep, [], "SELECT * FROM raw_departures "
                                              "WHERE CAST(departure_scheduledtime_utc AS DATE) = flight_date"),
        "filter_operator": with_ctes(dep, DEP_BASE_CTES, "SELECT * FROM dep_base WHERE codeshare_status = 'IsOperator'"),
        "filter_status": both(classes.format(d="status = 'Departed'",
                                             a="status IN ('Arrived', 'Approaching', 'Delayed')")),
        "filter_status_not": both(classes.format(d="status != 'Departed'",
                                                 a="status NOT IN ('Arrived', 'Approaching', 'Delayed')")),
        "filter_identified": with_ctes(dep, DEP_BASE_CTES, "SELECT * FROM dep_base "
                                                           "WHERE callsign IS NOT NULL OR aircraft_mode_s IS NOT NULL"),
        "filter_unidentified": with_ctes(dep, DEP_BASE_CTES, "SELECT * FROM dep_base "
                                                             "WHERE callsign IS NULL AND aircraft_mode_s IS NULL"),
        "text_clean": with_ctes(fl, [], """
SELECT row_id, UPPER(icao24) AS icao24, UPPER(TRIM(callsign)) AS callsign,
       UPPER(estDepartureAirport) AS est_departure_airport, TRIM('  ' || callsign) AS callsign_trimmed
FROM raw_flights"""),
        "safe_casts": with_ctes(fl + ap, [], """
SELECT 'flights' AS source, row_id,
       TRY_CAST(CAST(estDepartureAirportHorizDistance AS VARCHAR) AS BIGINT) AS as_number,
       TRY_CAST(CAST(record_date AS VARCHAR) AS DATE) AS as_date,
       CAST(NULL AS DOUBLE) AS as_double, CAST(NULL AS DOUBLE) AS latitude
FROM raw_flights
UNION ALL
SELECT 'airports', CAST(row_id AS BIGINT), NULL, NULL,
       TRY_CAST(CAST(elevation_ft AS VARCHAR) AS DOUBLE), TRY_CAST(CAST(latitude AS VARCHAR) AS DOUBLE)
FROM raw_airports"""),
        "epoch_time": with_ctes(fl, [], f"""
SELECT row_id, {_EPOCH.format(c='firstSeen')} AS first_seen_ts, {_EPOCH.format(c='lastSeen')} AS last_seen_ts,
       CAST({_EPOCH.format(c='firstSeen')} AS DATE) AS first_seen_date
FROM raw_flights"""),
        "airline_fallback": with_ctes(dep, [], f"""
SELECT row_id, number AS flight_number, UPPER(callSign) AS callsign,
       {_IATA_FALLBACK_RAW} AS airline_iata,
       COALESCE(airline_icao, left(UPPER(callSign), 3)) AS airline_icao
FROM raw_departures"""),
        "reliability_score": with_ctes(arr, ARR_BASE_CTES, """
SELECT row_id, {r} AS reliability_score FROM arr_base""".format(r=RELIABILITY)),
        "completeness_flag": with_ctes(dep, [DEP_FILTERED], f"""
SELECT row_id, {_COMPLETENESS} AS completeness_flag, {_STRICT} AS strict_flag FROM dep_filtered"""),
        "parse_times": with_ctes(dep, [], """
SELECT row_id, CAST(row_id % 6 AS INTEGER) AS layout,
       CASE WHEN row_id % 6 = 5 THEN NULL ELSE departure_revisedtime_utc END AS parsed_utc,
       CASE WHEN row_id % 6 = 5 THEN NULL ELSE departure_revisedtime_local END AS parsed_local
FROM raw_departures"""),
        "time_parse_report": with_ctes(dep, [], """
SELECT 'departure_revisedtime_utc' AS column_name,
       count(departure_revisedtime_utc) AS texts,
       count(*) FILTER (WHERE departure_revisedtime_utc IS NOT NULL AND row_id % 6 = 5) AS unparsed
FROM raw_departures
UNION ALL
SELECT 'departure_revisedtime_local',
       count(*) FILTER (WHERE departure_revisedtime_local IS NOT NULL OR row_id % 6 = 5),
       count(*) FILTER (WHERE row_id % 6 = 5)
FROM raw_departures"""),
        "latest_flight": with_ctes(fl, [], f"""
SELECT row_id, icao24, {_EPOCH.format(c='firstSeen')} AS first_seen_ts, ingestion_timestamp
FROM raw_flights
QUALIFY ROW_NUMBER() OVER (PARTITION BY icao24, first_seen_ts ORDER BY ingestion_timestamp DESC NULLS FIRST, row_id) = 1"""),
        "airport_key": with_ctes(ap, [], """
SELECT row_id, icao, CAST(ROW_NUMBER() OVER (ORDER BY icao NULLS LAST, row_id) AS BIGINT) AS airport_key
FROM raw_airports"""),
        "latest_arrival": with_ctes(arr, ARR_BASE_CTES, """
SELECT row_id, flight_number, flight_date, departure_airport_icao, departure_scheduled_utc, airport_icao,
       arrival_scheduled_utc, ingestion_timestamp
FROM arr_base"""),
        "latest_departure": with_ctes(dep, DEP_BASE_CTES[:2], """
SELECT row_id, flight_number, flight_date, callsign, aircraft_mode_s, airport_icao, departure_scheduled_utc,
       arrival_airport_icao, arrival_scheduled_utc, ingestion_timestamp
FROM dep_latest"""),
        "most_complete": with_ctes(dep, DEP_BASE_CTES, f"""
SELECT row_id, flight_number, flight_date, callsign, aircraft_mode_s, airport_icao,
       {_COMPLETENESS} AS completeness_flag
FROM dep_base"""),
        "pair_rank": with_ctes(dep, DEP_BASE_CTES, f"""
SELECT row_id, {PAIR}, departure_scheduled_utc, CAST(pair_rank AS INTEGER) AS pair_rank
FROM (SELECT *, row_number() OVER (PARTITION BY {PAIR} ORDER BY departure_scheduled_utc NULLS LAST, row_id) AS pair_rank
      FROM dep_base WHERE codeshare_status = 'IsOperator' AND status = 'Departed'
        AND COALESCE(callsign, aircraft_mode_s) IS NOT NULL) g
WHERE pair_rank < 3"""),
        "pair_rank_scored": with_ctes(arr, ARR_BASE_CTES, f"""
SELECT row_id, {PAIR}, reliability_score, CAST(pair_rank AS INTEGER) AS pair_rank
FROM (SELECT *, {RELIABILITY} AS reliability_score,
             row_number() OVER (PARTITION BY {PAIR} ORDER BY {RELIABILITY} DESC, row_id) AS pair_rank
      FROM arr_base WHERE codeshare_status = 'IsOperator' AND status IN ('Arrived', 'Approaching', 'Delayed')
        AND COALESCE(callsign, aircraft_mode_s) IS NOT NULL) g
WHERE pair_rank < 3"""),
        "pair_merge_departures": with_ctes(dep, DEP_BASE_CTES + [DEP_OPERATOR], "SELECT * FROM dep_operator"),
        "pair_merge_arrivals": with_ctes(arr, ARR_BASE_CTES + [ARR_OPERATOR], "SELECT * FROM arr_operator"),
        "airport_codes": with_ctes(ap, [], "SELECT DISTINCT icao FROM raw_airports"),
        "airports_by_country": with_ctes(ap, [], "SELECT icao FROM raw_airports "
                                                 "WHERE country IN ('DE', 'FR', 'CH', 'AE')"),
    }


def more_sql() -> dict[str, str]:
    out = {}
    out.update(single_operator_sql())
    out.update(nested_sql())
    out.update(ops_sql())
    out.update(publication_sql())
    out.update(daily_sql())
    out["link_schedule_observed_ranges"] = out["link_schedule_observed"]  # two forms of one rule
    return out




# ---- payloads and nesting -----------------------------------------------------------------------
def _half(col: str) -> str:
    return f"CASE WHEN coalesce(hour({col}), 0) < 12 THEN 'first_half' ELSE 'second_half' END AS half"


def _leg_columns(side_fields) -> str:
    return ", ".join(f'"{n}"' for n, _, _ in side_fields)


def _flat_leg() -> str:
    """The nested leg flattened with ``_`` (departure rows have no departure airport, gate or belt)."""
    cols = ["number", "callSign", "status", "codeshareStatus", "isCargo", "aircraft_reg", "aircraft_modeS",
            "aircraft_model", "airline_name", "airline_iata", "airline_icao"]
    out = [f'{c} AS "{c}"' for c in cols]
    for side in ("departure", "arrival"):
        for k in ("icao", "iata", "name", "timeZone"):
            src = f"{side}_airport_{k.lower()}" if side == "arrival" else "CAST(NULL AS VARCHAR)"
            out.append(f'{src} AS "{side}_airport_{k}"')
        for kind in ("scheduled", "revised", "runway"):
            for z in ("utc", "local"):
                out.append(f'{side}_{kind}time_{z} AS "{side}_{kind}Time_{z}"')
        present = {"departure": {"terminal", "runway"}, "arrival": {"terminal", "gate", "baggagebelt"}}[side]
        for raw_name, name in (("terminal", "terminal"), ("runway", "runway"), ("gate", "gate"),
                               ("baggagebelt", "baggageBelt")):
            src = f"{side}_{raw_name}" if raw_name in present else "CAST(NULL AS VARCHAR)"
            out.append(f'{src} AS "{side}_{name}"')
    return ", ".join(out)


_INT_FIELDS = ["estDepartureAirportHorizDistance", "estDepartureAirportVertDistance",
               "estArrivalAirportHorizDistance", "estArrivalAirportVertDistance",
               "departureAirportCandidatesCount", "arrivalAirportCandidatesCount"]
_OBSERVED = ("icao24, firstSeen, estDepartureAirport, lastSeen, estArrivalAirport, callsign, "
             + ", ".join(f'TRY_CAST(CAST({c} AS VARCHAR) AS INTEGER) AS "{c}"' for c in _INT_FIELDS))
_REQUEST_DAY = "CAST(TIMESTAMP '1970-01-01 00:00:00' + firstSeen * INTERVAL 1 SECOND AS DATE)"


def nested_sql() -> dict[str, str]:
    from aerostage.schemas import ARRIVAL_FIELDS, DEPARTURE_FIELDS

    dep, arr, fl, ap = ["raw_departures"], ["raw_arrivals"], ["raw_flights"], ["raw_airports"]
    q_cols = "airport_icao, flight_date, number, callSign"
    return {
        "payload_flatten_departures": with_ctes(dep, [], f"SELECT {_leg_columns(DEPARTURE_FIELDS)}, "
                                                         f"{_half('departure_scheduledtime_utc')} FROM raw_departures"),
        "payload_flatten_arrivals": with_ctes(arr, [], f"SELECT {_leg_columns(ARRIVAL_FIELDS)}, "
                                                       f"{_half('arrival_scheduledtime_utc')} FROM raw_arrivals"),
        "array_column": with_ctes(dep, [], f"""
SELECT {q_cols}, 0 AS pos, 'Basic' AS quality FROM raw_departures
UNION ALL
SELECT {q_cols}, 1, 'Live' FROM raw_departures WHERE departure_revisedtime_utc IS NOT NULL
UNION ALL
SELECT {q_cols}, CASE WHEN departure_revisedtime_utc IS NOT NULL THEN 2 ELSE 1 END, 'Runway'
FROM raw_departures WHERE departure_runwaytime_utc IS NOT NULL"""),
        "present_null_default": with_ctes(dep, [], """
SELECT row_id,
       CASE row_id % 4 WHEN 0 THEN aircraft_model WHEN 1 THEN coalesce(aircraft_model, 'unknown') ELSE 'unknown' END AS aircraft_model,
       CASE WHEN row_id % 4 < 2 THEN aircraft_reg END AS aircraft_reg
FROM raw_departures"""),
        "flatten_unknown_keys": with_ctes(dep, ["""pairs AS (
  SELECT row_id, 'number' AS key, number AS value FROM raw_departures
  UNION ALL SELECT row_id, 'status', status FROM raw_departures
  UNION ALL SELECT row_id, 'isCargo', CAST(isCargo AS VARCHAR) FROM raw_departures
  UNION ALL SELECT row_id, 'aircraft_reg', aircraft_reg FROM raw_departures
  UNION ALL SELECT row_id, 'aircraft_modeS', aircraft_modeS FROM raw_departures
  UNION ALL SELECT row_id, 'movement_departure_terminal', departure_terminal FROM raw_departures
  UNION ALL SELECT row_id, 'movement_departure_scheduledTime_utc', strftime(departure_scheduledtime_utc, '%Y-%m-%d %H:%M') FROM raw_departures
  UNION ALL SELECT row_id, 'quality', '["Basic",' || coalesce('"' || status || '"', 'null') || ']' FROM raw_departures WHERE row_id % 3 = 0)"""],
            "SELECT row_id, key, value FROM pairs WHERE value IS NOT NULL"),
        "nested_default": with_ctes(dep, [], """
SELECT row_id,
       CASE WHEN aircraft_modeS IS NULL THEN NULL ELSE aircraft_reg END AS aircraft_reg,
       COALESCE(CASE WHEN aircraft_modeS IS NULL THEN NULL ELSE aircraft_model END, 'unknown') AS aircraft_model
FROM raw_departures"""),
        "flatten_struct": with_ctes(dep, [], f"SELECT row_id, {_flat_leg()} FROM raw_departures"),
        "align_keys": with_ctes(dep + arr, [], """
SELECT row_id, number, departure_terminal, departure_runway, arrival_gate, arrival_baggagebelt, 'departure' AS kind
FROM raw_departures
UNION ALL BY NAME
SELECT row_id, number, departure_terminal, departure_runway, arrival_runway, arrival_gate, 'arrival' AS kind
FROM raw_arrivals"""),
        "read_flights_json": with_ctes(fl, [], f"SELECT {_OBSERVED}, {_REQUEST_DAY} AS record_date FROM raw_flights"),
        "read_airports_csv": with_ctes(ap, [], """
SELECT airport, country, state, city, icao, iata,
       TRY_CAST(elevation_ft AS DOUBLE) AS elevation_ft, TRY_CAST(latitude AS DOUBLE) AS latitude,
       TRY_CAST(longitude AS DOUBLE) AS longitude
FROM raw_airports"""),
        "directional_flights": with_ctes(fl, [], f"""
SELECT {_OBSERVED}, {_REQUEST_DAY} AS record_date, UPPER(estDepartureAirport) AS airport_icao,
       'departure' AS direction
FROM raw_flights WHERE estDepartureAirport IS NOT NULL
UNION ALL
SELECT {_OBSERVED}, {_REQUEST_DAY}, UPPER(estArrivalAirport), 'arrival'
FROM raw_flights WHERE estArrivalAirport IS NOT NULL"""),
        "delay_payload": with_ctes(dep, DEP_BASE_CTES, """
SELECT airport_icao,
       h AS from_utc, h + INTERVAL 1 HOUR AS from_local,
       h + INTERVAL 59 MINUTE AS to_utc, h + INTERVAL 59 MINUTE + INTERVAL 1 HOUR AS to_local,
       count(*) FILTER (WHERE departure_runway_utc IS NOT NULL) AS "numDeparted",
       count(*) FILTER (WHERE departure_runway_utc > departure_scheduled_utc + INTERVAL 15 MINUTE) AS "numDelayed"
FROM (SELECT *, date_trunc('hour', departure_scheduled_utc) AS h FROM dep_base) t
GROUP BY airport_icao, h"""),
    }


# ---- loads, request plan, KPIs, streaming ------------------------------------------------------------
_LOAD_COUNTRY_AIRPORTS = "SELECT DISTINCT UPPER(icao) AS icao FROM raw_airports WHERE country IN ('DE', 'FR', 'CH', 'AE')"
_DAYS = """days AS (
  SELECT CAST(d AS DATE) AS flight_date
  FROM (SELECT min(flight_date) AS lo, max(flight_date) AS hi FROM raw_departures) r,
       unnest(generate_series(CAST(r.lo AS TIMESTAMP), CAST(r.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS g(d)
)"""
_HALVES = """halves AS (
  SELECT * FROM (VALUES ('first_half', 'T00:00', 'T12:00'), ('second_half', 'T12:00', 'T23:59')) AS h(half, f, t)
)"""
_PLAN_SELECT = """SELECT a.icao AS airport_icao, d.flight_date, h.half,
       strftime(d.flight_date, '%Y-%m-%d') || h.f AS time_from, strftime(d.flight_date, '%Y-%m-%d') || h.t AS time_to
FROM plan_airports a CROSS JOIN days d CROSS JOIN halves h"""


def _movements_cte() -> str:
    return """moves AS (
  SELECT 'departure' AS direction, airport_icao, flight_date, departure_scheduled_utc AS scheduled_utc,
         COALESCE(departure_runway_utc, departure_revised_utc) AS actual_utc,
         date_diff('second', departure_scheduled_utc, COALESCE(departure_runway_utc, departure_revised_utc)) AS delay_seconds
  FROM dep_operator
  UNION ALL
  SELECT 'arrival', airport_icao, flight_date, arrival_scheduled_utc,
         COALESCE(arrival_runway_utc, arrival_revised_utc),
         date_diff('second', arrival_scheduled_utc, COALESCE(arrival_runway_utc, arrival_revised_utc))
  FROM arr_operator
)"""


def ops_sql() -> dict[str, str]:
    from aerostage.schemas import ARRIVAL_FIELDS, DEPARTURE_FIELDS

    dep, arr, ap, fl = ["raw_departures"], ["raw_arrivals"], ["raw_airports"], ["raw_flights"]
    dep_cols = ", ".join(f'"{n}"' for n, _, _ in DEPARTURE_FIELDS)
    arr_cols = ", ".join(f'"{n}"' for n, _, _ in ARRIVAL_FIELDS)
    first = "TIMESTAMP '2025-01-02 00:00:00'"
    late = f"""raw_all AS (
  SELECT * FROM raw_departures
  UNION ALL
  SELECT * REPLACE ('Departed' AS status, TIMESTAMP '2025-01-03 00:00:00' AS ingestion_timestamp)
  FROM raw_departures WHERE status = 'Canceled' AND flight_date >= DATE '2024-01-28'
)"""
    kpi_ctes = DEP_BASE_CTES + [DEP_OPERATOR] + ARR_BASE_CTES + [ARR_OPERATOR, _movements_cte()]
    delay_aggs = """count(delay_seconds) AS with_actual,
       CAST(sum(delay_seconds) AS BIGINT) AS total_delay_seconds,
       CASE WHEN count(delay_seconds) > 0
            THEN CAST(sum(delay_seconds) AS DOUBLE) / count(delay_seconds) / 60.0 END AS avg_delay_minutes"""
    adherence = """count(*) FILTER (WHERE delay_seconds <= 900) AS on_time,
       CASE WHEN count(delay_seconds) > 0
            THEN CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE delay_seconds <= 900) / count(delay_seconds)
       END AS adherence_pct"""
    return {
        "append_defaults": with_ctes(dep, [], f"SELECT row_id, {dep_cols}, {first} AS ingestion_timestamp, "
                                              "'AeroDataBox' AS data_source FROM raw_departures"),
        "committed_batches": with_ctes(dep + arr, [], f"""
SELECT 'departures' AS table_name, CAST(1 AS BIGINT) AS batch_id, row_id, flight_date, {first} AS ingestion_timestamp
FROM raw_departures
UNION ALL
SELECT 'arrivals', CAST(1 AS BIGINT), row_id, flight_date, {first} FROM raw_arrivals"""),
        "incremental_refresh": with_ctes(dep, [late, *departures("raw_all"), DEP_OPERATOR],
                                         "SELECT * FROM dep_operator"),
        "day_bounds": with_ctes(dep, [], """
SELECT flight_date,
       (flight_date - DATE '1970-01-01') * 86400 AS start_epoch,
       (flight_date - DATE '1970-01-01') * 86400 + 86399 AS end_epoch,
       strftime(flight_date, '%Y-%m-%d') || 'T00:00' AS start_str,
       strftime(flight_date, '%Y-%m-%d') || 'T12:00' AS midday_str,
       strftime(flight_date, '%Y-%m-%d') || 'T23:59' AS end_str
FROM (SELECT DISTINCT flight_date FROM raw_departures) d"""),
        "request_plan": with_ctes(dep + ap, [f"plan_airports AS ({_LOAD_COUNTRY_AIRPORTS})", _DAYS, _HALVES],
                                  _PLAN_SELECT),
        "load_coverage": with_ctes(dep + arr + ap, [
            f"plan_airports AS (SELECT airport_icao AS icao FROM raw_departures UNION {_LOAD_COUNTRY_AIRPORTS})",
            _DAYS, _HALVES, f"plan AS ({_PLAN_SELECT})",
            f"""dep_n AS (SELECT airport_icao, flight_date, {_half('departure_scheduledtime_utc')}, count(*) AS n
              FROM raw_departures GROUP BY ALL)""",
            f"""arr_n AS (SELECT airport_icao, flight_date, {_half('arrival_scheduledtime_utc')}, count(*) AS n
              FROM raw_arrivals GROUP BY ALL)"""], """
SELECT p.airport_icao, p.flight_date, p.half, p.time_from, p.time_to,
       COALESCE(d.n, 0) AS departures, COALESCE(a.n, 0) AS arrivals,
       CASE WHEN COALESCE(d.n, 0) = 0 AND COALESCE(a.n, 0) = 0 THEN 'no_content'
            WHEN COALESCE(d.n, 0) = 0 THEN 'no_departures'
            WHEN COALESCE(a.n, 0) = 0 THEN 'no_arrivals' ELSE 'ok' END AS status
FROM plan p
LEFT JOIN dep_n d ON p.airport_icao = d.airport_icao AND p.flight_date = d.flight_date AND p.half = d.half
LEFT JOIN arr_n a ON p.airport_icao = a.airport_icao AND p.flight_date = a.flight_date AND p.half = a.half"""),
        "request_coverage": with_ctes(dep + arr + ap, [
            f"load_airports AS ({_LOAD_COUNTRY_AIRPORTS})",
            "plan_airports AS (SELECT airport_icao AS icao FROM raw_departures UNION SELECT icao FROM load_airports)",
            _DAYS, _HALVES, f"plan AS ({_PLAN_SELECT})",
            f"""landed AS (
  SELECT airport_icao, flight_date, {_half('departure_scheduledtime_utc')}, 1 AS d, 0 AS a, 0 AS bad FROM raw_departures
  UNION ALL SELECT airport_icao, flight_date, {_half('departure_scheduledtime_utc')}, 0, 0, 1 FROM raw_departures WHERE row_id % 50 < 2
  UNION ALL SELECT airport_icao, flight_date, {_half('arrival_scheduledtime_utc')}, 0, 1, 0 FROM raw_arrivals
  UNION ALL SELECT l.icao, days.flight_date, h.half, 0, 0, 0 FROM load_airports l CROSS JOIN days CROSS JOIN halves h WHERE day(days.flight_date) % 2 = 1)""",
            """by_request AS (
  SELECT airport_icao, flight_date, half, CAST(sum(d) AS BIGINT) AS d, CAST(sum(a) AS BIGINT) AS a, CAST(sum(bad) AS BIGINT) AS bad
  FROM landed GROUP BY ALL)"""], """
SELECT p.airport_icao, p.flight_date, p.half, p.time_from, p.time_to, r.d AS departures, r.a AS arrivals, r.bad AS bad_lines,
       CASE WHEN r.d IS NULL THEN 'never_landed' WHEN r.d + r.a = 0 THEN 'no_content'
            WHEN r.d = 0 THEN 'no_departures' WHEN r.a = 0 THEN 'no_arrivals' ELSE 'ok' END AS status
FROM plan p LEFT JOIN by_request r ON p.airport_icao = r.airport_icao AND p.flight_date = r.flight_date AND p.half = r.half"""),
        "quarantined_load": with_ctes(dep, [], """
SELECT 'loaded' AS kind, airport_icao, flight_date, CAST(NULL AS VARCHAR) AS line, count(*) AS n_rows
FROM raw_departures GROUP BY airport_icao, flight_date
UNION ALL
SELECT 'quarantined', NULL, NULL, line, count(*) FROM (
  SELECT '{"departures": [{"number": "' || coalesce(number, '')
         || CASE WHEN row_id % 50 = 0 THEN '", "status": ' ELSE '", "isCargo": "maybe"}]}' END AS line
  FROM raw_departures WHERE row_id % 50 < 2) GROUP BY line"""),
        "movement_delays": with_ctes(dep + arr, kpi_ctes, "SELECT * FROM moves"),
        "delay_daily": with_ctes(dep + arr, kpi_ctes, f"""
SELECT airport_icao, flight_date, direction, count(*) AS flights, {delay_aggs}
FROM moves GROUP BY airport_icao, flight_date, direction"""),
        "adherence": with_ctes(dep + arr, kpi_ctes, f"""
SELECT airport_icao, flight_date, direction, count(delay_seconds) AS with_actual, {adherence}
FROM moves GROUP BY airport_icao, flight_date, direction"""),
        "hourly_efficiency": with_ctes(dep, DEP_BASE_CTES + [DEP_OPERATOR, DEP_NOT_DEPARTED], f"""
SELECT airport_icao, flight_date, hour, count(*) AS scheduled,
       count(*) FILTER (WHERE operated) AS operated, count(*) FILTER (WHERE NOT operated) AS not_departed,
       {delay_aggs}, {adherence},
       count(*) FILTER (WHERE NOT operated) / count(*) AS not_departed_share
FROM (
  SELECT airport_icao, flight_date, CAST(hour(departure_scheduled_utc) AS INTEGER) AS hour, TRUE AS operated,
         date_diff('second', departure_scheduled_utc, COALESCE(departure_runway_utc, departure_revised_utc)) AS delay_seconds
  FROM dep_operator
  UNION ALL
  SELECT airport_icao, flight_date, CAST(hour(departure_scheduled_utc) AS INTEGER), FALSE, CAST(NULL AS BIGINT)
  FROM dep_not_departed
) t
GROUP BY airport_icao, flight_date, hour"""),
        "efficiency_rollup": with_ctes(dep + arr, [late, *departures("raw_all"), DEP_OPERATOR, DEP_NOT_DEPARTED] + ARR_BASE_CTES + [ARR_OPERATOR, ARR_NOT_ARRIVED, """flights AS (
  SELECT 'departure' AS direction, airport_icao, flight_date, CAST(hour(departure_scheduled_utc) AS INTEGER) AS hour, TRUE AS operated,
         date_diff('second', departure_scheduled_utc, COALESCE(departure_runway_utc, departure_revised_utc)) AS delay_seconds FROM dep_operator
  UNION ALL
  SELECT 'departure', airport_icao, flight_date, CAST(hour(departure_scheduled_utc) AS INTEGER), FALSE, NULL FROM dep_not_departed
  UNION ALL
  SELECT 'arrival', airport_icao, flight_date, CAST(hour(arrival_scheduled_utc) AS INTEGER), TRUE,
         date_diff('second', arrival_scheduled_utc, COALESCE(arrival_runway_utc, arrival_revised_utc)) FROM arr_operator
  UNION ALL
  SELECT 'arrival', airport_icao, flight_date, CAST(hour(arrival_scheduled_utc) AS INTEGER), FALSE, NULL FROM arr_not_arrived
)"""], "\nUNION ALL\n".join(f"""
SELECT '{label}' AS level, {keys}, count(*) AS scheduled, count(*) FILTER (WHERE operated) AS operated, count(*) FILTER (WHERE NOT operated) AS not_operated,
       {delay_aggs}, {adherence}, count(*) FILTER (WHERE operated) / count(*) AS operated_share
FROM flights GROUP BY {by}""" for label, keys, by in (
            ("hour", "airport_icao, flight_date, direction, hour", "airport_icao, flight_date, direction, hour"),
            ("day", "airport_icao, flight_date, direction, CAST(NULL AS INTEGER) AS hour", "airport_icao, flight_date, direction"),
            ("airport_day", "airport_icao, flight_date, CAST(NULL AS VARCHAR) AS direction, CAST(NULL AS INTEGER) AS hour", "airport_icao, flight_date"),
            ("airport", "airport_icao, CAST(NULL AS DATE) AS flight_date, direction, CAST(NULL AS INTEGER) AS hour", "airport_icao, direction")))),
        "link_schedule_observed": with_ctes(dep + fl, DEP_BASE_CTES + [DEP_OPERATOR, FLIGHTS, """timed AS (
  SELECT row_id, callsign, aircraft_mode_s,
         COALESCE(departure_runway_utc, departure_revised_utc, departure_scheduled_utc) AS t
  FROM dep_operator
)""", """found AS (
  SELECT d.row_id, 0 AS pref, 'mode_s' AS link_key, o.icao24, o.first_seen_ts, abs(date_diff('second', d.t, o.first_seen_ts)) AS gap
  FROM timed d JOIN stg_flights o ON d.aircraft_mode_s = o.icao24
  UNION ALL
  SELECT d.row_id, 1, 'callsign', o.icao24, o.first_seen_ts, abs(date_diff('second', d.t, o.first_seen_ts))
  FROM timed d JOIN stg_flights o ON d.callsign = o.callsign
)""", """best AS (
  SELECT row_id, first(f ORDER BY pref, gap, first_seen_ts, icao24 NULLS LAST) AS one
  FROM found f WHERE gap <= 43200 GROUP BY row_id
)"""], """
SELECT d.row_id, flight_number, flight_date, callsign, aircraft_mode_s, airport_icao, departure_scheduled_utc,
       one.link_key AS link_key, one.icao24 AS icao24, one.first_seen_ts AS first_seen_ts, one.gap AS gap_seconds
FROM dep_operator d LEFT JOIN best b ON d.row_id = b.row_id"""),
        "streaming_landing": with_ctes(dep, [], f"SELECT {dep_cols}, {first} AS ingestion_timestamp, "
                                                "'AeroDataBox' AS data_source, CAST(0 AS BIGINT) AS batch "
                                                "FROM raw_departures"),
    }


def publication_sql() -> dict[str, str]:
    from aerostage.plans.oracle import ARR_BASE_CTES, ARR_NOT_ARRIVED, ARR_UNLINKABLE, DEP_UNLINKABLE
    from aerostage.schemas import ARRIVAL_FIELDS, DEPARTURE_FIELDS, LOAD_DEFAULTS

    models = {"stg_airports": "stg_airports", "stg_flights": "stg_flights", "stg_departures_base": "dep_base",
              "stg_departures_not_departed": "dep_not_departed", "stg_departures_operator": "dep_operator",
              "stg_departures_unlinkable": "dep_unlinkable", "stg_arrivals_base": "arr_base",
              "stg_arrivals_operator": "arr_operator", "stg_arrivals_not_arrived": "arr_not_arrived",
              "stg_arrivals_unlinkable": "arr_unlinkable"}
    all_ctes = ([AIRPORTS, FLIGHTS] + DEP_BASE_CTES + [DEP_NOT_DEPARTED, DEP_OPERATOR, DEP_UNLINKABLE]
                + ARR_BASE_CTES + [ARR_OPERATOR, ARR_NOT_ARRIVED, ARR_UNLINKABLE])
    counts = " UNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS n_rows FROM {c}" for m, c in models.items())
    legacy_cols = ", ".join(
        ("CAST(NULL AS VARCHAR) AS \"codeshareStatus\"" if n == "codeshareStatus" else f'"{n}"')
        for n in [f for f, _, _ in DEPARTURE_FIELDS] + [d for d, _ in LOAD_DEFAULTS])
    legacy_arr = ", ".join(
        ("CAST(NULL AS VARCHAR) AS \"codeshareStatus\"" if n == "codeshareStatus" else f'"{n}"')
        for n in [f for f, _, _ in ARRIVAL_FIELDS] + [d for d, _ in LOAD_DEFAULTS])
    ops = ops_sql()
    return {
        "staging_views": with_ctes(["raw_airports", "raw_flights", "raw_departures", "raw_arrivals"], all_ctes, counts),
        "curated_layer": ops["hourly_efficiency"],
        "legacy_load": with_ctes(["raw_departures"], [], f"SELECT row_id, {legacy_cols} FROM raw_departures"),
        "legacy_load_arrivals": with_ctes(["raw_arrivals"], [], f"SELECT row_id, {legacy_arr} FROM raw_arrivals"),
        "legacy_flight_tables": with_ctes(["raw_flights"], [], f"""
SELECT {_OBSERVED}, UPPER(estDepartureAirport) AS airport_icao, TIMESTAMP '2025-01-02 00:00:00' AS ingestion_timestamp,
       'flight_departures' AS table_name
FROM raw_flights WHERE estDepartureAirport IS NOT NULL
UNION ALL
SELECT {_OBSERVED}, UPPER(estArrivalAirport), TIMESTAMP '2025-01-02 00:00:00', 'flight_arrivals'
FROM raw_flights WHERE estArrivalAirport IS NOT NULL"""),
        "skip_empty_feed": with_ctes(["raw_departures"], [], """
SELECT 'departures' AS table_name, TRUE AS made, count(*) AS n_rows FROM raw_departures
UNION ALL SELECT 'arrivals', FALSE, 0"""),
        "filter_destination": with_ctes(["raw_flights"], [FLIGHTS],
                                        "SELECT * FROM stg_flights WHERE est_arrival_airport = 'LFPG'"),
    }


#: Columns of the observed flights by name (fixed values), without their key.
_FLIGHT_OTHERS = sorted(
    "callsign est_departure_airport est_arrival_airport first_seen last_seen last_seen_ts dep_airport_horiz_distance "
    "dep_airport_vert_distance arr_airport_horiz_distance arr_airport_vert_distance departure_airport_candidates_count "
    "arrival_airport_candidates_count flight_date ingestion_timestamp".split(" "))


def _hourly(direction: str, cte: str, operated: bool) -> str:
    sched = f"{direction}_scheduled_utc"
    delay = f"date_diff('second', {sched}, COALESCE({direction}_runway_utc, {direction}_revised_utc))" if operated else "CAST(NULL AS BIGINT)"
    return (f"SELECT '{direction}' AS direction, airport_icao, flight_date, hour({sched}) AS hour, {operated} AS operated, "
            f"{delay} AS delay_seconds FROM {cte}")


def daily_ctes() -> tuple[list[str], dict[str, str]]:
    """CTEs of the daily job's tables, and the CTE of each table. The job loads the feeds without a row id, stamped with
    one batch time: every ranking's ties fall back to all other columns in name order."""
    from aerostage.plans.staging import ARR_BASE_COLUMNS, DEP_BASE_COLUMNS
    from aerostage.schemas import ARRIVAL_FIELDS, DEPARTURE_FIELDS

    def tie(columns):
        return lambda keys: ", ".join(f"{c} ASC NULLS LAST" for c in sorted(set(columns) - set(keys.split(", "))))

    def loaded(name: str, source: str, fields) -> str:
        cols = ", ".join(f'"{n}"' for n, _, _ in fields)
        return f"{name} AS (SELECT {cols}, {_BATCH} AS ingestion_timestamp, 'AeroDataBox' AS data_source FROM {source})"

    dep_tie, arr_tie = tie(DEP_BASE_COLUMNS), tie(ARR_BASE_COLUMNS)
    newest_first = "ingestion_timestamp DESC NULLS FIRST"
    day = "CAST(first_seen_ts AS DATE)"
    airport_order = ", ".join(f"{c} NULLS LAST" for c in "icao airport country state city iata elevation_ft latitude longitude".split(" "))
    ctes = [
        loaded("dep_loaded", "raw_departures", DEPARTURE_FIELDS), *departures("dep_loaded", dep_tie, row_id=False),
        departures_merged(dep_tie, row_id=False), DEP_NOT_DEPARTED, DEP_UNLINKABLE,
        loaded("arr_loaded", "raw_arrivals", ARRIVAL_FIELDS), filtered("arrival", "arr_loaded", row_id=False),
        newest("arr_base", "arr_filtered", ARR_IDENTITY, f"{newest_first}, {arr_tie(ARR_IDENTITY)}"),
        merged("arr_operator", "arr_base", ARRIVED, f"{RELIABILITY} DESC, {arr_tie(PAIR)}", "departure", True, row_id=False),
        ARR_NOT_ARRIVED, ARR_UNLINKABLE,
        f"""fl_loaded AS (SELECT * REPLACE ({_EPOCH.format(c="firstSeen")} AS record_date, {_BATCH} AS ingestion_timestamp)
  FROM raw_flights)""",
        f"fl_renamed AS (SELECT * EXCLUDE (row_id) FROM (SELECT {flight_columns()} FROM fl_loaded one) t)",
        newest("fl_newest", "fl_renamed", "icao24, first_seen_ts",
               f"{newest_first}, {', '.join(f'{c} ASC NULLS LAST' for c in _FLIGHT_OTHERS)}"),
        f"""daily_flights AS (SELECT *, CASE WHEN {day} BETWEEN DATE '2000-01-01' AND DATE '2099-12-31' THEN {day}
  ELSE DATE '1900-01-01' END AS seen_day FROM fl_newest)""",
        AIRPORTS.replace("ORDER BY icao NULLS LAST, row_id", f"ORDER BY {airport_order}").replace(
            "TIMESTAMP '2025-01-01 00:00:00'", _BATCH).replace("SELECT row_id, airport_key", "SELECT airport_key"),
        "hourly AS (" + "\n  UNION ALL ".join([
            _hourly("departure", "dep_operator", True), _hourly("departure", "dep_not_departed", False),
            _hourly("arrival", "arr_operator", True), _hourly("arrival", "arr_not_arrived", False)]) + ")",
        """daily_efficiency AS (
  SELECT airport_icao, flight_date, direction, hour, count(*) AS scheduled, count(*) FILTER (WHERE operated) AS operated,
         count(*) FILTER (WHERE NOT operated) AS not_operated, count(delay_seconds) AS with_actual,
         CAST(sum(delay_seconds) AS BIGINT) AS total_delay_seconds, count(*) FILTER (WHERE delay_seconds <= 900) AS on_time
  FROM hourly GROUP BY airport_icao, flight_date, direction, hour)""",
    ]
    tables = {"stg_airports": "stg_airports", "stg_flights": "daily_flights", "kpi_efficiency_hourly": "daily_efficiency"}
    tables |= {f"stg_departures_{k}": f"dep_{k}" for k in ("base", "not_departed", "operator", "unlinkable")}
    tables |= {f"stg_arrivals_{k}": f"arr_{k}" for k in ("base", "not_arrived", "operator", "unlinkable")}
    return ctes, tables


#: Load time of the daily job's first batch.
_BATCH = "TIMESTAMP '2025-01-02 00:00:00'"


def daily_sql() -> dict[str, str]:
    ctes, tables = daily_ctes()
    feeds = ["raw_departures", "raw_arrivals", "raw_flights", "raw_airports"]
    rows = "\nUNION ALL\n".join(f"""SELECT '{name}' AS table_name, md5(string_agg(c || '=' || v, '|' ORDER BY c)) AS row_md5
FROM (UNPIVOT (SELECT row_number() OVER () AS rn, COLUMNS(*)::VARCHAR FROM {cte}) ON COLUMNS(* EXCLUDE (rn)) INTO NAME c VALUE v) u GROUP BY rn"""
                                for name, cte in tables.items())
    models = {name: cte for name, cte in tables.items() if name.startswith("stg_")}
    return {
        "daily_run": with_ctes(feeds, ctes, "SELECT * FROM dep_operator"),
        "daily_tables": with_ctes(feeds, ctes, f"SELECT table_name, row_md5, count(*) AS copies FROM ({rows}) d GROUP BY table_name, row_md5"),
        "repeated_keys": with_ctes(["raw_flights"], [], """
SELECT icao24, firstSeen, count(*) AS n_rows, count(*) FILTER (WHERE batch = 2) AS n_new,
       CAST(min(batch) AS BIGINT) AS first_batch, CAST(max(batch) AS BIGINT) AS last_batch
FROM (SELECT icao24, firstSeen, 1 AS batch FROM raw_flights
      UNION ALL SELECT icao24, firstSeen, 2 FROM raw_flights WHERE upper(estArrivalAirport) = 'LFPG') b
GROUP BY icao24, firstSeen HAVING count(*) > 1 AND max(batch) = 2"""),
        "daily_checks": with_ctes(feeds, ctes, counts_sql(models)),
    }
