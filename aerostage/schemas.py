"""Payload, raw and staging schemas (fixed schema system, no evolution).

Raw column names and order are those of the landed warehouse tables; the payload shape is the one
the schedule and observed-flight feeds deliver.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()
D = T.DateType()
B = T.BooleanType()
L = T.LongType()
I = T.IntegerType()
DBL = T.DoubleType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- schedule payload (nested JSON) ---------------------------------------------------------
TIME_PAIR = struct(("utc", S), ("local", S))
AIRPORT = struct(("icao", S), ("iata", S), ("name", S), ("timeZone", S))
MOVEMENT = struct(
    ("airport", AIRPORT),
    ("scheduledTime", TIME_PAIR),
    ("revisedTime", TIME_PAIR),
    ("runwayTime", TIME_PAIR),
    ("terminal", S),
    ("runway", S),
    ("gate", S),
    ("baggageBelt", S),
    ("quality", T.ArrayType(S)),
)
LEG = struct(
    ("number", S),
    ("callSign", S),
    ("status", S),
    ("codeshareStatus", S),
    ("isCargo", B),
    ("aircraft", struct(("reg", S), ("modeS", S), ("model", S))),
    ("airline", struct(("name", S), ("iata", S), ("icao", S))),
    ("departure", MOVEMENT),
    ("arrival", MOVEMENT),
)
SCHEDULE_PAYLOAD = struct(("departures", T.ArrayType(LEG)), ("arrivals", T.ArrayType(LEG)))

# ---- observed flights payload (flat JSON array) --------------------------------------------
OBSERVED_FLIGHT = struct(
    ("icao24", S),
    ("firstSeen", L),
    ("estDepartureAirport", S),
    ("lastSeen", L),
    ("estArrivalAirport", S),
    ("callsign", S),
    ("estDepartureAirportHorizDistance", I),
    ("estDepartureAirportVertDistance", I),
    ("estArrivalAirportHorizDistance", I),
    ("estArrivalAirportVertDistance", I),
    ("departureAirportCandidatesCount", I),
    ("arrivalAirportCandidatesCount", I),
)

# ---- airport CSV -------------------------------------------------------------------------------
AIRPORTS_CSV = struct(
    ("airport", S), ("country", S), ("state", S), ("city", S), ("icao", S), ("iata", S),
    ("elevation_ft", DBL), ("latitude", DBL), ("longitude", DBL),
)

# ---- raw schedule tables: (column, payload path, type) ---------------------------------------
# Shared leading columns; ``flight_date`` and ``airport_icao`` come from the request, not the payload.
SHARED_FIELDS: list[tuple[str, str | None, T.DataType]] = [
    ("number", "number", S),
    ("flight_date", None, D),
    ("callSign", "callSign", S),
    ("status", "status", S),
    ("codeshareStatus", "codeshareStatus", S),
    ("isCargo", "isCargo", B),
    ("aircraft_reg", "aircraft.reg", S),
    ("aircraft_modeS", "aircraft.modeS", S),
    ("aircraft_model", "aircraft.model", S),
    ("airline_name", "airline.name", S),
    ("airline_iata", "airline.iata", S),
    ("airline_icao", "airline.icao", S),
    ("airport_icao", None, S),
]


def _times(side: str) -> list[tuple[str, str, T.DataType]]:
    out = []
    for kind in ("scheduled", "revised", "runway"):
        for zone in ("utc", "local"):
            out.append((f"{side}_{kind}time_{zone}", f"{side}.{kind}Time.{zone}", TS))
    return out


def _airport(side: str) -> list[tuple[str, str, T.DataType]]:
    return [(f"{side}_airport_{k.lower()}", f"{side}.airport.{k}", S) for k in ("icao", "iata", "name", "timeZone")]


DEPARTURE_FIELDS = SHARED_FIELDS + _times("departure") + [
    ("departure_terminal", "departure.terminal", S),
    ("departure_runway", "departure.runway", S),
] + _airport("arrival") + _times("arrival") + [
    ("arrival_terminal", "arrival.terminal", S),
    ("arrival_gate", "arrival.gate", S),
    ("arrival_baggagebelt", "arrival.baggageBelt", S),
]

ARRIVAL_FIELDS = SHARED_FIELDS + _airport("departure") + _times("departure") + [
    ("departure_terminal", "departure.terminal", S),
    ("departure_runway", "departure.runway", S),
] + _times("arrival") + [
    ("arrival_terminal", "arrival.terminal", S),
    ("arrival_runway", "arrival.runway", S),
    ("arrival_gate", "arrival.gate", S),
    ("arrival_baggagebelt", "arrival.baggageBelt", S),
]

LOAD_DEFAULTS: list[tuple[str, T.DataType]] = [("ingestion_timestamp", TS), ("data_source", S)]

# Fixed value: the schedule feed's name written to ``data_source``.
SCHEDULE_SOURCE_NAME = "AeroDataBox"


def raw_schema(fields) -> T.StructType:
    return struct(*[(n, t) for n, _, t in fields], *LOAD_DEFAULTS)


RAW_DEPARTURES = raw_schema(DEPARTURE_FIELDS)
RAW_ARRIVALS = raw_schema(ARRIVAL_FIELDS)
RAW_FLIGHTS = struct(*[(f.name, f.dataType) for f in OBSERVED_FLIGHT.fields], ("record_date", D), ("ingestion_timestamp", TS))
RAW_AIRPORTS = AIRPORTS_CSV
# The legacy loader's two per-airport tables of observed flights.
LEGACY_FLIGHTS = struct(*[(f.name, f.dataType) for f in OBSERVED_FLIGHT.fields], ("airport_icao", S), ("ingestion_timestamp", TS))
