"""The ten staging models (M1-M10) as DataFrame functions.

Each takes the raw (or upstream staging) DataFrame and returns a new one; nothing is collected.
Extra input columns that the models do not name (for instance a ``row_id`` lineage column) are carried
through every model, the way ``SELECT *`` carries them; ``row_id``, when present, is the tie-break of
every ranking (else all other columns in name order).

Physical shape, per model (see ``explain``):

* ``departures_base`` (M3): scan -> project/filter (pushed to Parquet) -> partial top-1 -> exchange on
  the 8 identity keys -> top-1 -> partial top-1 -> exchange on the 5 flight keys -> top-1.
* ``departures_operator`` (M5): M3 -> filter to operator departures -> partial top-2 -> exchange on the
  4 pair keys (only the filtered rows) -> top-2 -> ``lead`` in the same window -> rank 1.
* arrivals (M7, M8): newest-record dedup (partial top-1, exchange on its 6 keys), then the pair merge
  with its own exchange on the 4 pair keys (partial top-2 before it): the two key lists share only the
  day and airport, too coarse to cluster on.

Every window key list contains ``flight_date``, so a date filter passes through the windows to the scan.
"""

from __future__ import annotations


import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostage.functions import casts, flags, predicates as P, text
from aerostage.operators.dedup import asc, desc, keep_first
from aerostage.operators.pair_merge import pair_merge
from aerostage.operators.surrogate import global_row_number
from aerostage.schemas import ARRIVAL_FIELDS, DEPARTURE_FIELDS, LOAD_DEFAULTS

# ---- column lists --------------------------------------------------------------------------
_RAW_KNOWN_DEP = {n for n, _, _ in DEPARTURE_FIELDS} | {n for n, _ in LOAD_DEFAULTS}
_RAW_KNOWN_ARR = {n for n, _, _ in ARRIVAL_FIELDS} | {n for n, _ in LOAD_DEFAULTS}


def _extras(df: DataFrame, known: set[str]) -> list[str]:
    """Input columns the model does not know about (lineage columns), kept in input order."""
    low = {k.lower() for k in known}
    return [c for c in df.columns if c.lower() not in low]


def _renamed_core(raw: DataFrame) -> list[Column]:
    return [
        F.col("number").alias("flight_number"),
        casts.safe_cast(raw, "flight_date", "date").alias("flight_date"),
        text.upper("callSign").alias("callsign"),
        text.trim("status").alias("status"),
        text.trim("codeshareStatus").alias("codeshare_status"),
        F.col("isCargo").alias("is_cargo"),
        F.col("aircraft_reg"),
        F.col("aircraft_modeS").alias("aircraft_mode_s"),
        F.col("aircraft_model"),
        F.col("airline_name"),
        F.col("airline_iata"),
        F.col("airline_icao"),
        F.col("airport_icao"),
    ]


def _times(side: str) -> list[Column]:
    out = []
    for kind in ("scheduled", "revised", "runway"):
        for zone in ("utc", "local"):
            out.append(F.col(f"{side}_{kind}time_{zone}").alias(f"{side}_{kind}_{zone}"))
    return out


def _airport(side: str) -> list[Column]:
    return [F.col(f"{side}_airport_{k}") for k in ("icao", "iata", "name", "timezone")]


def _tail() -> list[Column]:
    return [F.col("ingestion_timestamp"), F.col("data_source")]

DEPARTURE_IDENTITY = ["flight_number", "flight_date", "callsign", "aircraft_mode_s", "airport_icao",
                      "departure_scheduled_utc", "arrival_airport_icao", "arrival_scheduled_utc"]
DEPARTURE_FLIGHT = ["flight_number", "flight_date", "callsign", "aircraft_mode_s", "airport_icao"]
ARRIVAL_IDENTITY = ["flight_number", "flight_date", "departure_airport_icao", "departure_scheduled_utc",
                    "airport_icao", "arrival_scheduled_utc"]
PAIR_KEYS = ["flight_date", "callsign", "aircraft_mode_s", "airport_icao"]

_CORE_NAMES = ["flight_number", "flight_date", "callsign", "status", "codeshare_status", "is_cargo",
               "aircraft_reg", "aircraft_mode_s", "aircraft_model", "airline_name", "airline_iata",
               "airline_icao", "airport_icao"]


def _time_names(side: str) -> list[str]:
    return [f"{side}_{k}_{z}" for k in ("scheduled", "revised", "runway") for z in ("utc", "local")]


def _airport_names(side: str) -> list[str]:
    return [f"{side}_airport_{k}" for k in ("icao", "iata", "name", "timezone")]


DEP_BASE_COLUMNS = (_CORE_NAMES + _time_names("departure") + _airport_names("arrival") + _time_names("arrival")
                    + ["ingestion_timestamp", "data_source"])
ARR_BASE_COLUMNS = (_CORE_NAMES + _airport_names("departure") + _time_names("departure") + _time_names("arrival")
                    + ["ingestion_timestamp", "data_source"])


# ---- M3 / M7: base models --------------------------------------------------------------------
def departures_filtered(raw: DataFrame) -> DataFrame:
    """Renamed departures that are not cargo and whose scheduled UTC day is the flight date."""
    extras = _extras(raw, _RAW_KNOWN_DEP)
    return raw.where(P.not_cargo("isCargo") & P.same_day("departure_scheduledtime_utc", "flight_date")).select(
        *[F.col(c) for c in extras],
        *_renamed_core(raw), *_times("departure"), *_airport("arrival"), *_times("arrival"), *_tail(),
    )


def departures_base(raw: DataFrame, strict_complete: bool = False) -> DataFrame:
    """M3: newest record of each full identity, then the most complete record of each flight.

    Each step shuffles on its own keys with a partial top-1 before the shuffle: copies collapse before
    the first, and the second spreads a day's unidentified flights of one airport (null callsign and
    mode-S, one group under coarser keys) over their flight numbers.
    """
    latest = keep_first(departures_filtered(raw), DEPARTURE_IDENTITY, [desc("ingestion_timestamp")])
    return keep_first(latest, DEPARTURE_FLIGHT, [asc(flags.completeness_flag(strict_complete))])


def arrivals_filtered(raw: DataFrame) -> DataFrame:
    extras = _extras(raw, _RAW_KNOWN_ARR)
    return raw.where(P.not_cargo("isCargo") & P.same_day("arrival_scheduledtime_utc", "flight_date")).select(
        *[F.col(c) for c in extras],
        *_renamed_core(raw), *_airport("departure"), *_times("departure"), *_times("arrival"), *_tail(),
    )


def arrivals_base(raw: DataFrame) -> DataFrame:
    """M7: newest record of each full arrival identity."""
    return keep_first(arrivals_filtered(raw), ARRIVAL_IDENTITY, [desc("ingestion_timestamp")])


# ---- M4-M6: departure classes --------------------------------------------------------------
def departures_not_departed(base: DataFrame) -> DataFrame:
    """M4: operator rows whose status is not 'Departed' (null status falls in no class)."""
    return base.where(P.is_operator() & P.status_not(P.DEPARTED))


def departures_unlinkable(base: DataFrame) -> DataFrame:
    """M6: departed operator rows with neither callsign nor mode-S."""
    return base.where(P.is_operator() & P.status_is(P.DEPARTED) & P.unidentified())


_DEP_OPERATOR_OUT = [
    "flight_number", "flight_date", "callsign", "status", "codeshare_status", "is_cargo",
    "aircraft_reg", "aircraft_mode_s", "aircraft_model", "airline_name", "airline_iata", "airline_icao",
    "airport_icao", "departure_scheduled_utc", "departure_revised_utc", "departure_runway_utc",
    "arrival_airport_icao", "arrival_airport_iata", "arrival_airport_name", "arrival_airport_timezone",
    "arrival_scheduled_utc", "arrival_revised_utc", "arrival_runway_utc", "ingestion_timestamp", "data_source",
]
_DEP_FILL = ["departure_scheduled_utc", "departure_revised_utc", "departure_runway_utc",
             "arrival_scheduled_utc", "arrival_revised_utc", "arrival_runway_utc"]


def _with_fallbacks(df: DataFrame) -> DataFrame:
    return df.withColumn("airline_iata", text.airline_iata_fallback("airline_iata", "flight_number")).withColumn(
        "airline_icao", text.airline_icao_fallback("airline_icao", "callsign"))


def departures_operator(base: DataFrame) -> DataFrame:
    """M5: departed operator rows, the two earliest of each (date, callsign, mode-S, airport) merged."""
    rows = base.where(P.status_is(P.DEPARTED) & P.is_operator() & P.identified())
    extras = [c for c in rows.columns if c not in DEP_BASE_COLUMNS]
    merged = pair_merge(rows, PAIR_KEYS, [asc("departure_scheduled_utc")], _DEP_FILL,
                        output=extras + _DEP_OPERATOR_OUT)
    return _with_fallbacks(merged)


# ---- M8-M10: arrival classes ----------------------------------------------------------------
def arrivals_not_arrived(base: DataFrame) -> DataFrame:
    """Operator rows whose status is not an arrived class (null status falls in no class)."""
    return base.where(P.is_operator() & P.status_not_in(P.ARRIVED_STATUSES))


def arrivals_unlinkable(base: DataFrame) -> DataFrame:
    """M9: arrived operator rows with neither callsign nor mode-S."""
    return base.where(P.is_operator() & P.status_in(P.ARRIVED_STATUSES) & P.unidentified())


_ARR_OPERATOR_OUT = [
    "flight_number", "flight_date", "callsign", "status", "codeshare_status", "is_cargo",
    "aircraft_reg", "aircraft_mode_s", "aircraft_model", "airline_name", "airline_iata", "airline_icao",
    "airport_icao", "arrival_scheduled_utc", "arrival_revised_utc", "arrival_runway_utc",
    "departure_airport_icao", "departure_airport_iata", "departure_airport_name", "departure_airport_timezone",
    "departure_scheduled_utc", "departure_revised_utc", "departure_runway_utc", "ingestion_timestamp", "data_source",
]
_ARR_FILL = ["airline_name"] + _DEP_FILL


def arrivals_operator(base: DataFrame) -> DataFrame:
    """M8: arrived operator rows; the most reliable two of each group merged."""
    rows = base.where(P.status_in(P.ARRIVED_STATUSES) & P.identified() & P.is_operator())
    extras = [c for c in rows.columns if c not in ARR_BASE_COLUMNS]
    scored = rows.withColumn("reliability_score", flags.reliability_score())
    merged = pair_merge(scored, PAIR_KEYS, [desc("reliability_score")], _ARR_FILL, output=extras + _ARR_OPERATOR_OUT)
    return _with_fallbacks(merged)


# ---- M1 / M2: dimensions and observed flights -------------------------------------------------
# Fixed value: the source label written by the airport model.
AIRPORTS_SOURCE_TABLE = "airports"


def airports(raw: DataFrame, loaded_at: _dt.datetime | None = None) -> DataFrame:
    """M1: one row per upper-cased ICAO code, with a surrogate key numbered over the raw rows.

    ``loaded_at`` stamps ``record_loaded_at``; pass the batch time so results repeat.
    """
    loaded = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp()
    tiebreak = ["row_id"] if "row_id" in raw.columns else [c for c in raw.columns if c != "icao"]
    keyed = global_row_number(raw, [asc("icao")] + [asc(c) for c in tiebreak], name="airport_key")
    extras = [c for c in raw.columns if c == "row_id"]
    renamed = keyed.select(
        *extras,
        F.col("airport_key"),
        F.col("airport").alias("airport_name"),
        F.col("country"),
        F.col("state"),
        F.col("city"),
        text.upper("icao").alias("airport_icao"),
        text.upper("iata").alias("airport_iata"),
        casts.safe_cast(keyed, "elevation_ft", "double").alias("elevation_ft"),
        casts.safe_cast(keyed, "latitude", "double").alias("latitude"),
        casts.safe_cast(keyed, "longitude", "double").alias("longitude"),
        loaded.alias("record_loaded_at"),
        F.lit(AIRPORTS_SOURCE_TABLE).alias("source_table"),
    )
    return keep_first(renamed, ["airport_icao"], [desc("record_loaded_at")], tiebreak=[asc("airport_key")])


# The first-seen day of records without a usable first-seen time, and the usable days. The feed's flights
# lie in this century; days outside it (junk epochs) share one folder instead of making one each.
SEEN_UNKNOWN = _dt.date(1900, 1, 1)
SEEN_FROM, SEEN_TO = _dt.date(2000, 1, 1), _dt.date(2099, 12, 31)


def known_day(day) -> Column:
    """``day``, or SEEN_UNKNOWN where it is null or outside the usable days."""
    c = F.col(day) if isinstance(day, str) else day
    return F.when(c.between(F.lit(SEEN_FROM), F.lit(SEEN_TO)), c).otherwise(F.lit(SEEN_UNKNOWN))


def seen_day(first_seen_ts) -> Column:
    """Day a flight was first seen: a function of M2's key, so all records of one flight share it."""
    return known_day(F.to_date(first_seen_ts))


def raw_seen_day(raw: DataFrame) -> Column:
    """``seen_day`` of raw observed flights."""
    return seen_day(casts.epoch_to_timestamp(casts.safe_cast(raw, "firstSeen", "bigint")))


def flights(raw: DataFrame) -> DataFrame:
    """M2: observed flights, newest load of each (icao24, first seen)."""
    extras = [c for c in raw.columns if c == "row_id"]

    def num(name: str) -> Column:
        return casts.safe_cast(raw, name, "bigint")

    renamed = raw.select(
        *extras,
        text.upper("icao24").alias("icao24"),
        text.upper_trim("callsign").alias("callsign"),
        text.upper("estDepartureAirport").alias("est_departure_airport"),
        text.upper("estArrivalAirport").alias("est_arrival_airport"),
        num("firstSeen").alias("first_seen"),
        num("lastSeen").alias("last_seen"),
        casts.epoch_to_timestamp(num("firstSeen")).alias("first_seen_ts"),
        casts.epoch_to_timestamp(num("lastSeen")).alias("last_seen_ts"),
        num("estDepartureAirportHorizDistance").alias("dep_airport_horiz_distance"),
        num("estDepartureAirportVertDistance").alias("dep_airport_vert_distance"),
        num("estArrivalAirportHorizDistance").alias("arr_airport_horiz_distance"),
        num("estArrivalAirportVertDistance").alias("arr_airport_vert_distance"),
        num("departureAirportCandidatesCount").alias("departure_airport_candidates_count"),
        num("arrivalAirportCandidatesCount").alias("arrival_airport_candidates_count"),
        casts.safe_cast(raw, "record_date", "date").alias("flight_date"),
        F.col("ingestion_timestamp"),
    )
    return keep_first(renamed, ["icao24", "first_seen_ts"], [desc("ingestion_timestamp")])


def departures_operator_grouped(base: DataFrame) -> DataFrame:
    """M5 as one aggregation of each group's first two records; same rows as ``departures_operator``.

    The rank limit below the exchange leaves two rows of a group at most, so the aggregation is bounded. A
    group with a null key gets no fill.
    """
    from aerostage.operators.dedup import rank_within

    rows = base.where(P.status_is(P.DEPARTED) & P.is_operator() & P.identified())
    two = rank_within(rows, PAIR_KEYS, [asc("departure_scheduled_utc")], name="rn").where(F.col("rn") <= 2)
    filled = [c for c in _DEP_OPERATOR_OUT if c in _DEP_FILL]
    merged = two.groupBy(*PAIR_KEYS).agg(
        F.min_by(F.struct(*rows.columns), "rn").alias("one"),
        F.max(F.when(F.col("rn") == 2, F.struct(*filled))).alias("two"))
    known = F.concat(*[F.col(k).cast("string") for k in PAIR_KEYS]).isNotNull()
    cols = [F.col(f"one.{c}").alias(c) for c in rows.columns if c not in DEP_BASE_COLUMNS]
    cols += [F.coalesce(F.col(f"one.{c}"), F.when(known, F.col(f"two.{c}"))).alias(c) if c in filled else F.col(f"one.{c}").alias(c)
             for c in _DEP_OPERATOR_OUT]
    return _with_fallbacks(merged.select(*cols))
