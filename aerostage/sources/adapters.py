"""Raw flight tables derived from the driver's tables.

The test tables carry no flights, so the raw landing tables are derived from ``events`` (one schedule
record per event) and ``supplier`` (two airport rows per supplier). Each column is one SQL expression
that Spark and DuckDB evaluate identically, so the same text builds the Spark input and the oracle's
CTE. The values are invented; they exist to hit every branch of the staging logic: padded and null
text, cargo, records of the wrong day, missing identifiers, groups of one to four rows, missing times.

Every expression is row-local, so the adapters scale with ``events`` and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- shared time expressions ----------------------------------------------------------------
_DAY = "date_trunc('day', ts)"
_HOUR = "date_trunc('hour', ts)"
_SLOT = "(hour(ts) - hour(ts)%6)"


def _plus_hour(expr: str, hours: int) -> str:
    return f"(({expr}) + interval '{hours}' hour)" if hours else expr


_DEP_SCHED = (f"case when event_id%29=0 then null when event_id%23=0 then {_DAY} + interval '1' day "
              f"else {_DAY} + {_SLOT} * interval '1' hour end")
_DEP_REV = f"case when event_id%3=0 then null else {_HOUR} + (event_id%45 - 10) * interval '1' minute end"
_DEP_RWY = f"case when event_id%4=0 then null else {_HOUR} + (event_id%60 - 5) * interval '1' minute end"
_ARR_SCHED = f"case when event_id%31=0 then null else {_DAY} + ({_SLOT} + 2) * interval '1' hour end"
_ARR_REV = f"case when event_id%6=0 then null else {_HOUR} + (event_id%50 + 100) * interval '1' minute end"
_ARR_RWY = f"case when event_id%8=0 then null else {_HOUR} + (event_id%55 + 105) * interval '1' minute end"

# Arrivals seen from the arriving airport: the outbound leg left London earlier.
_IN_DEP_SCHED = f"case when event_id%31=0 then null else {_DAY} + ({_SLOT} - 2) * interval '1' hour end"
_IN_DEP_REV = f"case when event_id%6=0 then null else {_HOUR} - (event_id%50 + 100) * interval '1' minute end"
_IN_DEP_RWY = f"case when event_id%8=0 then null else {_HOUR} - (event_id%55 + 95) * interval '1' minute end"
_IN_ARR_RWY = f"case when event_id%4<>0 then null else {_HOUR} + (event_id%60 - 5) * interval '1' minute end"

_INGESTED = "timestamp '2025-01-01 00:00:00' + (event_id%50) * interval '1' second"

_SHARED_HEAD = [
    ("row_id", "event_id"),
    ("number", "case when event_id%11=0 then concat('XQ', cast(event_id%3 as string)) "
               "else concat('LH ', cast(event_id%3 as string)) end"),
    ("flight_date", "cast(ts as date)"),
    ("callSign", "case when user_id%10=0 then null else concat('dlh', cast(user_id%60 as string)) end"),
]
_SHARED_TAIL = [
    ("codeshareStatus", "case when event_id%5=0 then 'IsCodeshared' else ' IsOperator' end"),
    ("isCargo", "case when event_id%17=0 then true when event_id%19=0 then null else false end"),
    ("aircraft_reg", "concat('D-A', cast(user_id%60 as string))"),
    ("aircraft_modeS", "case when user_id%20=0 or event_id%13=0 then null else concat('3C', cast(user_id%60 as string)) end"),
    ("aircraft_model", "case when event_id%9=0 then null else 'A320' end"),
    ("airline_name", "case when event_id%3=0 then null else 'Line' end"),
    ("airline_iata", "case when event_id%2=0 then null else 'LH' end"),
    ("airline_icao", "case when event_id%4=1 then null else 'DLH' end"),
    ("airport_icao", "case user_id%4 when 0 then 'EDDF' when 1 then 'LFPG' when 2 then 'LSZH' else 'OMDB' end"),
]
_LONDON = [
    ("icao", "case when event_id%7=0 then null else 'EGLL' end"),
    ("iata", "case when event_id%7=0 then null else 'LHR' end"),
    ("name", "'London Heathrow'"),
    ("timezone", "'Europe/London'"),
]
_LOAD = [("ingestion_timestamp", _INGESTED), ("data_source", "'AeroDataBox'")]


def _times(side: str, sched: str, rev: str, rwy: str, local_offset: int) -> list[tuple[str, str]]:
    out = []
    for kind, expr in (("scheduled", sched), ("revised", rev), ("runway", rwy)):
        out.append((f"{side}_{kind}time_utc", expr))
        out.append((f"{side}_{kind}time_local", _plus_hour(expr, local_offset)))
    return out


RAW_DEPARTURES: list[tuple[str, str]] = (
    _SHARED_HEAD
    + [("status", "case event_type when 'error' then 'Canceled' when 'signup' then null "
                  "when 'purchase' then ' Departed ' else 'Departed' end")]
    + _SHARED_TAIL
    + _times("departure", _DEP_SCHED, _DEP_REV, _DEP_RWY, 1)
    + [("departure_terminal", "case when event_id%10=0 then null else cast(event_id%3 + 1 as string) end"),
       ("departure_runway", "case when event_id%2=0 then '25C' else '07L' end")]
    + [(f"arrival_airport_{k}", e) for k, e in _LONDON]
    + _times("arrival", _ARR_SCHED, _ARR_REV, _ARR_RWY, 0)
    + [("arrival_terminal", "cast(event_id%5 + 1 as string)"),
       ("arrival_gate", "concat('A', cast(event_id%40 as string))"),
       ("arrival_baggagebelt", "case when event_id%6=0 then null else cast(event_id%12 as string) end")]
    + _LOAD
)

RAW_ARRIVALS: list[tuple[str, str]] = (
    _SHARED_HEAD
    + [("status", "case event_type when 'error' then 'Canceled' when 'signup' then null "
                  "when 'purchase' then ' Arrived ' when 'view' then 'Approaching' else 'Delayed' end")]
    + _SHARED_TAIL
    + [(f"departure_airport_{k}", e) for k, e in _LONDON]
    + _times("departure", _IN_DEP_SCHED, _IN_DEP_REV, _IN_DEP_RWY, 0)
    + [("departure_terminal", "cast(event_id%5 + 1 as string)"),
       ("departure_runway", "case when event_id%2=0 then '27L' else '09R' end")]
    + _times("arrival", _DEP_SCHED, _DEP_REV, _IN_ARR_RWY, 1)
    + [("arrival_terminal", "case when event_id%10=0 then null else cast(event_id%3 + 1 as string) end"),
       ("arrival_runway", "case when event_id%2=0 then '25C' else '07L' end"),
       ("arrival_gate", "concat('B', cast(event_id%30 as string))"),
       ("arrival_baggagebelt", "case when event_id%6=0 then null else cast(event_id%12 as string) end")]
    + _LOAD
)

_EPOCH = "1704067200 + (event_id%30) * 86400 + (event_id%3) * 3600"

# Distance and record_date are text here, so that the number and date casts see values that fail.
RAW_FLIGHTS: list[tuple[str, str]] = [
    ("row_id", "event_id"),
    ("icao24", "concat('3c', cast(user_id%75 as string))"),
    ("firstSeen", _EPOCH),
    ("estDepartureAirport", "case when event_id%4=0 then null else 'eddf' end"),
    ("lastSeen", f"{_EPOCH} + 3600 + event_id%900"),
    ("estArrivalAirport", "case when event_id%5=0 then null else 'lfpg' end"),
    ("callsign", "concat(' dlh', cast(user_id as string), '  ')"),
    ("estDepartureAirportHorizDistance", "case when event_id%7=0 then 'x' else cast(event_id%5000 as string) end"),
    ("estDepartureAirportVertDistance", "event_id%300"),
    ("estArrivalAirportHorizDistance", "case when event_id%9=0 then null else event_id%7000 end"),
    ("estArrivalAirportVertDistance", "event_id%250"),
    ("departureAirportCandidatesCount", "event_id%4"),
    ("arrivalAirportCandidatesCount", "event_id%3"),
    ("record_date", "concat('2024-01-', lpad(cast(event_id%32 as string), 2, '0'))"),
    ("ingestion_timestamp", _INGESTED),
]

# Built over ``supplier`` taken twice (dup = 0, 1), so the airport list grows with the tables;
# upper-casing folds the two ICAO spellings of one airport together.
RAW_AIRPORTS: list[tuple[str, str]] = [
    ("row_id", "s_suppkey * 2 + dup"),
    ("airport", "s_name"),
    ("country", "case s_nationkey%5 when 0 then 'DE' when 1 then 'FR' when 2 then 'CH' when 3 then 'AE' else 'US' end"),
    ("state", "case when s_suppkey%5=0 then null else concat('S', cast(s_nationkey%5 as string)) end"),
    ("city", "lower(s_name)"),
    ("icao", "case when dup=0 then concat('N', lpad(cast(s_suppkey as string), 8, '0')) "
             "else concat('n', lpad(cast(s_suppkey as string), 8, '0')) end"),
    ("iata", "concat('n', cast(s_suppkey as string))"),
    ("elevation_ft", "case s_suppkey%3 when 0 then '' when 1 then 'x' else cast(s_suppkey * 100 as string) end"),
    ("latitude", "concat(cast(s_suppkey%90 as string), '.25')"),
    ("longitude", "case when s_suppkey%4=0 then null else concat('-', cast(s_nationkey as string), '.5') end"),
]

ADAPTERS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "raw_departures": ("events", RAW_DEPARTURES),
    "raw_arrivals": ("events", RAW_ARRIVALS),
    "raw_flights": ("events", RAW_FLIGHTS),
    "raw_airports": ("supplier_twice", RAW_AIRPORTS),
}

_SUPPLIER_TWICE_SQL = "(select *, 0 as dup from supplier union all select *, 1 as dup from supplier)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    if source == "supplier_twice":
        supplier = table(spark, sf_dir, "supplier")
        return supplier.withColumn("dup", F.lit(0)).unionByName(supplier.withColumn("dup", F.lit(1)))
    return table(spark, sf_dir, source)


#: Tasks for each core over which ``spread`` deals rows.
SPREAD = 2


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores. A scan has a task for each row group at most, so a table of few large ones leaves cores idle
    in every costly step up to the next shuffle; its rows are narrow, so dealing them first costs little."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)


def raw(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False) -> DataFrame:
    """The adapter ``name`` as a Spark DataFrame; time columns as ``timestamp_ntz``. ``dealt``: its source rows ``spread`` first."""
    source, columns = ADAPTERS[name]
    rows = _source(spark, sf_dir, source)
    df = (spread(rows) if dealt else rows).selectExpr(*[f"{expr} AS `{col}`" for col, expr in columns])
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])


def sql_cte(name: str) -> str:
    """The adapter ``name`` as a DuckDB CTE: ``name AS (SELECT ...)``."""
    source, columns = ADAPTERS[name]
    src = _SUPPLIER_TWICE_SQL if source == "supplier_twice" else source
    cols = ",\n    ".join(f'{expr} AS "{col}"' for col, expr in columns)
    return f"{name} AS (\n  SELECT\n    {cols}\n  FROM {src} AS src\n)"


def columns(name: str) -> list[str]:
    return [c for c, _ in ADAPTERS[name][1]]
