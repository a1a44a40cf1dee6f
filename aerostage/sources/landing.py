"""Land raw tables as the feeds deliver them: nested schedule payloads and flat observed-flight arrays.

The feeds serve these payloads over web APIs; here they are files in a landing folder, written
from tables Spark derives from the driver's data. Layout:

* schedules: ``<root>/airport_icao=XXXX/flight_date=YYYY-MM-DD/half=first_half|second_half/``, one JSON
  object per line: ``{"departures": [...]}`` or ``{"arrivals": [...]}`` (an object may lack either array)
* bundles of schedule responses: ``<root>/flight_date=YYYY-MM-DD/half=.../``, one response to a line with the airport it was asked
  for: ``{"airport_icao": "XXXX", "value": "<response>"}``. Files grow with the responses' size; a file for each request
  costs more than the responses hold where most are empty
* observed flights: ``<root>/record_date=YYYY-MM-DD/``, one JSON array per line

Every line holds one leg (or record), so nothing is counted, joined or grouped: copies of one leg and a hot
airport-day spread over tasks like any rows, and legs with a null folder key are kept.

Responses land compressed (``.gz``), as they travel: the text of nested legs is many times the size of all tables made from it.
One task reads a compressed file, so a file holds ``FILE_LINES`` lines at most. The readers take plain files too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostage.session import shuffles_freed

HALF_FIRST, HALF_SECOND = "first_half", "second_half"

#: Lines of one landed file at most.
FILE_LINES = 100_000


def _write(lines: DataFrame, path: str, keys: list[str], mode: str, kind: str = "text") -> str:
    """Write compressed files in the folders of ``keys``, on which the rows are rebalanced: few files per folder, and AQE splits a
    hot folder across tasks. The shuffled text goes with the job."""
    out = lines.hint("rebalance", *keys).write.format(kind).mode(mode).partitionBy(*keys)
    with shuffles_freed(lines.sparkSession):
        out.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).save(path)
    return path


def _time_pair(utc: str, local: str) -> Column:
    """``{"utc": "yyyy-MM-dd HH:mmZ", "local": "yyyy-MM-dd HH:mm+hh:mm"}`` as the feed writes them."""
    u, lo = F.col(utc), F.col(local)
    offset_min = F.timestamp_diff("MINUTE", u, lo)
    sign = F.when(offset_min < 0, F.lit("-")).otherwise(F.lit("+"))
    mins = F.abs(offset_min).cast("int")
    offset = F.concat(sign, F.lpad((mins / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                      F.lpad((mins % 60).cast("string"), 2, "0"))
    return F.when(u.isNotNull(), F.struct(
        F.concat(F.date_format(u, "yyyy-MM-dd HH:mm"), F.lit("Z")).alias("utc"),
        F.concat(F.date_format(lo, "yyyy-MM-dd HH:mm"), offset).alias("local"),
    ))


def _quality(side: str) -> Column:
    rev, rwy = F.col(f"{side}_revisedtime_utc"), F.col(f"{side}_runwaytime_utc")
    return F.array_compact(F.array(F.lit("Basic"), F.when(rev.isNotNull(), F.lit("Live")),
                                   F.when(rwy.isNotNull(), F.lit("Runway"))))


def _movement(df: DataFrame, side: str, text_times: bool = True, with_quality: bool = True) -> Column:
    cols = set(df.columns)

    def opt(name: str) -> Column:
        return F.col(name) if name in cols else F.lit(None).cast("string")

    airport = F.struct(*[opt(f"{side}_airport_{k.lower()}").alias(k) for k in ("icao", "iata", "name", "timeZone")])
    fields = [airport.alias("airport")]
    for kind in ("scheduled", "revised", "runway"):
        utc, local = f"{side}_{kind}time_utc", f"{side}_{kind}time_local"
        pair = _time_pair(utc, local) if text_times else F.struct(F.col(utc).alias("utc"), F.col(local).alias("local"))
        fields.append(pair.alias(f"{kind}Time"))
    for raw, name in (("terminal", "terminal"), ("runway", "runway"), ("gate", "gate"), ("baggagebelt", "baggageBelt")):
        fields.append(opt(f"{side}_{raw}").alias(name))
    if with_quality:
        fields.append(_quality(side).alias("quality"))
    return F.struct(*fields)


def leg_struct(df: DataFrame, text_times: bool = True, with_quality: bool = True) -> Column:
    """One raw schedule row as the feed's nested leg object."""
    return F.struct(
        F.col("number"), F.col("callSign"), F.col("status"), F.col("codeshareStatus"), F.col("isCargo"),
        F.struct(F.col("aircraft_reg").alias("reg"), F.col("aircraft_modeS").alias("modeS"),
                 F.col("aircraft_model").alias("model")).alias("aircraft"),
        F.struct(F.col("airline_name").alias("name"), F.col("airline_iata").alias("iata"),
                 F.col("airline_icao").alias("icao")).alias("airline"),
        _movement(df, "departure", text_times, with_quality).alias("departure"),
        _movement(df, "arrival", text_times, with_quality).alias("arrival"),
    )


def write_schedule_payloads(departures: DataFrame | None, arrivals: DataFrame | None, path: str, mode: str = "overwrite") -> str:
    """Write raw departures and arrivals (or one of them) as nested payload JSON under ``path`` (``mode="append"`` lands
    more), one leg to a line: nothing is grouped, so equal legs and null keys cost nothing and are kept."""
    parts = []
    for name, df, sched in (("departures", departures, "departure_scheduledtime_utc"),
                            ("arrivals", arrivals, "arrival_scheduledtime_utc")):
        if df is None:
            continue
        half = F.when(F.coalesce(F.hour(F.col(sched)), F.lit(0)) < 12, F.lit(HALF_FIRST)).otherwise(F.lit(HALF_SECOND))
        keyed = df.withColumn("half", half)
        parts.append(keyed.select("airport_icao", "flight_date", "half",
                                  F.to_json(F.struct(F.array(leg_struct(keyed)).alias(name))).alias("value")))
    return _write(reduce(lambda a, b: a.unionByName(b), parts), path, ["airport_icao", "flight_date", "half"], mode)


def write_response_lines(lines: DataFrame, path: str) -> str:
    """Land more response lines (column ``value``) into their requests' folders."""
    return _write(lines.select("airport_icao", "flight_date", "half", "value"), path, ["airport_icao", "flight_date", "half"], "append")


def write_response_bundles(lines: DataFrame, path: str) -> str:
    """Land response lines (column ``value``) of many requests together. A response of any text, malformed too, keeps its request."""
    return _write(lines.select("airport_icao", "flight_date", "half", "value"), path, ["flight_date", "half"], "append", "json")


def write_flight_arrays(flights: DataFrame, path: str, date_col: str = "record_date",
                        extra_partitions: list[str] | None = None) -> str:
    """Write observed flights as JSON arrays of one record, one to a line, partitioned by ``date_col`` (and extras)."""
    from aerostage.schemas import OBSERVED_FLIGHT

    extra = extra_partitions or []
    rec = F.struct(*[F.col(f.name).cast("string").try_cast(f.dataType).alias(f.name) for f in OBSERVED_FLIGHT.fields])
    keys = [date_col] + extra
    return _write(flights.select(*keys, F.to_json(F.array(rec)).alias("value")), path, keys, "overwrite")


def write_airports_csv(airports: DataFrame, path: str) -> str:
    """Airport list as CSV text with a header row."""
    cols = ["airport", "country", "state", "city", "icao", "iata", "elevation_ft", "latitude", "longitude"]
    airports.select(*[F.col(c).cast("string") for c in cols]).write.mode("overwrite").option("header", True).csv(path)
    return path
