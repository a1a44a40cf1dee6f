"""Request plan and load coverage.

The load asks the schedule feed for every airport, day and half day. Here that plan is a DataFrame,
built by generators (``sequence`` of days, the two halves) on each airport row - no cross join - and
the coverage report joins it with what actually landed, on the plan's own keys: ``coverage`` with the legs of the
raw tables by their scheduled half day, ``request_coverage`` with the landed responses themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostage import schemas
from aerostage.functions.time import day_bounds
from aerostage.sources import payload
from aerostage.sources.landing import HALF_FIRST, HALF_SECOND


def halves(date_col: str = "flight_date"):
    """The two request windows of a day: start to midday, midday to 23:59 (midday in both)."""
    b = day_bounds(date_col)
    return F.explode(F.array(
        F.struct(F.lit(HALF_FIRST).alias("half"), b["start_str"].alias("time_from"), b["midday_str"].alias("time_to")),
        F.struct(F.lit(HALF_SECOND).alias("half"), b["midday_str"].alias("time_from"), b["end_str"].alias("time_to")),
    ))


def request_plan(airports: DataFrame, start: dt.date, end: dt.date, icao_col: str = "icao") -> DataFrame:
    """One row per (airport, day, half) for the days ``start``..``end``."""
    if start > end:
        raise ValueError(f"empty date range: {start} > {end}")
    days = airports.select(F.col(icao_col).alias("airport_icao"),
                           F.explode(F.sequence(F.lit(start), F.lit(end))).alias("flight_date"))
    return days.select("airport_icao", "flight_date", halves("flight_date").alias("w")).select(
        "airport_icao", "flight_date", "w.half", "w.time_from", "w.time_to")


def half_of(ts_col: str):
    return F.when(F.coalesce(F.hour(F.col(ts_col)), F.lit(0)) < 12, F.lit(HALF_FIRST)).otherwise(F.lit(HALF_SECOND))


def landed_counts(raw: DataFrame, sched_col: str, name: str) -> DataFrame:
    return raw.groupBy("airport_icao", "flight_date", half_of(sched_col).alias("half")).agg(
        F.count(F.lit(1)).alias(name))


def coverage(plan: DataFrame, departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """T4: each planned request with the departures and arrivals that landed for it, and a status."""
    keys = ["airport_icao", "flight_date", "half"]
    dep = landed_counts(departures, "departure_scheduledtime_utc", "departures")
    arr = landed_counts(arrivals, "arrival_scheduledtime_utc", "arrivals")
    out = plan.join(dep, keys, "left").join(arr, keys, "left")
    d = F.coalesce(F.col("departures"), F.lit(0)).cast("bigint")
    a = F.coalesce(F.col("arrivals"), F.lit(0)).cast("bigint")
    status = (F.when((d == 0) & (a == 0), F.lit("no_content"))
              .when(d == 0, F.lit("no_departures"))
              .when(a == 0, F.lit("no_arrivals"))
              .otherwise(F.lit("ok")))
    return out.select(*keys, "time_from", "time_to", d.alias("departures"), a.alias("arrivals"), status.alias("status"))


# ---- coverage by request ---------------------------------------------------------------------------
KEYS = ["airport_icao", "flight_date", "half"]
LISTING = "path string, modificationTime timestamp, length bigint, content binary, airport_icao string, flight_date date, half string"
RESPONSES = schemas.struct(("file_path", schemas.S), ("airport_icao", schemas.S), ("flight_date", schemas.D), ("half", schemas.S),
                           ("departures", schemas.L), ("arrivals", schemas.L), ("bad_lines", schemas.L))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed responses by the file listing (no content is read): file, change time and the request of its folder. Spark
    lists no file of zero bytes, so such a response counts as never landed."""
    listed = spark.read.format("binaryFile").schema(LISTING).load(root)
    return listed.select("_metadata.file_path", "_metadata.file_modification_time", *KEYS)


def _held(lines: DataFrame, *keys: str) -> DataFrame:
    size = lambda c: F.sum(F.when(F.col(payload.BAD_LINE).isNull(), F.coalesce(F.array_size(c), F.lit(0))).otherwise(0))
    return lines.groupBy(*keys).agg(size("departures").alias("departures"), size("arrivals").alias("arrivals"), F.count(payload.BAD_LINE).alias("bad_lines"))


def responses(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Each landed file with its request and the departures, arrivals and malformed lines in it (``payload.schedule_lines``);
    a file without any line has none."""
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return files.join(_held(lines, "file_path"), "file_path", "left").select("file_path", *KEYS, none("departures"), none("arrivals"), none("bad_lines"))


def bundled_responses(lines: DataFrame) -> DataFrame:
    """``responses`` of bundles (``payload.bundled_lines``): a row for each request in each file, named by the lines themselves."""
    return _held(lines, "file_path", *KEYS)


def request_coverage(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """T4 by request: each planned request with the files that landed for it and what they hold. A request that
    never landed has null counts; one that landed empty has zeros (``no_content``)."""
    by = landed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("files"), F.sum("departures").alias("departures"),
                                   F.sum("arrivals").alias("arrivals"), F.sum("bad_lines").alias("bad_lines"))
    d, a = F.col("departures"), F.col("arrivals")
    status = (F.when(F.col("files").isNull(), F.lit("never_landed"))
              .when((d == 0) & (a == 0), F.lit("no_content"))
              .when(d == 0, F.lit("no_departures"))
              .when(a == 0, F.lit("no_arrivals"))
              .otherwise(F.lit("ok")))
    return plan.join(by, KEYS, "left").select(*KEYS, "time_from", "time_to", "files", "departures", "arrivals", "bad_lines", status.alias("status"))
