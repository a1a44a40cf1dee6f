"""Edge rows for the column functions (FIXTURES section 3: P5-P8, P12, P13, P16, T1, F1, F2, F6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerostage.functions import casts, flags, predicates as P, text
from aerostage.functions.time import day_bounds, parse_flight_date


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_try_double_text(spark):
    rows = one_col(spark, ["", "x", "1.5", None, " 12 "]).select(casts.try_double_text("x").alias("y")).collect()
    assert [r.y for r in rows] == [None, None, 1.5, None, 12.0]


def test_try_long_and_date(spark):
    rows = one_col(spark, ["12", "x", "1.5", None]).select(casts.try_long("x").alias("y")).collect()
    assert [r.y for r in rows] == [12, None, None, None]
    rows = one_col(spark, ["2024-01-00", "2024-02-29", "junk"]).select(casts.try_date("x").alias("y")).collect()
    assert [r.y for r in rows] == [None, dt.date(2024, 2, 29), None]


def test_epoch_to_timestamp_is_utc_and_zone_free(spark):
    df = one_col(spark, [0, -1, 1735776000, None], "bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r.y for r in df.select(casts.epoch_to_timestamp("x").alias("y")).collect()]
            assert got == [dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(2025, 1, 2), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("raw,utc,local", [
    ("2025-01-02 11:00+01:00", dt.datetime(2025, 1, 2, 10, 0), dt.datetime(2025, 1, 2, 11, 0)),
    ("2025-01-02T11:00Z", dt.datetime(2025, 1, 2, 11, 0), dt.datetime(2025, 1, 2, 11, 0)),
    ("2025-01-02 11:00:30-05:30", dt.datetime(2025, 1, 2, 16, 30, 30), dt.datetime(2025, 1, 2, 11, 0, 30)),
    ("2025-01-02 11:00", dt.datetime(2025, 1, 2, 11, 0), dt.datetime(2025, 1, 2, 11, 0)),
    ("2025-01-02T11:00:15", dt.datetime(2025, 1, 2, 11, 0, 15), dt.datetime(2025, 1, 2, 11, 0, 15)),
    ("2025-01-02 23:30-01:00", dt.datetime(2025, 1, 3, 0, 30), dt.datetime(2025, 1, 2, 23, 30)),
    ("2025-01-02 11:00+0100", dt.datetime(2025, 1, 2, 10, 0), dt.datetime(2025, 1, 2, 11, 0)),
    ("not a time", None, None),
    ("", None, None),
    (None, None, None),
    ("2025-01-02 25:00", None, None),
])
def test_parse_times(spark, raw, utc, local):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = one_col(spark, [raw]).select(casts.parse_utc_time("x").alias("u"),
                                             casts.parse_local_time("x").alias("l")).first()
            assert (r.u, r.l) == (utc, local), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_airline_fallbacks(spark):
    df = spark.createDataFrame(
        [(None, "LH 123", "dlh1"), (None, "LH123", "dl"), (None, " 123", None), (None, "", "abc"), (None, None, None),
         ("XX", "LH 1", "dlh")], "iata string, n string, cs string")
    got = df.select(text.airline_iata_fallback("iata", "n").alias("i"), text.airline_icao_fallback(F.lit(None), "cs")
                    .alias("c")).collect()
    assert [r.i for r in got] == ["LH", "", "", "", None, "XX"]
    assert [r.c for r in got] == ["dlh", "dl", None, "abc", None, "dlh"]


def test_upper_trim(spark):
    r = one_col(spark, ["  dlh12  "]).select(text.upper_trim("x").alias("y"), text.trim("x").alias("t")).first()
    assert (r.y, r.t) == ("DLH12", "dlh12")


def test_flags(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "arrival_runway_utc int, arrival_revised_utc int")
    assert [r.s for r in df.select(flags.reliability_score().alias("s")).collect()] == [2, 1, 0]
    cols = "departure_revised_utc int, departure_runway_utc int, arrival_scheduled_utc int, " \
           "arrival_revised_utc int, arrival_runway_utc int"
    df = spark.createDataFrame([(1, None, 1, 1, 1), (1, 1, 1, 1, 1), (None, None, 1, 1, 1), (1, None, 1, None, 1)], cols)
    got = df.select(flags.completeness_flag().alias("f"), flags.completeness_flag(strict=True).alias("s")).collect()
    assert [r.f for r in got] == [0, 1, 1, 1]
    assert [r.s for r in got] == [1, 0, 1, 1]


def test_filters_drop_nulls(spark):
    df = spark.createDataFrame([(False, "Departed"), (True, "Canceled"), (None, None)], "isCargo boolean, status string")
    assert df.where(P.not_cargo()).count() == 1
    assert df.where(P.status_not(P.DEPARTED)).count() == 1  # null status is in neither class
    assert df.where(P.status_not_in(P.ARRIVED_STATUSES)).count() == 2


def test_same_day_edges(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59), dt.date(2024, 1, 1)),
                                (dt.datetime(2024, 1, 2, 0, 0, 0), dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1))],
                               "ts timestamp_ntz, flight_date date")
    assert df.where(P.same_day("ts")).count() == 1


def test_day_bounds(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 2),), (dt.date(2024, 2, 29),), (dt.date(2024, 12, 31),)], "d date")
    got = df.select(*[c.alias(n) for n, c in day_bounds("d").items()]).collect()
    assert (got[0].start_epoch, got[0].end_epoch) == (1735776000, 1735862399)
    assert got[1].midday_str == "2024-02-29T12:00" and got[2].end_str == "2024-12-31T23:59"
    with pytest.raises(ValueError):
        parse_flight_date("2025-13-01")
    with pytest.raises(ValueError):
        parse_flight_date("")


def test_scale_settings_size_partitions_from_input():
    from aerostage.session import scale_settings

    s = scale_settings(100 * (1 << 40), total_cores=8000)
    assert int(s["spark.sql.shuffle.partitions"]) <= 50_000 <= int(s["spark.sql.shuffle.partitions"]) + 1
    assert scale_settings(1 << 40, total_cores=800)["spark.sql.shuffle.partitions"] == "4096"
    assert scale_settings(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_safe_cast_skips_text_round_trip_for_typed_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 5, 1.5, "12", "x")],
                               "d date, i int, f double, s string, junk string")
    exprs = [casts.safe_cast(df, "d", "date"), casts.safe_cast(df, "i", "bigint"), casts.safe_cast(df, "f", "double"),
             casts.safe_cast(df, "s", "bigint"), casts.safe_cast(df, "junk", "date")]
    plan = df.select(*exprs)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(d#" not in plan and "cast(f#" not in plan  # typed columns pass through
    assert tuple(df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()) == (
        dt.date(2024, 1, 2), 5, 1.5, 12, None)


def test_coverage_statuses(spark):
    from aerostage.sources.requests import coverage, request_plan

    airports = spark.createDataFrame([("AAAA",), ("BBBB",), ("CCCC",), ("DDDD",)], "icao string")
    plan = request_plan(airports, dt.date(2025, 1, 2), dt.date(2025, 1, 2))
    morning = dt.datetime(2025, 1, 2, 8, 0)
    dep = spark.createDataFrame([("AAAA", dt.date(2025, 1, 2), morning), ("BBBB", dt.date(2025, 1, 2), morning)],
                                "airport_icao string, flight_date date, departure_scheduledtime_utc timestamp_ntz")
    arr = spark.createDataFrame([("AAAA", dt.date(2025, 1, 2), morning), ("CCCC", dt.date(2025, 1, 2), morning)],
                                "airport_icao string, flight_date date, arrival_scheduledtime_utc timestamp_ntz")
    got = {(r.airport_icao, r.half): (r.departures, r.arrivals, r.status)
           for r in coverage(plan, dep, arr).collect()}
    assert got[("AAAA", "first_half")] == (1, 1, "ok")
    assert got[("BBBB", "first_half")] == (1, 0, "no_arrivals")
    assert got[("CCCC", "first_half")] == (0, 1, "no_departures")
    assert got[("DDDD", "first_half")] == (0, 0, "no_content")
    assert got[("AAAA", "second_half")] == (0, 0, "no_content")
    assert len(got) == 8
    with pytest.raises(ValueError):
        request_plan(airports, dt.date(2025, 1, 3), dt.date(2025, 1, 2))


def test_a_time_text_is_matched_once_whatever_its_parts(spark):
    from aerostage.functions import casts

    odd = {"2024-01-05T10:00Z": ("2024-01-05 10:00:00", "2024-01-05 10:00:00"), "2024-01-05 10:00:01.5-05:30": ("2024-01-05 15:30:01.5", "2024-01-05 10:00:01.5"),
           "2024-01-05 10:00+0100": ("2024-01-05 09:00:00", "2024-01-05 10:00:00"), "2024-01-05 10:00+01:60": (None, "2024-01-05 10:00:00"),
           "2024-01-05 10:00-18:01": (None, "2024-01-05 10:00:00"), "2024-01-05 10:00 ": ("2024-01-05 10:00:00", "2024-01-05 10:00:00"),
           " 2024-01-05 10:00Z\n": ("2024-01-05 10:00:00", "2024-01-05 10:00:00"), "2024-02-30 10:00Z": (None, None), "2024-01-05": (None, "2024-01-05 00:00:00"), "x": (None, None)}
    df = spark.createDataFrame([(t,) for t in [*odd, None]], "t string")
    out = df.select("t", casts.parse_utc_time("t").alias("u"), casts.parse_local_time("t").alias("l"))
    got = {r["t"]: (r["u"], r["l"]) for r in out.select("t", out.u.cast("string").alias("u"), out.l.cast("string").alias("l")).collect()}
    assert got == odd | {None: (None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("rlike") == 2 and "regexp" not in plan  # once for each of the two columns
