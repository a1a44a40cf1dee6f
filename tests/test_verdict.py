"""Faults found by probes: wrong times, lost columns, stale days."""

import datetime as dt

from pyspark.sql import functions as F

from aerostage import schemas
from aerostage.functions import casts
from aerostage.plans import store
from aerostage.session import scratch_path


def test_time_texts_are_read_by_pattern(spark):
    want = {
        "2025-01-02T11:00:00.000Z": dt.datetime(2025, 1, 2, 11), "2025-01-02 11:00:00.123": dt.datetime(2025, 1, 2, 11, 0, 0, 123000),
        "2025-01-02 11:00+01": dt.datetime(2025, 1, 2, 10), "2025-01-02 00:30+0530": dt.datetime(2025, 1, 1, 19), "2025-01-02 11:00:05-02:00": dt.datetime(2025, 1, 2, 13, 0, 5),
        "2025-01-02 11:00": dt.datetime(2025, 1, 2, 11), "2025-01-02 25:00Z": None, "2025-01-02 11:00+19:00": None, "2025-01-02 11:00+01:75": None, "soon": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r[0]: r[1] for r in df.select("t", casts.parse_utc_time("t")).collect()}
    assert got == want
    local = {r[0]: r[1] for r in df.select("t", casts.parse_local_time("t")).collect()}
    assert local["2025-01-02 11:00+01"] == dt.datetime(2025, 1, 2, 11) and local["2025-01-02T11:00:00.000Z"] == dt.datetime(2025, 1, 2, 11)


def test_epoch_out_of_range_is_null(spark):
    df = spark.createDataFrame([("1735861000000",), ("1735861000",), ("x",)], "s string")
    got = [r[0] for r in df.select(casts.epoch_to_timestamp("s")).collect()]
    assert got == [None, dt.datetime(2025, 1, 2, 23, 36, 40), None]


def test_conform_matches_names_without_case(spark):
    df = spark.createDataFrame([("AB1", "x")], "callsign string, extra string")
    out = store.conform(df, schemas.RAW_DEPARTURES)
    assert [c.lower() for c in out.columns].count("callsign") == 1 and out.first()["callSign"] == "AB1" and out.first()["extra"] == "x"


def test_a_day_that_becomes_empty_is_emptied(spark):
    days = [dt.date(2025, 1, d) for d in (1, 2, 3)]
    raw = spark.createDataFrame([(d, "Canceled") for d in days], "flight_date date, status string")
    root, out = scratch_path(spark, "t_raw"), scratch_path(spark, "t_curated")
    raw.write.partitionBy("flight_date").parquet(root)
    model = lambda d: d.where("status = 'Canceled'")
    touched = raw.select("flight_date")
    store.refresh_partitions(spark, root, out, model, touched)
    changed = scratch_path(spark, "t_raw2")
    raw.withColumn("status", F.when(F.dayofmonth("flight_date") == 2, "Departed").otherwise(F.col("status"))).write.partitionBy("flight_date").parquet(changed)
    store.refresh_partitions(spark, changed, out, model, touched.where("flight_date = date'2025-01-02'"))
    assert sorted(r[0] for r in spark.read.parquet(out).select("flight_date").collect()) == [days[0], days[2]]


def test_a_rebuild_leaves_no_stale_days(spark):
    root = scratch_path(spark, "t_models")
    rows = spark.createDataFrame([(dt.date(2025, 1, d), d) for d in range(1, 9)], "flight_date date, n int")
    store.write_models({"m": rows}, root)
    path = store.write_models({"m": rows.where("n = 1")}, root)["m"]
    assert spark.read.parquet(path).count() == 1
