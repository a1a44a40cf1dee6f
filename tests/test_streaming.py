"""The Structured Streaming load resumes from its checkpoint and loads each landed file once."""

import datetime as dt

from aerostage.plans.catalog import raw
from aerostage.session import scratch_path
from aerostage.sources import landing
from aerostage.streaming.ingest import ingest_schedules, read_raw

from conftest import SF_SMALL


def test_restart_loads_only_new_files(spark):
    landing_root = scratch_path(spark, "t_landing")
    raw_root, ckpt = scratch_path(spark, "t_sraw"), scratch_path(spark, "t_sckpt")
    dep, arr = raw(spark, SF_SMALL, "raw_departures"), raw(spark, SF_SMALL, "raw_arrivals")
    early, later = dep.where("flight_date < '2024-01-15'"), dep.where("flight_date >= '2024-01-15'")
    landing.write_schedule_payloads(early, arr.limit(0), landing_root + "/a", mode="append")
    q = ingest_schedules(spark, landing_root + "/a", raw_root, ckpt, dt.datetime(2025, 1, 2))
    q.awaitTermination()
    assert read_raw(spark, raw_root, "departures").count() == early.count()
    # rerun with nothing new: nothing is loaded again
    q = ingest_schedules(spark, landing_root + "/a", raw_root, ckpt, dt.datetime(2025, 1, 2))
    q.awaitTermination()
    assert read_raw(spark, raw_root, "departures").count() == early.count()
    # new files land; the next run picks up only those
    landing.write_schedule_payloads(later, arr.limit(0), landing_root + "/a", mode="append")
    q = ingest_schedules(spark, landing_root + "/a", raw_root, ckpt, dt.datetime(2025, 1, 2))
    q.awaitTermination()
    assert read_raw(spark, raw_root, "departures").count() == dep.count()


def test_flights_stream_loads_arrays_once(spark):
    from aerostage.plans.catalog_nested import flights_for_landing
    from aerostage.streaming.ingest import ingest_flights, read_raw_flights

    landing_root = scratch_path(spark, "t_fl_landing")
    raw_root, ckpt = scratch_path(spark, "t_fl_raw"), scratch_path(spark, "t_fl_ckpt")
    fl = flights_for_landing(spark, SF_SMALL)
    landing.write_flight_arrays(fl, landing_root)
    for _ in range(2):  # the second run finds nothing new
        ingest_flights(spark, landing_root, raw_root, ckpt, dt.datetime(2025, 1, 2)).awaitTermination()
    got = read_raw_flights(spark, raw_root)
    assert got.count() == fl.count()
    assert got.select("ingestion_timestamp").distinct().count() == 1


def test_stream_loads_compressed_files(spark, tmp_path):
    import glob

    import __spark_entry__ as E
    from aerostage.session import local_path, shared_dir
    from test_landing import landed_bytes

    spark.range(0, 2000, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:11' + make_dt_interval(0, id % 40) AS ts", "id % 90 AS user_id",
        "element_at(array('view', 'purchase', 'error'), int(id % 3) + 1) AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    before = set(glob.glob(f"{local_path(shared_dir(spark))}/aerostage/schedules-*"))
    got = E.queries()["streaming_landing"](spark, str(tmp_path))
    assert got.count() == 2000
    root, = set(glob.glob(f"{local_path(shared_dir(spark))}/aerostage/schedules-*")) - before
    on_disk, text = landed_bytes(root)
    assert spark.read.text(root).count() == 4000 and on_disk < text / 4
