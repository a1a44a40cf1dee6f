"""Landed payload objects stay bounded even when one airport-day holds every row."""

import os

import pytest
from pyspark.sql import functions as F

from aerostage.plans.catalog import raw
from aerostage.session import local_path, scratch_path
from aerostage.sources import landing, payload

from conftest import SF_CHECK


def test_copies_and_null_keys_land_one_leg_to_a_line(spark):
    r = raw(spark, SF_CHECK, "raw_departures")
    hot = r.withColumn("airport_icao", F.when(F.col("row_id") % 10 > 0, "EDDF")) if "row_id" in r.columns else r.withColumn(
        "airport_icao", F.when(F.xxhash64("number") % 10 != 0, "EDDF"))
    copies = hot.limit(1).crossJoin(spark.range(2000)).drop("id")
    every = hot.unionByName(copies)
    root = scratch_path(spark, "t_hot_landing")
    landing.write_schedule_payloads(every, r.limit(0), root)
    read = payload.read_schedule_payloads(spark, root)
    sizes = read.select(F.size("departures").alias("n")).where("n > 0").groupBy("n").count().collect()
    assert [(x["n"], x["count"]) for x in sizes] == [(1, r.count() + 2000)]
    assert read.where("airport_icao is null").count() == every.where("airport_icao is null").count() > 0


def test_pretty_printed_flight_documents_read_with_multi_line(spark, tmp_path):
    import json

    folder = tmp_path / "flights" / "record_date=2024-01-05"
    folder.mkdir(parents=True)
    docs = [[{"icao24": "3c1", "firstSeen": 1704441600, "callsign": "DLH1 ", "estDepartureAirportHorizDistance": 5}],
            [{"icao24": "3c2", "firstSeen": 1704445200}, {"icao24": "3c3", "firstSeen": 1704448800}]]
    for i, doc in enumerate(docs):
        (folder / f"response-{i}.json").write_text(json.dumps(doc, indent=2))
    got = payload.read_observed_flights(spark, str(tmp_path / "flights"), multi_line=True)
    rows = sorted((r.icao24, r.firstSeen, str(r.record_date)) for r in got.collect())
    assert rows == [("3c1", 1704441600, "2024-01-05"), ("3c2", 1704445200, "2024-01-05"),
                    ("3c3", 1704448800, "2024-01-05")]


def test_strict_completeness_variant_runs_and_keeps_one_row_per_flight(spark):
    from aerostage.plans import staging

    r = raw(spark, SF_CHECK, "raw_departures")
    default = staging.departures_base(r)
    strict = staging.departures_base(r, strict_complete=True)
    assert strict.count() == default.count()  # same groups, possibly other winners
    keys = staging.DEPARTURE_FLIGHT
    assert strict.groupBy(*keys).count().where("count > 1").count() == 0


def test_responses_of_many_requests_land_in_few_files_and_keep_their_requests(spark, tmp_path):
    import datetime as dt
    import glob

    import __spark_entry__ as E
    from aerostage.session import local_path, shared_dir
    from aerostage.sources import requests

    day, leg = dt.date(2024, 1, 5), '{"number": "A 1"}'
    some = [("EDDF", "first_half", '{"departures": [%s]}' % leg), ("EDDF", "first_half", '{"departures": [{"num'), ("EDDF", "first_half", "5"),
            ("a\tb/c", "second_half", "{}"), (None, "first_half", "{}"), ("0123", "first_half", '{"departures": [{"isCargo": "maybe"}]}')]
    rows = [(a, day, h, v) for a, h, v in some + [(f"N{i}", "first_half", "{}") for i in range(500)]]
    root = str(tmp_path / "bundles")
    landing.write_response_bundles(spark.createDataFrame(rows, "airport_icao string, flight_date date, half string, value string"), root)
    found = requests.bundled_responses(payload.bundled_lines(spark, root))
    got = {(r.airport_icao, r.half): (r.departures, r.arrivals, r.bad_lines) for r in found.collect()}
    assert len(got) == 504 and got[("N7", "first_half")] == got[("a\tb/c", "second_half")] == got[(None, "first_half")] == (0, 0, 0)
    assert got[("EDDF", "first_half")] == (1, 0, 2) and got[("0123", "first_half")] == (0, 0, 1)

    tables = tmp_path / "tables"
    tables.mkdir()
    spark.range(8, numPartitions=1).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 10:00:00' + make_dt_interval(id % 4) AS ts", "id * 4 AS user_id",
                                               "'view' AS event_type").write.parquet(str(tables / "events.parquet"))
    spark.range(60, numPartitions=1).selectExpr("id AS s_suppkey", "'s' AS s_name", "id * 0 AS s_nationkey").write.parquet(str(tables / "supplier.parquet"))
    before = set(glob.glob(f"{local_path(shared_dir(spark))}/aerostage/**/part-*", recursive=True))
    out = E.queries()["request_coverage"](spark, str(tables))
    assert {(r.status, r["count"]) for r in out.groupBy("status").count().collect()} >= {("never_landed", 60 * 2 * 2 + 4)}
    landed = set(glob.glob(f"{local_path(shared_dir(spark))}/aerostage/**/part-*", recursive=True)) - before
    assert len(landed) < 60  # 240 empty responses


def test_rows_of_one_row_group_are_dealt_before_they_are_landed(spark, tmp_path, monkeypatch):
    """A table of one file and row group is one scan task; its legs and records are built in many, none lost, copies and nulls kept."""
    from aerostage.plans import catalog_nested
    from aerostage.sources import adapters

    rows = spark.range(0, 3000, numPartitions=1).selectExpr(
        "nullif(id % 1000, 7) AS event_id", "timestamp_ntz'2024-01-01 00:00:11' + make_dt_interval(0, id % 700) AS ts",
        "nullif(id % 90, 11) AS user_id", "element_at(array('view', 'purchase', 'error'), int(id % 3) + 1) AS event_type")
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    landed = {}
    write = landing.write_schedule_payloads
    monkeypatch.setattr(landing, "write_schedule_payloads", lambda dep, arr, path: landed.update(departures=dep, arrivals=arr) or write(dep, arr, path))
    root = catalog_nested.land_schedules(spark, str(tmp_path))
    landed["flights"] = catalog_nested.flights_for_landing(spark, str(tmp_path))
    for name, df in landed.items():
        sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes), (name, sizes)
        plain = adapters.raw(spark, str(tmp_path), f"raw_{name}")
        assert plain.rdd.getNumPartitions() == 1 and plain.count() == 3000
        same = [c for c in plain.columns if c != "record_date"]  # the landed flights have it as their folder's day
        assert df.select(same).exceptAll(plain.select(same)).isEmpty() and plain.select(same).exceptAll(df.select(same)).isEmpty()
    assert spark.read.text(root).count() == 6000


def landed_bytes(root):
    """(bytes on disk, bytes of text) of the landed files."""
    import gzip
    import glob

    files = [f for f in glob.glob(f"{root}/**/part-*", recursive=True)]
    texts = [(gzip.open(f) if f.endswith(".gz") else open(f, "rb")).read() for f in files]
    return sum(os.path.getsize(f) for f in files), sum(map(len, texts))


@pytest.mark.parametrize("name", ["daily_checks", "daily_run", "daily_tables"])
def test_feeds_of_the_daily_job_land_compressed(spark, tmp_path, monkeypatch, name):
    """The text of the landed legs, many times all tables made from it, is not on the disk as it is."""
    import __spark_entry__ as E
    from aerostage.plans import daily

    spark.range(0, 4000, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:11' + make_dt_interval(0, id % 40) AS ts", "id % 90 AS user_id",
        "element_at(array('view', 'purchase', 'error'), int(id % 3) + 1) AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    spark.range(3, numPartitions=1).selectExpr("id AS s_suppkey", "'s' AS s_name", "id AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    held = {}

    class Landed(Exception):
        pass

    def stop(spark, layout, **_):
        held.update(layout=layout)
        raise Landed

    monkeypatch.setattr(daily, "run_days", stop)
    with pytest.raises(Landed):
        E.queries()[name](spark, str(tmp_path))
    for root, lines in ((held["layout"].schedules, 8000), (held["layout"].flights, 4000)):
        on_disk, text = landed_bytes(local_path(root))
        assert spark.read.text(root).count() == lines
        assert on_disk < text / 4


def test_a_compressed_file_holds_few_lines_and_plain_files_are_read_beside_it(spark, tmp_path, monkeypatch):
    import gzip
    import glob

    r = raw(spark, SF_CHECK, "raw_departures").where("airport_icao = 'EDDF' AND flight_date = '2024-01-05'")
    monkeypatch.setattr(landing, "FILE_LINES", 10)
    root = str(tmp_path / "schedules")
    landing.write_schedule_payloads(r, None, root)
    files = glob.glob(f"{root}/**/part-*", recursive=True)
    sizes = [sum(1 for _ in gzip.open(f)) for f in files]
    assert sum(sizes) == r.count() > 10 >= max(sizes)
    with open(os.path.join(os.path.dirname(files[0]), "response.json"), "w") as f:
        f.write('{"departures": [{"number": "LH 9"}]}\n')
    got = payload.departures_from_payloads(payload.read_schedule_payloads(spark, root))
    assert got.count() == r.count() + 1 and got.where("number = 'LH 9'").count() == 1
    cols = ["number", "airport_icao", "flight_date", "departure_scheduledtime_utc", "arrival_gate"]
    assert got.where("number <> 'LH 9'").select(cols).exceptAll(r.select(cols)).isEmpty()


def test_request_coverage_lands_compressed(spark, tmp_path):
    """Legs and bundled responses."""
    import glob

    import __spark_entry__ as E
    from aerostage.session import shared_dir

    spark.range(0, 2000, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:11' + make_dt_interval(0, id % 40) AS ts", "id % 90 AS user_id",
        "element_at(array('view', 'purchase', 'error'), int(id % 3) + 1) AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    spark.range(1000, numPartitions=1).selectExpr("id AS s_suppkey", "'s' AS s_name", "id AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    folder = f"{local_path(shared_dir(spark))}/aerostage"
    before = set(glob.glob(f"{folder}/*"))
    status = {r.status: r["count"] for r in E.queries()["request_coverage"](spark, str(tmp_path)).groupBy("status").count().collect()}
    assert status["no_content"] >= 800 * 2 and sum(status.values()) == 804 * 2 * 2
    for name in ("schedules", "bundles"):
        root = [f for f in set(glob.glob(f"{folder}/{name}-*")) - before]
        assert len(root) == 1
        on_disk, text = landed_bytes(root[0])
        assert 0 < on_disk < text / 4
