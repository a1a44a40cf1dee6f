"""The daily job end to end: CLI, load twice (staging unchanged), a later day touches only its partitions."""

import datetime as dt
import os

from pyspark.sql import functions as F

from aerostage.plans import daily, staging, store
from aerostage.plans.catalog import raw
from aerostage.plans.catalog_nested import flights_for_landing
from aerostage.session import local_path, scratch_path
from aerostage.sources import landing

from conftest import SF_SMALL


def _land(spark, root, where=None, mode="overwrite"):
    dep, arr = raw(spark, SF_SMALL, "raw_departures"), raw(spark, SF_SMALL, "raw_arrivals")
    fl = flights_for_landing(spark, SF_SMALL)
    if where is not None:
        dep, arr, fl = dep.where(where), arr.where(where), fl.where(where.replace("flight_date", "record_date"))
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    landing.write_schedule_payloads(dep, arr, layout.schedules, mode=mode)
    landing.write_flight_arrays(fl, layout.flights)
    return layout


def test_cli_runs_all_checks(spark):
    from aerostage.__main__ import main

    root = scratch_path(spark, "t_cli")
    layout = _land(spark, root)
    airports = f"{root}/landing/airports"
    landing.write_airports_csv(raw(spark, SF_SMALL, "raw_airports"), airports)
    code = main(["run", "--landing", layout.landing, "--warehouse", layout.warehouse, "--airports", airports,
                 "--batch-id", "7"])
    results = spark.read.parquet(layout.checks)
    assert results.count() == 57 and results.select("batch_id").distinct().first()[0] == 7
    # the declared base uniqueness key omits callsign and mode-S, so that check can fail: exit code 1
    failing = {r.check_name for r in results.where("NOT passed").collect()}
    assert code == (1 if failing else 0)


def test_loading_twice_leaves_staging_unchanged(spark):
    layout = _land(spark, scratch_path(spark, "t_twice"))
    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    first = daily.read_staged(spark, layout, "stg_departures_operator").drop("ingestion_timestamp")
    first = first.cache()
    n = first.count()
    days = [r[0] for r in daily.read_staged(spark, layout, "stg_departures_base").select("flight_date").distinct().collect()]
    daily.run_days(spark, layout, 2, dt.datetime(2025, 1, 3), days=days)
    second = daily.read_staged(spark, layout, "stg_departures_operator")
    assert [r[0] for r in second.select("ingestion_timestamp").distinct().collect()] == [dt.datetime(2025, 1, 3)]
    second = second.drop("ingestion_timestamp")
    assert second.count() == n == first.unionByName(second).distinct().count()
    first.unpersist()


def test_a_later_day_rewrites_only_its_partitions(spark):
    root = scratch_path(spark, "t_days")
    layout = _land(spark, root, where="flight_date < '2024-01-20'")
    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    staged = local_path(layout.staging("stg_departures_base"))
    old_day = os.path.join(staged, "version=1", "flight_date=2024-01-05")
    before = sorted(os.listdir(old_day))
    _land(spark, root, where="flight_date = '2024-01-25'", mode="append")
    touched = daily.load(spark, layout, 2, dt.datetime(2025, 1, 3), days=[dt.date(2024, 1, 25)])
    assert touched == [dt.date(2024, 1, 25)]
    daily.stage(spark, layout, touched)
    assert sorted(os.listdir(old_day)) == before
    held = {str(r.day): r.version for r in daily.store.snapshot(spark, layout.staging_root).where("model = 'stg_departures_base'").collect()}
    assert held["2024-01-05"] == 1 and held["2024-01-25"] == 2 and os.listdir(os.path.join(staged, "version=2")) != []
    got = daily.read_staged(spark, layout, "stg_departures_base").where(F.col("flight_date") == "2024-01-25")
    assert got.count() > 0


def test_days_where_some_models_are_empty(spark):
    """On a couple of days a class model can have no row: its folder holds no data file, yet the next
    steps read it (with the model's schema) and every check still reports."""
    from aerostage.plans.checks import CHECKS

    layout = _land(spark, scratch_path(spark, "t_few_days"))
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    results = daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2), days=days)
    assert results.count() == sum(len(v) for k, v in CHECKS.items() if k != "stg_airports")
    staged = daily.read_staged(spark, layout, "stg_departures_base")
    assert sorted(r[0] for r in staged.select("flight_date").distinct().collect()) == days


def test_a_feed_with_nothing_landed_loads_as_empty(spark):
    """Schedules landed, observed flights not (their folder is missing): the run still loads and
    stages the schedules, and the flights checks report on an empty table."""
    root = scratch_path(spark, "t_one_feed")
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    dep, arr = raw(spark, SF_SMALL, "raw_departures"), raw(spark, SF_SMALL, "raw_arrivals")
    landing.write_schedule_payloads(dep, arr, layout.schedules)
    results = daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    flights_checks = results.where(F.col("model") == "stg_flights").collect()
    assert flights_checks and all(r.failures == 0 for r in flights_checks)
    assert daily.read_staged(spark, layout, "stg_departures_base").count() > 0


def test_only_new_files_are_loaded(spark):
    root = scratch_path(spark, "t_new_files")
    layout = _land(spark, root, where="flight_date < '2024-01-10'")

    def loaded():
        return daily.store.read_committed(spark, layout.raw, "departures", daily.RAW_SCHEMAS["departures"]).count()

    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    n = loaded()
    assert n == raw(spark, SF_SMALL, "raw_departures").where("flight_date < '2024-01-10'").count() > 0
    assert daily.run_days(spark, layout, 2, dt.datetime(2025, 1, 3)).count() == 0 and loaded() == n
    _land(spark, root, where="flight_date = '2024-01-05'", mode="append")  # more files of a loaded day
    assert daily.load(spark, layout, 3, dt.datetime(2025, 1, 4))[-1] == dt.date(2024, 1, 5)
    assert loaded() == n + raw(spark, SF_SMALL, "raw_departures").where("flight_date = '2024-01-05'").count()
    # that run failed before staging: the next one, with nothing new to load, stages its days
    assert daily.pending(spark, layout)[0] == [3]
    assert daily.run_days(spark, layout, 4, dt.datetime(2025, 1, 5)).count() > 0
    assert daily.pending(spark, layout) == ([], [])


def test_a_flight_returned_on_two_days_is_staged_once(spark):
    root = scratch_path(spark, "t_two_days")
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    fl = flights_for_landing(spark, SF_SMALL).where("icao24 is not null and firstSeen is not null")
    one = fl.orderBy("icao24", "firstSeen").limit(1)
    for batch, day in ((1, "2024-01-05"), (2, "2024-01-06")):
        landing.write_flight_arrays(one.withColumn("record_date", F.lit(day).cast("date")), layout.flights)
        daily.run_days(spark, layout, batch, dt.datetime(2025, 1, 1 + batch))
    got = daily.read_staged(spark, layout, "stg_flights").collect()
    assert [str(r.flight_date) for r in got] == ["2024-01-06"]


def test_junk_epochs_are_staged_with_the_rest(spark):
    """Epochs far outside the calendar stay as rows of the staging table and do not stop this or a later run."""
    root = scratch_path(spark, "t_junk")
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    one = flights_for_landing(spark, SF_SMALL).where("icao24 is not null and firstSeen is not null").orderBy("icao24", "firstSeen").limit(1)
    one = one.withColumn("record_date", F.lit("2024-01-05").cast("date")).cache()
    junk = [300_000_000_000, -70_000_000_000, 86_400, 9_000_000_000_000, None]
    rows = one
    for j in junk:
        rows = rows.unionByName(one.withColumn("firstSeen", F.lit(j).cast(one.schema["firstSeen"].dataType)))
    landing.write_flight_arrays(rows, layout.flights)
    for batch in (1, 2):
        daily.run_days(spark, layout, batch, dt.datetime(2025, 1, 1 + batch))
    assert daily.pending(spark, layout) == ([], [])
    staged = daily.read_staged(spark, layout, "stg_flights")
    got = {r[0] for r in staged.select(F.year("first_seen_ts")).collect()}
    want = staging.flights(rows.withColumn("ingestion_timestamp", F.lit(dt.datetime(2025, 1, 2)).cast("timestamp_ntz")))
    assert got == {r[0] for r in want.select(F.year("first_seen_ts")).collect()} and {11476, 1970, None} < got
    assert staged.select("seen_day").distinct().count() == 2  # the good day and one folder for all others


def test_a_malformed_record_fails_the_load(spark, tmp_path):
    import pytest

    folder = tmp_path / "landing" / "schedules" / "airport_icao=EDDF" / "flight_date=2024-01-05" / "half=first_half"
    folder.mkdir(parents=True)
    layout = daily.Layout(landing=str(tmp_path / "landing"), warehouse=str(tmp_path / "warehouse"))
    for text in ('{"departures": [{"number": "A 1"}]}\n{"departures": [{"num', '{\n "departures": [\n {"number": "A 1"}\n ]\n}'):
        (folder / "response.json").write_text(text)
        with pytest.raises(Exception, match="Malformed records: [1-9]"):
            daily.load(spark, layout, 1, dt.datetime(2025, 1, 2))
    from aerostage.sources import payload
    assert payload.read_schedule_payloads(spark, layout.schedules, multi_line=True).first().departures[0].number == "A 1"


def test_malformed_lines_are_quarantined_and_counted(spark, tmp_path):
    """Three bad lines among four hundred good ones, two of one file, and a bad record of the other feed."""
    root = scratch_path(spark, "t_quarantine")
    layout = _land(spark, root, where="flight_date < '2024-01-12'")
    bad = ['{"departures": [{"num', '{"departures": "none"}', '{"departures": [{"number": "A", "isCargo": "maybe"}]}']
    lines = spark.createDataFrame([("EDDF", dt.date(2024, 1, 5), "first_half", b) for b in bad], "airport_icao string, flight_date date, half string, value string")
    landing.write_response_lines(lines, layout.schedules)
    spark.createDataFrame([("2024-01-05", '[{"icao24": "x", "firstSeen": ')], "record_date string, value string").write.mode(
        "append").partitionBy("record_date").text(layout.flights)
    want = raw(spark, SF_SMALL, "raw_departures").where("flight_date < '2024-01-12'").count()
    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    read = lambda name: daily.store.read_committed(spark, layout.raw, name, daily.RAW_SCHEMAS[name])
    assert read("departures").count() == want
    got = {(r.feed, r.line) for r in read("quarantine").collect()}
    assert got == {("schedules", b) for b in bad} | {("flights", '[{"icao24": "x", "firstSeen": ')}
    assert all(r.file_path.startswith("file:") for r in read("quarantine").collect())
    assert read("responses").agg({"bad_lines": "sum"}).first()[0] == 3
    assert daily.run_days(spark, layout, 2, dt.datetime(2025, 1, 3)).count() == 0, "later loads are not held up"


def test_coverage_of_requests(spark):
    """Landed with legs, landed empty, one-sided, with a malformed line only, never landed; a file loaded again counts once."""
    root = scratch_path(spark, "t_cover")
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    day = dt.date(2024, 1, 5)
    leg = '{"number": "A 1"}'
    responses = [
        ("0123", "first_half", '{"departures": [%s, %s], "arrivals": [%s]}' % (leg, leg, leg)), ("0123", "second_half", "{}"),
        ("EDDF", "first_half", '{"departures": [%s]}' % leg), ("EDDF", "second_half", '{"arrivals": [%s], "departures": []}' % leg),
        ("LFPG", "first_half", '{"departures": [{"num'),
    ]
    df = spark.createDataFrame([(a, day, h, v) for a, h, v in responses], "airport_icao string, flight_date date, half string, value string")
    landing.write_response_lines(df, layout.schedules)
    for batch in (1, 2):
        daily.load(spark, layout, batch, dt.datetime(2025, 1, 2), days=[day], max_bad_share=0.5)
    airports = spark.createDataFrame([("0123",), ("EDDF",), ("LFPG",), ("LSZH",)], "icao string")
    got = {(r.airport_icao, r.half): (r.departures, r.arrivals, r.bad_lines, r.status) for r in daily.cover(spark, layout, airports, [day], 2).collect()}
    assert got == {
        ("0123", "first_half"): (2, 1, 0, "ok"), ("0123", "second_half"): (0, 0, 0, "no_content"),
        ("EDDF", "first_half"): (1, 0, 0, "no_arrivals"), ("EDDF", "second_half"): (0, 1, 0, "no_departures"),
        ("LFPG", "first_half"): (0, 0, 1, "no_content"), ("LFPG", "second_half"): (None, None, None, "never_landed"),
        ("LSZH", "first_half"): (None, None, None, "never_landed"), ("LSZH", "second_half"): (None, None, None, "never_landed")}


def _all_tables(spark, layout):
    names = [m for m in ("stg_departures_base", *daily.DEPARTURE_MODELS, "stg_arrivals_base", *daily.ARRIVAL_MODELS, "stg_flights")]
    return {m: sorted(map(str, daily.read_staged(spark, layout, m).select("flight_date", "ingestion_timestamp").collect())) for m in names}


def test_a_crash_at_any_write_leaves_the_old_tables(spark, monkeypatch):
    """The second run dies at the first, a middle and the last table and at the switch itself: readers see the first
    run's tables; the run after that finishes the work."""
    root = scratch_path(spark, "t_crash")
    layout = _land(spark, root, where="flight_date = '2024-01-05'")
    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    old = _all_tables(spark, layout)
    assert sum(map(len, old.values())) > 0
    days = [dt.date(2024, 1, 5)]
    daily.load(spark, layout, 2, dt.datetime(2025, 1, 3), days=days)
    write, switch = daily.store.write_version, daily.store.publish_snapshot
    for at in (1, 5, 10, None):
        calls = []

        def dies(*args, at=at, calls=calls):
            calls.append(args)
            if at is None or len(calls) == at:
                raise OSError("lost")
            return write(*args)

        monkeypatch.setattr(daily.store, "write_version" if at else "publish_snapshot", dies)
        try:
            daily.stage(spark, layout, days, batches=[2])
            raise AssertionError("the run must have died")
        except OSError:
            pass
        monkeypatch.setattr(daily.store, "write_version", write)
        monkeypatch.setattr(daily.store, "publish_snapshot", switch)
        assert daily.store.next_version(spark, layout.staging_root) == 2
    assert _all_tables(spark, layout) == old
    daily.run_days(spark, layout, 3, dt.datetime(2025, 1, 4))
    new = _all_tables(spark, layout)
    assert new != old and {k: len(v) for k, v in new.items()} == {k: len(v) for k, v in old.items()}
    flights = sum(daily.read_staged(spark, layout, m).count() for m in (
        "stg_departures_operator", "stg_departures_not_departed", "stg_arrivals_operator", "stg_arrivals_not_arrived"))
    assert daily.read_staged(spark, layout, daily.EFFICIENCY).agg({"scheduled": "sum"}).first()[0] == flights > 0
    assert daily.store.drop_versions(spark, layout.staging_root, keep=1) and _all_tables(spark, layout) == new


def test_small_batches_are_merged_and_switched_together(spark, monkeypatch):
    root = scratch_path(spark, "t_compact")
    layout = daily.Layout(landing=f"{root}/landing", warehouse=f"{root}/warehouse")
    for batch, day in ((1, "2024-01-05"), (2, "2024-01-06"), (3, "2024-01-05")):
        _land(spark, root, where=f"flight_date = '{day}'", mode="append")
        daily.load(spark, layout, batch, dt.datetime(2025, 1, 1 + batch))
        if batch < 3:
            daily.store.publish(spark, layout.raw, batch, dt.datetime(2025, 1, 9), daily.STAGED)

    def rows():
        out = {}
        for name, schema in daily.RAW_SCHEMAS.items():
            read = daily.store.read_committed(spark, layout.raw, name, schema).drop("batch_id")
            out[name] = sorted(map(str, read.collect()))
        return out

    before = rows()
    publish = daily.store.publish

    def dies(spark_, root_, batch, ts, name=daily.store.MANIFEST, replaces=None):
        if replaces:
            raise OSError("lost")
        publish(spark_, root_, batch, ts, name)

    monkeypatch.setattr(daily.store, "publish", dies)
    try:
        daily.compact_raw(spark, layout, 100, dt.datetime(2025, 1, 9))
        raise AssertionError("the merge must have died")
    except OSError:
        pass
    monkeypatch.setattr(daily.store, "publish", publish)
    assert rows() == before and daily.pending(spark, layout)[0] == [3]
    merged = daily.compact_raw(spark, layout, 100, dt.datetime(2025, 1, 9))
    assert merged == {100: [1, 2]} and rows() == before and daily.pending(spark, layout)[0] == [3]
    daily.store.drop_replaced(spark, layout.raw, list(daily.RAW_SCHEMAS), merged)
    assert rows() == before
    assert {r[0] for r in daily.store.manifest(spark, layout.raw).select("batch_id").collect()} == {3, 100}


def test_merges_are_planned_by_size():
    plan = daily.store.plan_merges
    assert plan([(1, 40), (2, 40), (3, 40), (4, 200), (5, 10), (6, 10)], 100) == [[1, 2], [5, 6]]
    assert plan([(1, 100), (2, 99), (3, 100)], 100) == [] and plan([], 100) == []


def test_a_key_of_two_loads_is_found_in_its_day_only(spark):
    """A flight loaded again: found over the whole history, by reading the folders of its own day."""
    root = scratch_path(spark, "t_repeated")
    layout = _land(spark, root)
    daily.run_days(spark, layout, 1, dt.datetime(2025, 3, 1))
    raw_flights = spark.read.parquet(f"{layout.raw}/flights")
    one = raw_flights.where("seen_day > DATE '2000-01-01'").orderBy("seen_day", "icao24", "firstSeen").first()
    same = raw_flights.where((F.col("icao24") == one.icao24) & (F.col("firstSeen") == one.firstSeen))
    n = same.count()
    again = spark.createDataFrame(same.limit(1).drop("batch_id", "ingestion_timestamp").collect(), same.drop("batch_id", "ingestion_timestamp").schema)
    store.write_batch({"flights": again}, layout.raw, 2, dt.datetime(2025, 3, 2), sources={"flights": None},
                      partition_cols={"flights": "seen_day"}, schemas=daily.RAW_SCHEMAS)
    found = daily.repeated_keys(spark, layout, [2])
    assert [tuple(r) for r in found.collect()] == [(one.icao24, one.firstSeen, n + 1, 1, 1, 2)]
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "firstSeen" in line]
    assert scans and all(str(one.seen_day) in s.split("PartitionFilters: [")[1] for s in scans)
    now = spark.read.parquet(f"{layout.raw}/flights")
    files = now.where(F.col("seen_day") == one.seen_day).select("_metadata.file_path").distinct().count()
    total = now.select("_metadata.file_path").distinct().count()
    assert files < total / 2, (files, total)
    assert daily.repeated_keys(spark, layout, [99]).count() == 0


def test_a_run_leaves_no_scratch_tables(spark):
    root = scratch_path(spark, "t_scratch")
    layout = _land(spark, root)
    base = os.path.dirname(local_path(root))
    before = set(os.listdir(base))
    results = daily.run_days(spark, layout, 1, dt.datetime(2025, 3, 1))
    assert results.count() == 53 and set(os.listdir(base)) == before
    assert spark.read.parquet(layout.repeated).count() >= 0


def _shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
    names = {held.apply(i).getName() for i in range(held.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _left(spark, before):
    """Shuffle files made since; they are deleted in the background, so some seconds are given."""
    import time

    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_landing_and_daily_run_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    layout = _land(spark, scratch_path(spark, "t_freed"), "flight_date < '2024-01-03'")
    assert not _left(spark, before)
    daily.run_days(spark, layout, 1, dt.datetime(2025, 1, 2))
    assert not _left(spark, before)
    assert daily.read_staged(spark, layout, "stg_departures_base").count() > 0
    spark.range(50).repartition(3).write.format("noop").mode("overwrite").save()
    assert _left(spark, before)  # other jobs are as before


def test_a_load_leaves_no_parsed_lines(spark):
    from aerostage.session import shared_dir

    folder = f"{local_path(shared_dir(spark))}/aerostage"
    layout = _land(spark, scratch_path(spark, "t_lines"), "flight_date < '2024-01-03'")
    before = set(os.listdir(folder))
    days = daily.load(spark, layout, 1, dt.datetime(2025, 1, 2))
    assert len(days) > 0 and set(os.listdir(folder)) == before
    assert store.read_committed(spark, layout.raw, "departures", daily.RAW_SCHEMAS["departures"]).count() > 0
