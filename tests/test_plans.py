"""Physical plan shape: shuffles, partial top-k before shuffles, pruning, no one-task windows."""

import contextlib

from pyspark.sql import functions as F

import __spark_entry__ as E
from aerostage.plans import staging
from aerostage.plans.catalog import raw
from aerostage.session import scratch_path

from conftest import SF_SMALL


@contextlib.contextmanager
def no_aqe(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_operator_departures_partial_limit_below_every_shuffle(spark):
    with no_aqe(spark):
        p = plan(E.queries()["departures_operator"](spark, SF_SMALL))
    lines = p.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 3
    # every ranking shuffle is fed by a partial top-k of the same window, right below it
    for i in exchanges:
        assert "WindowGroupLimit" in lines[i + 1] and "Partial" in lines[i + 1], lines[i:i + 2]
    assert "Join" not in p


def test_grouped_pair_merge_has_no_join(spark):
    with no_aqe(spark):
        p = plan(E.queries()["pair_merge_departures"](spark, SF_SMALL))
    assert "Join" not in p


def test_scan_reads_only_needed_columns(spark):
    with no_aqe(spark):
        p = plan(E.queries()["departures_operator"](spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in scan


def test_date_filter_reaches_partitioned_raw_scan(spark):
    path = scratch_path(spark, "t_plan_raw")
    r = raw(spark, SF_SMALL, "raw_departures")
    r.write.partitionBy("flight_date").parquet(path)
    df = staging.departures_operator(staging.departures_base(spark.read.schema(r.schema).parquet(path)))
    with no_aqe(spark):
        p = plan(df.where(F.col("flight_date") == "2024-01-05"))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(flight_date" in scan and "2024-01-05" in scan


def test_global_numbering_sends_only_partition_counts_to_one_task(spark):
    with no_aqe(spark):
        p = plan(E.queries()["airport_key"](spark, SF_SMALL)).splitlines()
    single = [i for i, line in enumerate(p) if "Exchange SinglePartition" in line]
    # only the per-partition count table (one row per partition) is gathered, never the rows
    assert single and all("HashAggregate(keys=[__part" in p[i + 1] for i in single)


def test_link_ranking_reuses_the_join_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with no_aqe(spark):
            p = plan(E.queries()["link_schedule_observed"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # 3 for the operator departures, 1 for the observed dedup, 2 for the join sides, none for the ranking
    assert p.count("Exchange hashpartitioning") == 6


def test_refresh_prunes_untouched_days(spark):
    path = scratch_path(spark, "t_plan_refresh")
    r = raw(spark, SF_SMALL, "raw_departures")
    r.write.partitionBy("flight_date").parquet(path)
    touched = r.where(F.col("flight_date") == "2024-01-20")
    days = F.broadcast(touched.select("flight_date").distinct())
    df = spark.read.schema(r.schema).parquet(path).join(days, "flight_date", "left_semi")
    p = plan(staging.departures_operator(staging.departures_base(df)))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "PartitionFilters: [isnotnull(flight_date" in line]
    assert scans and all("dynamicpruningexpression(flight_date" in s for s in scans)


def test_payload_date_filter_prunes_landing_folders(spark):
    from aerostage.sources import landing, payload

    root = scratch_path(spark, "t_plan_landing")
    landing.write_schedule_payloads(raw(spark, SF_SMALL, "raw_departures"), raw(spark, SF_SMALL, "raw_arrivals"), root)
    df = payload.departures_from_payloads(payload.read_schedule_payloads(spark, root)).where(
        F.col("flight_date") == "2024-01-05")
    p = plan(df)
    scan = [line for line in p.splitlines() if "FileScan json" in line][0]
    assert "PartitionFilters: [isnotnull(flight_date" in scan and "2024-01-05" in scan
    assert df.count() == raw(spark, SF_SMALL, "raw_departures").where(F.col("flight_date") == "2024-01-05").count()
