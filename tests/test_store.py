"""Loads: empty batches, all-or-nothing publishing, partition refresh, idempotent dedup."""

import datetime as dt
import os

from pyspark.sql import functions as F

from aerostage import schemas
from aerostage.plans import staging, store
from aerostage.plans.catalog import raw
from aerostage.session import local_path, scratch_path

from conftest import SF_SMALL

T0 = dt.datetime(2025, 1, 2)


def test_empty_batch_writes_nothing(spark):
    path = scratch_path(spark, "t_empty")
    empty = raw(spark, SF_SMALL, "raw_departures").limit(0)
    assert store.append_raw(empty, path, schemas.RAW_DEPARTURES, T0) is False
    assert not os.path.exists(local_path(path))


def test_append_stamps_one_batch_time_and_source(spark):
    path = scratch_path(spark, "t_append")
    store.append_raw(raw(spark, SF_SMALL, "raw_departures").drop("ingestion_timestamp", "data_source"), path,
                     schemas.RAW_DEPARTURES, T0)
    back = spark.read.parquet(path)
    stamps = back.select("ingestion_timestamp", "data_source").distinct().collect()
    assert [(r.ingestion_timestamp, r.data_source) for r in stamps] == [(T0, "AeroDataBox")]


def test_unpublished_batch_is_invisible(spark):
    root = scratch_path(spark, "t_batches")
    dep = raw(spark, SF_SMALL, "raw_departures").drop("ingestion_timestamp", "data_source")
    arr = raw(spark, SF_SMALL, "raw_arrivals").drop("ingestion_timestamp", "data_source")
    store.write_batch({"departures": dep, "arrivals": arr}, root, 1, T0)
    store.write_batch({"departures": dep}, root, 2, T0, publish_it=False)  # crash before arrivals and manifest
    seen = store.read_committed(spark, root, "departures")
    assert [r.batch_id for r in seen.select("batch_id").distinct().collect()] == [1]
    assert seen.count() == dep.count()


def test_refresh_touches_only_new_days(spark):
    raw_path, curated = scratch_path(spark, "t_raw"), scratch_path(spark, "t_cur")
    first = raw(spark, SF_SMALL, "raw_departures")
    first.write.partitionBy("flight_date").parquet(raw_path)

    def model(df):
        return staging.departures_operator(staging.departures_base(df))

    model(spark.read.schema(first.schema).parquet(raw_path)).write.partitionBy("flight_date").parquet(curated)
    day = "flight_date=2024-01-05"
    untouched = sorted(os.listdir(os.path.join(local_path(curated), day)))
    late = first.where(F.col("flight_date") == "2024-01-20").withColumn(
        "ingestion_timestamp", F.lit(dt.datetime(2025, 2, 1)).cast("timestamp_ntz"))
    late.write.mode("append").partitionBy("flight_date").parquet(raw_path)
    store.refresh_partitions(spark, raw_path, curated, model, late, raw_schema=first.schema)
    assert sorted(os.listdir(os.path.join(local_path(curated), day))) == untouched
    full = model(spark.read.schema(first.schema).parquet(raw_path))
    got = spark.read.schema(full.schema).parquet(curated)
    assert got.count() == full.count() == got.unionByName(full).distinct().count()


def test_reloading_the_same_rows_leaves_staging_unchanged(spark):
    r = raw(spark, SF_SMALL, "raw_departures")
    again = r.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY"))
    once = staging.departures_operator(staging.departures_base(r)).drop("ingestion_timestamp")
    twice = staging.departures_operator(staging.departures_base(r.unionByName(again))).drop("ingestion_timestamp")
    assert once.count() == twice.count() == once.unionByName(twice).distinct().count()


def test_a_retried_batch_is_read_once_without_a_shuffle(spark):
    root = scratch_path(spark, "t_retry")
    dep = raw(spark, SF_SMALL, "raw_departures").drop("ingestion_timestamp", "data_source")
    store.write_batch({"departures": dep}, root, 1, T0, publish_it=False)
    assert store.write_batch({"departures": dep}, root, 1, T0) is True
    assert store.write_batch({"departures": dep}, root, 1, T0) is False
    seen = store.read_committed(spark, root, "departures")
    assert seen.count() == dep.count()
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(batch_id" not in plan and "SortMergeJoin" not in plan
