"""Structured Streaming load of landed schedule payloads into the raw tables.

The daily load (fetch, flatten, append departures and arrivals) re-expressed as a file-source stream:
new payload files under the landing root are picked up once, flattened (N5, N3/N4) and appended to the
raw departures and arrivals tables. Progress lives in the checkpoint, so a restarted job resumes where
it stopped and no file is loaded twice. A micro-batch is one batch of ``store.write_batch`` (same layout and
manifest as the daily load): departures and arrivals become visible together, a retried batch replaces its own
rows, a published one is not written again. Writers that share a raw root need different ids: the schedule
stream counts from 0, the flights stream from FLIGHTS_FROM, the daily job takes seconds since the epoch.

``trigger(availableNow=True)`` runs it as a scheduled batch job: everything landed so far, then stop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from aerostage import schemas
from aerostage.plans import staging, store
from aerostage.sources.payload import REQUEST_COLUMNS, STRICT, arrivals_from_payloads, departures_from_payloads, with_fields

RAW_TABLES = {"departures": schemas.RAW_DEPARTURES, "arrivals": schemas.RAW_ARRIVALS,
              "flights": with_fields(schemas.RAW_FLIGHTS, [("seen_day", schemas.D)])}
#: First batch id of the flights stream.
FLIGHTS_FROM = 500_000_000


def batch_time(base: dt.datetime, batch_id: int) -> dt.datetime:
    """Load time of a micro-batch: deterministic, so a replayed batch writes identical rows."""
    return base + dt.timedelta(seconds=batch_id)


def ingest_schedules(spark: SparkSession, landing_root: str, raw_root: str, checkpoint: str,
                     base_time: dt.datetime, available_now: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops by itself after the files present at start."""
    reader = spark.readStream.schema(with_fields(schemas.SCHEDULE_PAYLOAD, REQUEST_COLUMNS)).options(**STRICT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing_root)

    def load(batch: DataFrame, batch_id: int) -> None:
        tables = {"departures": departures_from_payloads(batch).drop("half"),
                  "arrivals": arrivals_from_payloads(batch).drop("half")}
        store.write_batch(tables, raw_root, batch_id, batch_time(base_time, batch_id), schemas=RAW_TABLES)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_raw(spark: SparkSession, raw_root: str, name: str) -> DataFrame:
    """All published batches of one raw table (``batch`` is the batch id)."""
    return store.read_committed(spark, raw_root, name, RAW_TABLES[name]).withColumnRenamed("batch_id", "batch")


def ingest_flights(spark: SparkSession, landing_root: str, raw_root: str, checkpoint: str,
                   base_time: dt.datetime, available_now: bool = True) -> StreamingQuery:
    """The observed-flights feed (JSON arrays, ``record_date=`` folders) into the raw flights table."""
    schema = with_fields(schemas.OBSERVED_FLIGHT, [("record_date", schemas.D)])
    stream = spark.readStream.schema(schema).options(**STRICT).json(landing_root)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("seen_day", staging.raw_seen_day(batch))
        store.write_batch({"flights": rows}, raw_root, FLIGHTS_FROM + batch_id, batch_time(base_time, batch_id),
                          sources={"flights": None}, partition_cols={"flights": "seen_day"}, schemas=RAW_TABLES)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_raw_flights(spark: SparkSession, raw_root: str) -> DataFrame:
    return read_raw(spark, raw_root, "flights")
