"""The daily run: landed feeds -> raw tables -> staging tables -> checks, as Spark jobs.

One run loads the files that no earlier run has loaded, or, with days given, reloads those days:

1. **Load** (E1, E2): read those landed schedule payloads and observed flights (folder partition
   pruning), flatten them and write departures, arrivals, flights and the list of files as one batch,
   published through the manifest only after all are written (K2-K5). Every line is parsed once. Malformed lines go to
   the ``quarantine`` table of the batch; more than ``MAX_BAD_SHARE`` of a feed's lines fail the load.
2. **Stage** (E3, D5, D6): rebuild the staging models of the touched days (of every batch that is
   published and not staged yet) from the published raw rows of those days. The departures and arrivals base tables
   are written first; the class and pair-merged tables are derived from the written base tables.
   The airport dimension is rebuilt whole when an airport file is given. All tables are written as a new version
   beside the current one, and one manifest switches them together (``store.publish_snapshot``).
3. **Check** (Q1-Q7): run the declared checks on the touched days of every staging table and append
   the results, stamped with the batch id, to a results table. Keys of raw flights that an earlier load (or the same) holds
   already are listed in ``repeated_keys``.

4. **Cover** (T4): with an airport file, each planned request of the touched days is reported as ok, one-sided,
   landed empty or never landed.

Layout under ``warehouse``: ``raw/{departures,arrivals,flights,files,responses,quarantine,_batches,_staged}``,
``staging/<model>``, ``checks``, ``repeated_keys``, ``coverage``. Every step is a distributed job; the driver only holds the list of touched days.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostage import schemas
from aerostage.functions import predicates
from aerostage.plans import checks, kpi, staging, store
from aerostage.session import materialize, scratch_scope, shuffles_freed
from aerostage.sources import payload, requests


@dataclass(frozen=True)
class Layout:
    landing: str
    warehouse: str

    @property
    def schedules(self) -> str:
        return f"{self.landing}/schedules"

    @property
    def flights(self) -> str:
        return f"{self.landing}/flights"

    @property
    def raw(self) -> str:
        return f"{self.warehouse}/raw"

    @property
    def staging_root(self) -> str:
        return f"{self.warehouse}/staging"

    def staging(self, model: str) -> str:
        return f"{self.staging_root}/{model}"

    @property
    def coverage(self) -> str:
        return f"{self.warehouse}/coverage"

    @property
    def repeated(self) -> str:
        return f"{self.warehouse}/repeated_keys"

    @property
    def checks(self) -> str:
        return f"{self.warehouse}/checks"


DEPARTURE_MODELS = {
    "stg_departures_not_departed": staging.departures_not_departed,
    "stg_departures_operator": staging.departures_operator,
    "stg_departures_unlinkable": staging.departures_unlinkable,
}
ARRIVAL_MODELS = {
    "stg_arrivals_operator": staging.arrivals_operator,
    "stg_arrivals_not_arrived": staging.arrivals_not_arrived,
    "stg_arrivals_unlinkable": staging.arrivals_unlinkable,
}


FILE = "file_path string, file_modification_time timestamp, day date, airport_icao string, half string"


def landed_files(spark: SparkSession, root: str, col: str) -> DataFrame:
    """Landed files of a feed with their change time, day and request, from the listing (no content is read)."""
    if not store.path_exists(spark, root):
        return spark.createDataFrame([], FILE)
    if col == "flight_date":
        return requests.landed_files(spark, root).withColumnRenamed(col, "day").select(*FILE_COLUMNS)
    listed = spark.read.format("binaryFile").load(root)
    day = F.col(col).cast("date") if col in listed.columns else F.lit(None).cast("date")
    none = F.lit(None).cast("string")
    return listed.select("_metadata.file_path", "_metadata.file_modification_time", day.alias("day"), none.alias("airport_icao"), none.alias("half"))


FILE_COLUMNS = [f.split(" ")[0] for f in FILE.split(", ")]


def _on_days(df: DataFrame, col: str, days: list[dt.date] | None) -> DataFrame:
    return df if days is None else df.where(F.col(col).isin(days))


def load(spark: SparkSession, layout: Layout, batch_id: int, batch_ts: dt.datetime,
         days: list[dt.date] | None = None, max_bad_share: float = payload.MAX_BAD_SHARE) -> list[dt.date]:
    """Step 1. Returns the touched days (bounded by the calendar). Without ``days``, files that no published
    batch holds (by name and change time) are loaded; ``days`` reloads all files of those days. The files of a
    batch are published with its rows. A feed with nothing landed loads as empty; the other still loads. The parsed lines go at
    the end, before anything is staged."""
    with scratch_scope(spark), shuffles_freed(spark):
        return _load(spark, layout, batch_id, batch_ts, days, max_bad_share)


def _load(spark: SparkSession, layout: Layout, batch_id: int, batch_ts: dt.datetime, days: list[dt.date] | None, max_bad_share: float) -> list[dt.date]:
    feeds = {"schedules": (layout.schedules, "flight_date"), "flights": (layout.flights, "record_date")}
    listed = [landed_files(spark, root, col).withColumn("feed", F.lit(name)) for name, (root, col) in feeds.items()]
    new = listed[0].unionByName(listed[1])
    if days is None:
        done = store.read_committed(spark, layout.raw, "files", RAW_SCHEMAS["files"])
        new = new.join(done, ["file_path", "file_modification_time"], "left_anti")
    else:
        new = new.where(F.col("day").isin(days))
    new = materialize(new, "new-files")  # fixed, so that a file landing meanwhile is taken by the next load
    found = {name: [r[0] for r in new.where(F.col("feed") == name).select("day").distinct().collect()] for name in feeds}
    if not any(found.values()):
        return []

    def lines(name: str, read, empty: T.StructType) -> DataFrame:
        """The feed's new lines, parsed once and written; too many malformed ones fail here."""
        root, col = feeds[name]
        full = payload.with_fields(empty, [(payload.BAD_LINE, schemas.S), ("file_path", schemas.S)])
        if not found[name]:
            return spark.createDataFrame([], full)
        known = [d for d in found[name] if d is not None]
        on_days = F.col(col).isin(known) | (F.col(col).isNull() if None in found[name] else F.lit(False))
        files = store.bounded(new.where(F.col("feed") == name).select("file_path"))
        some, seen = payload.counted_lines(read(spark, root).where(on_days).join(files, "file_path", "left_semi").select(*full.fieldNames()), name)
        some = materialize(some, f"lines-{name}")
        payload.fail_above(name, seen.get["n"], seen.get["bad"], max_bad_share)
        return some

    schedule = lines("schedules", payload.schedule_lines, payload.with_fields(schemas.SCHEDULE_PAYLOAD, payload.REQUEST_COLUMNS))
    observed = lines("flights", payload.flight_lines, payload.with_fields(schemas.OBSERVED_FLIGHT, [("record_date", schemas.D)]))
    fl = payload.good(observed)
    tables = {"departures": payload.departures_from_payloads(payload.good(schedule)).drop("half"),
              "arrivals": payload.arrivals_from_payloads(payload.good(schedule)).drop("half"),
              "flights": fl.withColumn("seen_day", staging.raw_seen_day(fl)), "files": new,
              "responses": requests.responses(new.where("feed = 'schedules'").withColumnRenamed("day", "flight_date"), schedule),
              "quarantine": payload.quarantine(schedule, "schedules").unionByName(payload.quarantine(observed, "flights"))}
    if not store.write_batch(tables, layout.raw, batch_id, batch_ts, sources=dict.fromkeys(("flights", *PLAIN)),
                             partition_cols={"flights": "seen_day"} | dict.fromkeys(PLAIN), schemas=RAW_SCHEMAS):
        raise ValueError(f"batch {batch_id} is published already; load new files under a new id")
    return sorted({d for ds in found.values() for d in ds if d is not None})


RAW_SCHEMAS = {
    "departures": schemas.RAW_DEPARTURES, "arrivals": schemas.RAW_ARRIVALS,
    "flights": payload.with_fields(schemas.RAW_FLIGHTS, [("seen_day", schemas.D)]),
    "files": T.StructType([T.StructField("file_path", T.StringType(), True),
                           T.StructField("file_modification_time", T.TimestampType(), True),
                           T.StructField("day", T.DateType(), True), T.StructField("airport_icao", T.StringType(), True),
                           T.StructField("half", T.StringType(), True), T.StructField("feed", T.StringType(), True)]),
    "responses": requests.RESPONSES, "quarantine": payload.QUARANTINE,
}
#: Tables of a batch without a feed name and day folders.
PLAIN = ("files", "responses", "quarantine")
#: Manifest of the batches whose days are staged and checked.
STAGED = "_staged"


def pending(spark: SparkSession, layout: Layout) -> tuple[list[int], list[dt.date]]:
    """Published batches that are not staged yet (a run that failed after its load leaves one), and their days."""
    done = store.manifest(spark, layout.raw, STAGED)
    ids = store.manifest(spark, layout.raw).join(done, "batch_id", "left_anti").select("batch_id")
    files = store.read_committed(spark, layout.raw, "files", RAW_SCHEMAS["files"]).join(store.bounded(ids), "batch_id", "left_semi")
    batches = sorted(r[0] for r in ids.collect())
    return batches, sorted(r[0] for r in files.where("day is not null").select("day").distinct().collect())


def _committed(spark: SparkSession, layout: Layout, name: str, day_col: str, days: list[dt.date]) -> DataFrame:
    raw = store.read_committed(spark, layout.raw, name, RAW_SCHEMAS[name])
    return raw.where(F.col(day_col).isin(days)).drop("batch_id")


def seen_days(spark: SparkSession, layout: Layout, days: list[dt.date], batches: list[int] | None) -> list[dt.date]:
    """First-seen days of the flights of ``batches`` (only their folders are read), or else of record days ``days``."""
    raw = store.read_committed(spark, layout.raw, "flights", RAW_SCHEMAS["flights"])
    raw = raw.where(F.col("record_date").isin(days) if batches is None else F.col("batch_id").isin(batches))
    return sorted(r[0] for r in raw.select(staging.known_day("seen_day")).distinct().collect())


#: Day column of the staging tables; the airport dimension has none.
DAY_COLUMN = {"stg_flights": "seen_day", "stg_airports": None}


#: Curated table (D4, D6): hourly sums of both directions, kept by day; ``kpi.efficiency_levels`` rolls them up.
EFFICIENCY = "kpi_efficiency_hourly"


def read_staged(spark: SparkSession, layout: Layout, model: str, days: list[dt.date] | None = None) -> DataFrame:
    """A staging table (its days) in the current snapshot."""
    return _on_days(store.read_snapshot(spark, layout.staging_root, model, DAY_COLUMN.get(model, "flight_date")), "flight_date", days)


def stage(spark: SparkSession, layout: Layout, days: list[dt.date], airports_csv: str | None = None,
          loaded_at: dt.datetime | None = None, batches: list[int] | None = None) -> dict[str, DataFrame]:
    """Step 2. Rebuild the staging tables of ``days`` and switch to them; returns the rebuilt rows of each table.

    A flight can be returned on several record days, so ``stg_flights`` is kept by first-seen day
    (``seen_day``): all records of one flight share it, and the touched first-seen days are rebuilt whole.
    """
    root = layout.staging_root
    version = store.next_version(spark, root)
    written: dict[str, tuple[DataFrame, str | None, list]] = {}

    def put(name: str, df: DataFrame, on: list[dt.date] = days) -> DataFrame:
        col = DAY_COLUMN.get(name, "flight_date")
        written[name] = store.write_version(df, root, name, version, col), col, on
        return written[name][0]

    for base_name, base_fn, raw_name, derived in (
            ("stg_departures_base", staging.departures_base, "departures", DEPARTURE_MODELS),
            ("stg_arrivals_base", staging.arrivals_base, "arrivals", ARRIVAL_MODELS)):
        base = put(base_name, base_fn(_committed(spark, layout, raw_name, "flight_date", days)))
        for name, fn in derived.items():
            put(name, fn(base))
    seen = seen_days(spark, layout, days, batches)
    raw = store.read_committed(spark, layout.raw, "flights", RAW_SCHEMAS["flights"])
    observed = staging.flights(raw.where(staging.known_day("seen_day").isin(seen)).drop("batch_id"))
    put("stg_flights", observed.withColumn("seen_day", staging.seen_day("first_seen_ts")), seen)
    if airports_csv:
        put("stg_airports", staging.airports(payload.read_airports_csv(spark, airports_csv), loaded_at=loaded_at))
    rows = {name: df for name, (df, _, _) in written.items()}
    put(EFFICIENCY, kpi.efficiency_partials(kpi.scheduled_flights(
        rows["stg_departures_operator"], rows["stg_departures_not_departed"], rows["stg_arrivals_operator"], rows["stg_arrivals_not_arrived"])))
    store.publish_snapshot(spark, root, version, written)
    return {name: rows for name, (rows, _, _) in written.items()}


def check(spark: SparkSession, layout: Layout, models: dict[str, DataFrame], batch_id: int) -> DataFrame:
    """Step 3. Checks of the rebuilt rows, appended to the results table; returns the results. Every declared key holds the
    day its table is kept by (a flight's first-seen day follows from its key), so the rebuilt days are all the rows that
    could repeat one of their keys: nothing is missed in days that are not read."""
    results = checks.run_all({m: df for m, df in models.items() if m in checks.CHECKS}).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    path = f"{layout.checks}/batch_id={batch_id}"
    results.drop("batch_id").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(results.schema).parquet(layout.checks).where(F.col("batch_id") == batch_id)


def compact_raw(spark: SparkSession, layout: Layout, new_id: int, batch_ts: dt.datetime, target: int = store.COMPACT_BYTES) -> dict[int, list[int]]:
    """Merge small staged batches of the raw tables (``store.compact``); the merged ones count as staged. Ids from ``new_id`` on
    must be unused. The replaced folders can go with ``store.drop_replaced`` when no reader holds them."""
    staged = [r[0] for r in store.manifest(spark, layout.raw, STAGED).select("batch_id").collect()]  # a row for each batch
    day_cols = {"flights": "seen_day"} | dict.fromkeys(PLAIN)
    return store.compact(spark, layout.raw, RAW_SCHEMAS, day_cols, new_id, batch_ts, target, only=staged, also=(STAGED,))


def cover(spark: SparkSession, layout: Layout, airports: DataFrame, days: list[dt.date], batch_id: int) -> DataFrame:
    """Step 4. Coverage of the requests of ``days`` (all halves of all ``airports``, column ``icao``) by the published
    responses, written for this run; of a file loaded again the last load counts."""
    loaded = store.read_committed(spark, layout.raw, "responses", RAW_SCHEMAS["responses"]).where(F.col("flight_date").isin(days))
    last = loaded.groupBy("file_path").agg(F.max_by(F.struct(*[c for c in RAW_SCHEMAS["responses"].fieldNames()]), "batch_id").alias("r"))
    plan = requests.request_plan(airports, min(days), max(days)).where(F.col("flight_date").isin(days))
    out = requests.request_coverage(plan, last.select("r.*"))
    path = f"{layout.coverage}/batch_id={batch_id}"
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def load_airports(spark: SparkSession, airports_csv: str) -> DataFrame:
    """Airports of the load countries, whose requests the daily load makes."""
    listed = payload.read_airports_csv(spark, airports_csv).where(predicates.country_in())
    return listed.select(F.upper("icao").alias("icao")).where("icao is not null").distinct()


#: Key of the observed flights (fixed value: the declared primary key); its rows' day, ``seen_day``, follows from it.
FLIGHT_KEY = ["icao24", "firstSeen"]


def repeated_keys(spark: SparkSession, layout: Layout, batches: list[int]) -> DataFrame:
    """Q2, Q5 over the history: keys of raw flights in ``batches`` that are in more than one raw row, in whichever published
    batch: ``n_rows``, the first and the last batch, and how many of the rows are new.

    A key's day folder follows from the key, so only the folders of the days in ``batches`` are read, in every batch; the count
    is one aggregation with partial sums, so a key repeated by every load sends a row from each map task.
    """
    raw = store.read_committed(spark, layout.raw, "flights", RAW_SCHEMAS["flights"])
    rows = raw.where(F.col("seen_day").isin(seen_days(spark, layout, [], batches)))
    counted = rows.groupBy(*FLIGHT_KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("batch_id").isin(batches)).alias("n_new"),
        F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"))
    return counted.where("n_rows > 1 AND n_new > 0")


def run_days(spark: SparkSession, layout: Layout, batch_id: int, batch_ts: dt.datetime,
             days: list[dt.date] | None = None, airports_csv: str | None = None) -> DataFrame:
    """Load, stage and check; returns the check results of this run (empty when nothing landed). Its scratch tables go at the end, the
    shuffle files of each step with the step."""
    with scratch_scope(spark), shuffles_freed(spark):
        return _run_days(spark, layout, batch_id, batch_ts, days, airports_csv)


def _run_days(spark: SparkSession, layout: Layout, batch_id: int, batch_ts: dt.datetime,
              days: list[dt.date] | None, airports_csv: str | None) -> DataFrame:
    load(spark, layout, batch_id, batch_ts, days)
    batches, touched = pending(spark, layout)
    if not batches:
        return spark.createDataFrame([], "model string, check_name string, failures bigint, passed boolean, "
                                         "batch_id bigint")
    models = stage(spark, layout, touched, airports_csv, loaded_at=batch_ts, batches=batches)
    results = check(spark, layout, models, batch_id)
    path = f"{layout.repeated}/batch_id={batch_id}"
    repeated_keys(spark, layout, batches).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    if airports_csv and touched:
        cover(spark, layout, load_airports(spark, airports_csv), touched, batch_id)
    for b in batches:
        store.publish(spark, layout.raw, b, batch_ts, STAGED)
    return results
