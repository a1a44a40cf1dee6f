"""Raw-table loads, curated refreshes and model publication.

* ``append_raw``: typed append with one batch timestamp and the feed name (K1-K4). The first append
  creates the table; an empty batch writes nothing.
* ``write_batch`` / ``read_committed``: the schedule load writes departures *and* arrivals or neither
  (K5). Plain Parquet has no multi-table transaction, so a batch has its own ``batch_id=`` folder in each
  table and becomes visible only when its id is in the manifest, after all writes succeeded. A batch that
  crashed is never read; retried under its id it replaces its own folders; a published one is not written again.
* ``refresh_partitions``: recompute only the ``flight_date`` partitions a new load touched, with
  dynamic partition overwrite (D5). Every staging window's keys contain ``flight_date``, so a per-day
  recompute is exact; the touched-day semi-join lets dynamic partition pruning skip the rest.
* ``write_version`` / ``publish_snapshot`` / ``read_snapshot``: the staging tables as one snapshot. A run writes the days it
  rebuilt to folders of its own version; one manifest file then names, for every table and day, the version that
  holds it. Readers see the old set of all tables or the new one, whatever write a run crashed at.
* ``compact``: merges small published batches into one, which replaces them with a single manifest entry.
* ``publish_views`` / ``write_models`` / ``from_legacy``: models as session views or target tables, and
  legacy-named raw tables in the current layout (K6-K8, D6).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostage.schemas import LEGACY_FLIGHTS, SCHEDULE_SOURCE_NAME
from aerostage.session import materialize

MANIFEST = "_batches"
MANIFEST_SCHEMA = T.StructType([T.StructField("committed_at", T.TimestampNTZType(), True), T.StructField("batch_id", T.LongType(), True)])
#: Rows (16 bytes each) up to which a list of ids or file names may be broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Extra (lineage) columns first, then the columns of ``schema`` in order and type (missing ones null).
    Names match without regard to case, as Spark resolves them."""
    have = {c.lower(): c for c in df.columns}
    known = {f.name.lower() for f in schema.fields}
    cols = [(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c.lower() not in known] if keep_extra else []
    return df.select(*extra, *cols)


def with_load_defaults(df: DataFrame, batch_ts: dt.datetime, source: str | None = SCHEDULE_SOURCE_NAME) -> DataFrame:
    """K3: one batch timestamp for every row (not a per-row clock), and the feed name."""
    out = df.withColumn("ingestion_timestamp", F.lit(batch_ts).cast("timestamp_ntz"))
    return out.withColumn("data_source", F.lit(source)) if source is not None else out


def append_raw(df: DataFrame, path: str, schema: T.StructType, batch_ts: dt.datetime,
               source: str | None = SCHEDULE_SOURCE_NAME, partition_col: str = "flight_date") -> bool:
    """K1-K4: append a typed batch, partitioned by day. Returns False (and writes nothing) when empty."""
    if df.isEmpty():
        return False
    out = conform(with_load_defaults(df, batch_ts, source), schema)
    out.write.mode("append").partitionBy(partition_col).parquet(path)
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def bounded(keys: DataFrame) -> DataFrame:
    """``keys`` with a broadcast hint if they are few enough (counted), else as they are."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def manifest(spark: SparkSession, root: str, name: str = MANIFEST) -> DataFrame:
    """Published batch ids and their times, without those that a published merge has replaced; none where nothing
    was published yet."""
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    full = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("replaces", T.ArrayType(T.LongType()), True)])
    found = spark.read.schema(full).parquet(path)
    gone = bounded(found.select(F.explode("replaces").alias("batch_id")))
    return found.select(*MANIFEST_SCHEMA.fieldNames()).join(gone, "batch_id", "left_anti").select(*MANIFEST_SCHEMA.fieldNames())


def publish(spark: SparkSession, root: str, batch_id: int, batch_ts: dt.datetime, name: str = MANIFEST, replaces: list[int] | None = None) -> None:
    """Enter a batch in a manifest; entering it again replaces the entry. ``replaces``: batches whose rows it holds."""
    old = F.array(*[F.lit(b).cast("bigint") for b in replaces]) if replaces else F.lit(None).cast("array<bigint>")
    entry = spark.range(1, numPartitions=1).select(F.lit(batch_ts).cast("timestamp_ntz").alias("committed_at"), old.alias("replaces"))
    entry.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}/batch_id={batch_id}")


def write_batch(tables: dict[str, DataFrame], root: str, batch_id: int, batch_ts: dt.datetime,
                publish_it: bool = True, sources: dict[str, str | None] | None = None,
                partition_cols: dict[str, str | None] | None = None,
                schemas: dict[str, T.StructType] | None = None) -> bool:
    """K5: write every table of one load to its ``batch_id=`` folder; publish the id last. Returns False, and
    writes nothing, if the id is published already.

    A table without rows is skipped (K4); it may not exist after its first batch, so read it with its schema.
    ``sources`` gives a table's feed name (``None``: the table has no ``data_source`` column);
    ``partition_cols`` its day column (default ``flight_date``; ``None``: not partitioned); ``schemas`` its
    typed layout. Writers that share a root must use different ids.
    """
    spark = next(iter(tables.values())).sparkSession
    if not manifest(spark, root).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    sources, partition_cols, schemas = sources or {}, partition_cols or {}, schemas or {}
    for name, df in tables.items():
        if df.isEmpty():  # K4: an empty feed makes no table; a crashed attempt under this id may have left files
            delete(spark, f"{root}/{name}/batch_id={batch_id}")
            continue
        rows = with_load_defaults(df, batch_ts, sources.get(name, SCHEDULE_SOURCE_NAME))
        rows = conform(rows, schemas[name]) if name in schemas else rows
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        day = partition_cols.get(name, "flight_date")
        (writer.partitionBy(day) if day else writer).parquet(f"{root}/{name}/batch_id={batch_id}")
    if publish_it:
        publish(spark, root, batch_id, batch_ts)
    return True


def read_committed(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of published batches only, chosen by folder (``batch_id`` is a partition value, so rows are not
    shuffled on it). Pass the table's schema (without ``batch_id``) when a load may have written no row, so
    nothing has to be inferred from files."""
    ids = bounded(manifest(spark, root).select("batch_id"))
    if schema is None:
        found = spark.read.parquet(f"{root}/{name}").withColumn("batch_id", F.col("batch_id").cast("bigint"))
        return found.join(ids, "batch_id", "left_semi")
    full = T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType(), True)])
    if not path_exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{root}/{name}").join(ids, "batch_id", "left_semi")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (Hadoop FileSystem API)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_days(df: DataFrame, path: str, days: list, partition_col: str = "flight_date") -> None:
    """Replace ``days`` of a day-partitioned table by the rows of ``df`` as a set: a day without rows is emptied.

    The rows are written once to the shared folder, then over the table's days that they hold; folders of
    days that came out empty are removed only after that write has succeeded. ``days`` is bounded by the calendar.
    """
    spark = df.sparkSession
    new = materialize(df, "replace-days")
    present = {r[0] for r in new.select(partition_col).distinct().collect()}
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    for day in days:
        if day is not None and day not in present:
            delete(spark, f"{path}/{partition_col}={day}")


def refresh_partitions(spark: SparkSession, raw_path: str, curated_path: str,
                       model: Callable[[DataFrame], DataFrame], touched: DataFrame,
                       raw_schema: T.StructType | None = None, partition_col: str = "flight_date") -> None:
    """Recompute ``model`` for the days in ``touched`` and overwrite just those partitions."""
    # The touched days are bounded by the calendar, not by the data: broadcasting them is safe and lets
    # dynamic partition pruning skip every untouched day of the raw table.
    days = F.broadcast(touched.select(partition_col).distinct())
    raw = read_table(spark, raw_path, raw_schema).join(days, partition_col, "left_semi")
    listed = [r[0] for r in touched.select(partition_col).distinct().collect()]
    replace_days(model(raw), curated_path, listed, partition_col)


# ---- snapshots of the staging tables ---------------------------------------------------------------
SNAPSHOTS = "_snapshots"
SNAPSHOT = T.StructType([T.StructField("model", T.StringType(), True), T.StructField("day", T.DateType(), True),
                         T.StructField("version", T.LongType(), True), T.StructField("schema", T.StringType(), True)])


def write_version(df: DataFrame, root: str, model: str, version: int, day_col: str | None) -> DataFrame:
    """Write the rows of a run to the version's own folder of ``model`` (a retried run replaces it); returns them, read back.
    Nothing that a reader sees changes."""
    path = f"{root}/{model}/version={version}"
    rows = df.hint("rebalance", day_col) if day_col else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(day_col) if day_col else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The current snapshot: for each table a row without a day, with its schema, and one for each day that it holds."""
    path = f"{root}/{SNAPSHOTS}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SNAPSHOT)
    every = spark.read.schema(T.StructType([*SNAPSHOT.fields, T.StructField("id", T.LongType(), True)])).parquet(path)
    last = every.agg(F.max("id")).first()[0]
    return every.where(F.col("id") == F.lit(last)).drop("id")


def publish_snapshot(spark: SparkSession, root: str, version: int, written: dict[str, tuple[DataFrame, str | None, list]]) -> None:
    """Switch to ``version``. ``written``: for each rebuilt table its rows, its day column and the days they stand for; a day
    without rows is then held by no version, a table without a day column is replaced whole. Tables and days
    that were not rebuilt keep their versions. The manifest is one file: it is there or it is not."""
    new = snapshot(spark, root)
    at = F.lit(version).cast("bigint").alias("version")
    for model, (rows, day_col, days) in written.items():
        untouched = F.col("day").isNotNull() & ~F.col("day").isin(list(days)) if day_col else F.lit(False)
        new = new.where((F.col("model") != model) | untouched)
        head = spark.range(1, numPartitions=1).select(F.lit(model).alias("model"), F.lit(None).cast("date").alias("day"), at, F.lit(rows.schema.json()).alias("schema"))
        new = new.unionByName(head)
        if day_col:
            held = rows.select(F.col(day_col).cast("date").alias("day")).distinct()
            new = new.unionByName(held.select(F.lit(model).alias("model"), "day", at, F.lit(None).cast("string").alias("schema")))
    path = f"{root}/{SNAPSHOTS}/id={version}"
    new.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def next_version(spark: SparkSession, root: str) -> int:
    """The version after the current snapshot; a run that crashed before its switch gets the same one again."""
    path = f"{root}/{SNAPSHOTS}"
    if not path_exists(spark, path):
        return 1
    every = spark.read.schema(T.StructType([*SNAPSHOT.fields, T.StructField("id", T.LongType(), True)])).parquet(path)
    return (every.agg(F.max("id")).first()[0] or 0) + 1


def read_snapshot(spark: SparkSession, root: str, model: str, day_col: str | None) -> DataFrame:
    """The current rows of a table. The version and day of every row are folder names, so the join with the snapshot's few
    rows only chooses folders; the schema is the one the snapshot names, so a table may hold no file."""
    held = snapshot(spark, root).where(F.col("model") == model)
    head = held.where("schema is not null").first()
    if head is None:
        raise ValueError(f"{model} is in no snapshot under {root}")
    schema = T.StructType.fromJson(json.loads(head["schema"]))
    if not path_exists(spark, f"{root}/{model}"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.LongType(), True)])).parquet(f"{root}/{model}")
    keys = held.where("day is not null").select("version", F.col("day").alias(day_col)) if day_col else held.select("version")
    keys = bounded(keys)
    return rows.join(keys, keys.columns, "left_semi").select(*schema.fieldNames())


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[tuple[str, int]]:
    """Delete the version folders that none of the last ``keep`` snapshots names (readers of older ones are gone), and the older
    manifests; returns them. The names come from the manifests, a row for each table and version."""
    path = f"{root}/{SNAPSHOTS}"
    every = spark.read.schema(T.StructType([*SNAPSHOT.fields, T.StructField("id", T.LongType(), True)])).parquet(path)
    pairs = every.select("id", "model", "version").distinct().collect()
    ids = sorted({r["id"] for r in pairs})[-keep:]
    live = {(r["model"], r["version"]) for r in pairs if r["id"] in ids}
    gone = sorted({(r["model"], r["version"]) for r in pairs} - live)
    for model, version in gone:
        delete(spark, f"{root}/{model}/version={version}")
    for old in sorted({r["id"] for r in pairs} - set(ids)):
        delete(spark, f"{path}/id={old}")
    return gone


# ---- compaction of raw batches ---------------------------------------------------------------------
#: Batches below so many bytes are merged, into ones of about this size.
COMPACT_BYTES = 128 << 20


def batch_bytes(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """(batch_id, bytes, files) of the published batches, from the file listing."""
    ids = manifest(spark, root).select("batch_id")
    found = [t for t in tables if path_exists(spark, f"{root}/{t}")]
    if not found:
        return spark.createDataFrame([], "batch_id bigint, bytes bigint, files bigint")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load([f"{root}/{t}" for t in found])
    batch = F.regexp_extract("path", "/batch_id=([0-9]+)/", 1).try_cast("bigint")
    return listed.select(batch.alias("batch_id"), "length").join(bounded(ids), "batch_id", "left_semi").groupBy("batch_id").agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def plan_merges(sizes: list[tuple[int, int]], target: int = COMPACT_BYTES) -> list[list[int]]:
    """Neighbouring small batches (id, bytes) in groups of about ``target`` bytes, two to a group at least."""
    groups, own, total = [], [], 0
    for batch, size in sorted(sizes):
        if size >= target or (own and total + size > target):
            groups.append(own)
            own, total = [], 0
        if size < target:
            own.append(batch)
            total += size
    return [g for g in [*groups, own] if len(g) > 1]


def compact(spark: SparkSession, root: str, schemas: dict[str, T.StructType], day_cols: dict[str, str | None], new_id: int, batch_ts: dt.datetime,
            target: int = COMPACT_BYTES, only: list[int] | None = None, also: tuple[str, ...] = ()) -> dict[int, list[int]]:
    """K2: merge small published batches (of ``only``, if given), each group into one batch with the ids ``new_id``, ``new_id`` + 1, ...

    Rows, their load times and days stay as they are; each day of a merged batch is a few files instead of
    one and more for every batch. A group is switched by one manifest entry that names what it replaces, so a reader
    takes the old batches or the merged one. ``also``: further manifests that list the new ids first (a merge
    of staged batches is staged). Returns new id -> replaced ids; ``drop_replaced`` deletes their files later.
    """
    sizes = batch_bytes(spark, root, list(schemas))
    sizes = sizes.where(F.col("batch_id").isin(only)) if only is not None else sizes
    small = [(r["batch_id"], r["bytes"]) for r in sizes.where(F.col("bytes") < target).collect()]  # a row for each batch
    done: dict[int, list[int]] = {}
    for k, group in enumerate(plan_merges(small, target)):
        batch = new_id + k
        for name, schema in schemas.items():
            rows = read_committed(spark, root, name, schema).where(F.col("batch_id").isin(group)).drop("batch_id")
            path, day = f"{root}/{name}/batch_id={batch}", day_cols.get(name, "flight_date")
            if rows.isEmpty():
                delete(spark, path)
                continue
            rows = rows.hint("rebalance", day) if day else rows.hint("rebalance")
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
            (writer.partitionBy(day) if day else writer).parquet(path)
        for other in also:
            publish(spark, root, batch, batch_ts, other)
        publish(spark, root, batch, batch_ts, replaces=group)
        done[batch] = group
    return done


def drop_replaced(spark: SparkSession, root: str, tables: list[str], merged: dict[int, list[int]]) -> None:
    """Delete the folders of merged batches, once no reader holds them; their manifest entries stay replaced."""
    for group in merged.values():
        for batch in group:
            for name in tables:
                delete(spark, f"{root}/{name}/batch_id={batch}")


# ---- model publication (K6, K7, D6) and legacy tables (K8) ---------------------------------------
# Target schemas of the two deployment targets.
TARGET_SCHEMAS = {"dev": "staging", "prod": "staging_prod"}


def publish_views(spark: SparkSession, models: dict[str, DataFrame]) -> list[str]:
    """K6: staging models as session views, queryable from SQL by their model names."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return list(models)


def write_models(models: dict[str, DataFrame], root: str, target: str = "dev",
                 partition_col: str | None = "flight_date") -> dict[str, str]:
    """K7 + D6: materialise models as Parquet tables under the target's schema folder."""
    out = {}
    for name, df in models.items():
        path = f"{root}/{TARGET_SCHEMAS[target]}/{name}"
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")  # a rebuild replaces all days
        if partition_col and partition_col in df.columns:
            writer = writer.partitionBy(partition_col)
        writer.parquet(path)
        out[name] = path
    return out


# The legacy tables of observed flights by the direction they were requested for.
LEGACY_FLIGHT_TABLES = {"departure": "flight_departures", "arrival": "flight_arrivals"}


def write_legacy_flights(flights: DataFrame, root: str, batch_id: int, batch_ts: dt.datetime) -> bool:
    """K8: observed flights requested by airport and direction (S6) into the two legacy tables, one batch; a direction without
    flights makes no table. The request's airport stays, its day is not a column of these tables."""
    tables = {name: flights.where(F.col("direction") == d).drop("direction", "record_date") for d, name in LEGACY_FLIGHT_TABLES.items()}
    return write_batch(tables, root, batch_id, batch_ts, sources=dict.fromkeys(tables), partition_cols=dict.fromkeys(tables),
                       schemas=dict.fromkeys(tables, LEGACY_FLIGHTS))


# Column names of the legacy schedule tables and their current names.
LEGACY_RENAMES = {"flight_number": "number", "callsign": "callSign", "iscargo": "isCargo"}


def from_legacy(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K8: a legacy-named raw table in the current layout (the legacy tables have no codeshare column)."""
    renamed = df
    for old, new in LEGACY_RENAMES.items():
        if old in df.columns:
            renamed = renamed.withColumnRenamed(old, new)
    return conform(renamed, schema)
