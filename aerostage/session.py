"""Session helpers: time zone, shared scratch folder, shuffle files."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "aerostage", shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass the cluster's own builder instead."""
    builder = SparkSession.builder.appName(app)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Broadcast only from measured sizes: no static estimate-based broadcast; AQE converts a join
        # once a shuffled side is materialised and known to be small. Explicit broadcast hints are kept
        # for tables with a proven bound (per-partition counts, touched days).
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 << 20))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what the staging plans rely on: event times are read as UTC wall clocks."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only when the session names none (a local test run) is a private folder created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="aerostage-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder for one materialised table."""
    path = f"{shared_dir(spark)}/aerostage/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables made inside are deleted at the end, also after an error. What leaves the scope must not read them:
    a job that publishes its results elsewhere runs in one; a query that returns a lazy DataFrame does not. For one driver thread."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


#: Spark's switch (4.1) for deleting the shuffle files of a job when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Each job planned inside deletes its shuffle files as it ends; else they stay until the driver happens to collect its garbage,
    and those of many jobs lie on the disk together. For jobs that write their result; a DataFrame that is run twice shuffles twice."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file checks in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "prepare", "shared_dir", "scratch_path", "scratch_scope", "shuffles_freed", "local_path"]


def materialize(df, label: str):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used when one model feeds several consumers (checks, KPI unions): they then share one columnar
    table (column pruning still applies) instead of each recomputing the scan and shuffles, and the
    lineage is cut, so a lost executor does not trigger a recompute of the whole upstream plan.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tasks of one stage at most: the blocks of a shuffle are map tasks times reduce tasks.
MAX_TASKS = 50_000


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that size shuffles and scans for an input of ``input_bytes`` on ``total_cores`` cores.

    Tasks get about ``target_partition_bytes`` of input (the staging plans shuffle roughly their input size once per
    window), never fewer tasks than twice the cores and never more than MAX_TASKS: beyond that tasks grow, as a shuffle's
    blocks grow with the square of their number. AQE then coalesces small partitions and splits skewed ones at
    run time. For 100 TB on 1,000 executors x 8 cores: 50,000 partitions and scan splits of 2 GB.
    """
    target_partition_bytes = max(target_partition_bytes, -(-input_bytes // MAX_TASKS))
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 256 << 20)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    }


def apply_settings(spark, settings: dict[str, str]) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)
