"""Small helpers shared by the operators: shared folder, held-out rule, key spreading."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostage.session import scratch_path

#: Row limit up to which a one-column key list may be broadcast (about 16 bytes a row).
BROADCAST_ROWS = 1_000_000
#: Bytes of rows in one Arrow batch for a Python worker (one row at least); the JVM and the worker hold a few of them.
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet in the shared folder (``spark.checkpoint.dir``) and read back: lineage is cut
    and a lost executor costs no recomputation of what was written."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id is in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def semi_join(df: DataFrame, keys: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Keep the rows of ``df`` whose key is in ``keys`` (``rows`` of them, counted by the caller): broadcast
    while the list is under BROADCAST_ROWS, a shuffle join beyond."""
    return df.join(F.broadcast(keys) if rows <= BROADCAST_ROWS else keys, on, "left_semi")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send the library to the executors as a zip through Spark's own file server, once for each context,
    so that the Arrow functions of this package can be imported there without an installation. Arrow batches of
    the session are bounded by BATCH_BYTES, on both sides of the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="aerostage-zip-"), "aerostage_lib.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()
