"""Global dense numbering ``ROW_NUMBER() OVER (ORDER BY ...)`` without a one-task window.

A window with no partition runs in a single task. Instead the rows are range-partitioned on the
order (tie-break included, so even one hot value spreads over partitions), sorted inside each
partition and numbered locally; a per-partition count table - one row per partition, so its size is
bounded by the partition count and safe to broadcast - gives each partition its offset.

The ranged rows are checkpointed into the shared checkpoint folder first, so the counts and the rows
see the same partitioning even if an executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostage.operators.dedup import _order

_PART, _MONO, _BASE, _OFFSET, _COUNT = "__part", "__mono", "__base", "__offset", "__count"


def global_row_number(df: DataFrame, order, name: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the total order ``order`` (include a unique tie-break)."""
    spark = df.sparkSession
    from aerostage.session import shared_dir

    shared_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = _order(order)
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_MONO, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_COUNT), F.min(_MONO).alias(_BASE))
    offsets = counts.select(
        _PART,
        _BASE,
        F.coalesce(
            F.sum(_COUNT).over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias(_OFFSET),
    )
    numbered = ranged.join(F.broadcast(offsets), _PART)
    return numbered.withColumn(name, (F.col(_OFFSET) + F.col(_MONO) - F.col(_BASE) + 1).cast("bigint")).drop(
        _PART, _MONO, _BASE, _OFFSET
    )
