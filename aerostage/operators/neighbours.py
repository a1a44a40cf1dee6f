"""The last and the next offer of every asking row in key and time order, with no limit on the rows of one key.

A window over a key sorts all of that key's rows in one task. Here the rows are range-partitioned on (keys, time, tie-break), so
a hot key, and even one hot second of it, spreads over many ranges. Each range is searched by itself; the offer that lies
just before and just after a range is carried into it from one row for each range. Nothing is joined and no pair is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostage.session import materialize

_PART, _ASKS, _TIE = "__part", "__asks", "__tie"


def in_ranges(rows: DataFrame, keys: list[str], at: str, offer: str, tie: Column, num_partitions: int | None = None) -> DataFrame:
    """``rows`` in ranges of (keys, at), numbered in order, as a written table: both readers see the same ranges, also
    after a lost executor. At one time offers come before asking rows."""
    n = num_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn(_ASKS, F.col(offer).isNull()).withColumn(_TIE, tie)
    ranged = rows.repartitionByRange(n, *keys, at, _ASKS, _TIE).withColumn(_PART, F.spark_partition_id())
    return materialize(ranged, "ranges")


def carried_offers(ranged: DataFrame, keys: list[str], at: str, offer: str) -> DataFrame:
    """For each range the offer just before it and just after it, where that has the key the range begins or ends with.

    The window without a partition sorts one row for each range, whatever the number of rows."""
    key = lambda c: F.struct(*[F.col(f"{c}.{k}").alias(k) for k in keys])
    placed = F.when(~F.col(_ASKS), F.struct(*keys, at, offer))
    own = F.struct(*keys)
    ends = ranged.groupBy(_PART).agg(F.min(own).alias("low"), F.max(own).alias("high"), F.min(placed).alias("first"), F.max(placed).alias("last"))

    def nearest(c: str, order: Column) -> Column:
        return F.last(c, ignorenulls=True).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))

    ends = ends.withColumn("before", nearest("last", F.asc(_PART))).withColumn("after", nearest("first", F.desc(_PART)))
    both = F.array(F.when(key("before") == F.col("low"), F.col("before")), F.when(key("after") == F.col("high"), F.col("after")))
    return ends.select(_PART, F.explode(both).alias("o")).where("o is not null").select("o.*", _PART, F.lit(False).alias(_ASKS))


def with_neighbours(rows: DataFrame, keys: list[str], at: str, offer: str, tie: Column, num_partitions: int | None = None) -> DataFrame:
    """The asking rows (null ``offer``) with ``before``, the last offer of their key at or before their time, and ``after``,
    the next one from their time on, if not given by ``before``. Keys and ``at`` must not be null; a key has one offer at a time at most; ``tie`` spreads
    rows of one key and time."""
    ranged = in_ranges(rows, keys, at, offer, tie, num_partitions)
    both = ranged.unionByName(carried_offers(ranged, keys, at, offer), allowMissingColumns=True)
    span = Window.partitionBy(*keys, _PART)
    near = {name: F.last(offer, ignorenulls=True).over(span.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
            for name, order in (("before", (F.asc(at), F.asc(_ASKS))), ("after", (F.desc(at), F.asc(_ASKS))))}
    return both.withColumns(near).where(F.col(_ASKS)).drop(offer, _PART, _ASKS, _TIE)
