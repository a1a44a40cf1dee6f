"""Hot groups are reduced before they are shuffled (measured with the exchange's record metrics)."""

from pyspark.sql import functions as F

from aerostage.plans import staging
from aerostage.plans.catalog import raw

from conftest import SF_SMALL


def _exchanges(node, out):
    name = node.nodeName()
    if name in ("Exchange", "ShuffleExchange"):
        out.append(node)
    children = node.children()
    for i in range(children.size()):
        _exchanges(children.apply(i), out)
    return out


def _records_written(node) -> int:
    m = node.metrics()
    return int(m.apply("shuffleRecordsWritten").value())


def test_hot_copy_group_is_collapsed_map_side(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = raw(spark, SF_SMALL, "raw_departures")
        one = r.where(F.col("row_id") == 2)  # a departed operator row that passes every filter
        copies = one.select(*[F.col(c) for c in r.columns if c != "ingestion_timestamp"],
                            F.col("ingestion_timestamp")).join(spark.range(20000).withColumnRenamed("id", "copy"),
                                                               how="cross")
        copies = copies.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 SECOND")
                                   * (F.col("copy") % 7)).drop("copy")
        data = r.unionByName(copies).repartition(6)
        df = staging.departures_operator(staging.departures_base(data))
        rows = df.collect()
        assert len(rows) > 0
        exchanges = _exchanges(df._jdf.queryExecution().executedPlan(), [])
        written = sorted(_records_written(e) for e in exchanges)
        # the input repartition ships everything; the first dedup shuffle must not ship the copies:
        # at most one row per identity per map task (6 map tasks) reaches it
        assert written[-1] >= 20000, written
        dedup_first = [w for w in written if w < written[-1]]
        assert dedup_first and max(dedup_first) <= 1000 + 6, written
        print("records written per exchange:", written)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_unidentified_flights_of_one_airport_day_spread_over_tasks(spark):
    """A day's flights without callsign and mode-S at one airport share every coarse key; the
    flight-level dedup must still spread them (its shuffle keys include the flight number)."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = raw(spark, SF_SMALL, "raw_departures")
        hot = (spark.range(4000).select(F.col("id").alias("k"))
               .join(r.where(F.col("row_id") == 2), how="cross")
               .withColumn("row_id", F.col("k") + 10 ** 6)
               .withColumn("number", F.concat(F.lit("HX "), F.col("k").cast("string")))
               .withColumn("callSign", F.lit(None).cast("string"))
               .withColumn("aircraft_modeS", F.lit(None).cast("string"))
               .drop("k"))
        base = staging.departures_base(r.unionByName(hot))
        hot_rows = base.where(F.col("flight_number").startswith("HX "))
        spread = hot_rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(x["count"] for x in spread) == 4000
        assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # every task gets a share
        assert max(x["count"] for x in spread) < 4000 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
