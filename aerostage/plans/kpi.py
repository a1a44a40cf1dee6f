"""Delay and schedule-adherence KPIs on the merged operator records.

The KPIs (D2-D4) are single-shuffle aggregates over the merged records with map-side partial
aggregation (a hot airport-day is reduced in every map task before the exchange); averages are sums
and counts divided at the end. The link to observed flights (D7) is a union of both sides and two ordered
passes over one partitioning, then one aggregation; it has no join.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostage.operators.neighbours import with_neighbours
from aerostage.session import materialize

# Fixed value (ours; the KPI is declared, not defined, upstream): a movement within this many seconds
# of its schedule counts as on time.
ON_TIME_SECONDS = 15 * 60
# Fixed value (ours): an observed flight first seen this far from a departure's time, at most, may be it.
LINK_HOURS = 12
_EPOCH = dt.datetime(1970, 1, 1)


def actual_time(side: str) -> Column:
    """The best actual time: runway, else revised."""
    return F.coalesce(F.col(f"{side}_runway_utc"), F.col(f"{side}_revised_utc"))


def movements(dep_operator: DataFrame, arr_operator: DataFrame) -> DataFrame:
    """One row per operated movement with scheduled and actual time and the delay in seconds."""
    def side(df: DataFrame, s: str) -> DataFrame:
        sched, act = F.col(f"{s}_scheduled_utc"), actual_time(s)
        return df.select(F.lit(s).alias("direction"), "airport_icao", "flight_date", sched.alias("scheduled_utc"),
                         act.alias("actual_utc"), F.timestamp_diff("SECOND", sched, act).alias("delay_seconds"))
    return side(dep_operator, "departure").unionByName(side(arr_operator, "arrival"))


def _delay_aggs(threshold_s: int) -> list[Column]:
    d = F.col("delay_seconds")
    with_actual = F.count(d)
    return [
        F.count(F.lit(1)).alias("flights"),
        with_actual.alias("with_actual"),
        F.sum(d).cast("bigint").alias("total_delay_seconds"),
        F.count_if(d <= threshold_s).alias("on_time"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    n = F.col("with_actual")
    return df.withColumn("avg_delay_minutes", F.when(n > 0, F.col("total_delay_seconds") / n / F.lit(60.0))).withColumn(
        "adherence_pct", F.when(n > 0, F.lit(100.0) * F.col("on_time") / n))


def delay_daily(moves: DataFrame, threshold_s: int = ON_TIME_SECONDS) -> DataFrame:
    """Average delay (minutes) per airport, day and direction."""
    agg = moves.groupBy("airport_icao", "flight_date", "direction").agg(*_delay_aggs(threshold_s))
    return _finish(agg).drop("adherence_pct", "on_time")


def adherence(moves: DataFrame, threshold_s: int = ON_TIME_SECONDS) -> DataFrame:
    """D3: share of movements with an actual time that were within ``threshold_s`` of schedule."""
    agg = moves.groupBy("airport_icao", "flight_date", "direction").agg(*_delay_aggs(threshold_s))
    return _finish(agg).select("airport_icao", "flight_date", "direction", "with_actual", "on_time", "adherence_pct")


def scheduled_flights(dep_operator: DataFrame, dep_not_departed: DataFrame, arr_operator: DataFrame, arr_not_arrived: DataFrame) -> DataFrame:
    """One row per scheduled movement of either direction: airport, day, scheduled hour, whether it was operated, delay."""
    def side(df: DataFrame, s: str, operated: bool) -> DataFrame:
        sched = F.col(f"{s}_scheduled_utc")
        delay = F.timestamp_diff("SECOND", sched, actual_time(s)) if operated else F.lit(None).cast("bigint")
        return df.select(F.lit(s).alias("direction"), "airport_icao", "flight_date", F.hour(sched).alias("hour"),
                         F.lit(operated).alias("operated"), delay.alias("delay_seconds"))
    parts = [side(dep_operator, "departure", True), side(dep_not_departed, "departure", False),
             side(arr_operator, "arrival", True), side(arr_not_arrived, "arrival", False)]
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Sums that every level of the efficiency report is rolled up from.
PARTIALS = ["scheduled", "operated", "not_operated", "with_actual", "total_delay_seconds", "on_time"]
# The report's levels: label, and what it is grouped by.
LEVELS = {"hour": ["airport_icao", "flight_date", "direction", "hour"], "day": ["airport_icao", "flight_date", "direction"],
          "airport_day": ["airport_icao", "flight_date"], "airport": ["airport_icao", "direction"]}


def efficiency_partials(flights: DataFrame, threshold_s: int = ON_TIME_SECONDS) -> DataFrame:
    """D4, stored form: counts and sums per airport, day, direction and hour. They can be added up, so coarser levels
    never need the flights again and a refreshed day replaces its own rows only."""
    d = F.col("delay_seconds")
    return flights.groupBy(*LEVELS["hour"]).agg(
        F.count(F.lit(1)).alias("scheduled"), F.count_if(F.col("operated")).alias("operated"), F.count_if(~F.col("operated")).alias("not_operated"),
        F.count(d).alias("with_actual"), F.sum(d).cast("bigint").alias("total_delay_seconds"), F.count_if(d <= threshold_s).alias("on_time"))


def efficiency_levels(partials: DataFrame) -> DataFrame:
    """D4 by hour, day (both directions apart and together) and airport: the partials rolled up by grouping sets."""
    keys = [F.col(c) for c in LEVELS["hour"]]
    sets = [[F.col(c) for c in level] for level in LEVELS.values()]
    bits = {sum(1 << (len(keys) - 1 - i) for i, c in enumerate(LEVELS["hour"]) if c not in level): name for name, level in LEVELS.items()}
    which = F.create_map(*[F.lit(x) for kv in bits.items() for x in kv])
    out = partials.groupingSets(sets, *keys).agg(F.grouping_id().cast("int").alias("__set"), *[F.sum(c).cast("bigint").alias(c) for c in PARTIALS])
    out = _finish(out).withColumn("operated_share", F.col("operated") / F.col("scheduled"))
    return out.select(which[F.col("__set")].alias("level"), *LEVELS["hour"], *PARTIALS, "avg_delay_minutes", "adherence_pct", "operated_share")


def hourly_efficiency(dep_operator: DataFrame, dep_not_departed: DataFrame,
                      threshold_s: int = ON_TIME_SECONDS) -> DataFrame:
    """Per airport, day and scheduled hour: scheduled, operated and not-departed flights, delay, adherence."""
    sched = F.col("departure_scheduled_utc")
    op = dep_operator.select("airport_icao", "flight_date", F.hour(sched).alias("hour"), F.lit(True).alias("operated"),
                             F.timestamp_diff("SECOND", sched, actual_time("departure")).alias("delay_seconds"))
    nd = dep_not_departed.select("airport_icao", "flight_date", F.hour(sched).alias("hour"),
                                 F.lit(False).alias("operated"), F.lit(None).cast("bigint").alias("delay_seconds"))
    agg = op.unionByName(nd).groupBy("airport_icao", "flight_date", "hour").agg(
        F.count(F.lit(1)).alias("scheduled"),
        F.count_if(F.col("operated")).alias("operated"),
        F.count_if(~F.col("operated")).alias("not_departed"),
        *_delay_aggs(threshold_s)[1:],
    )
    return _finish(agg).withColumn("not_departed_share", F.col("not_departed") / F.col("scheduled")).drop("flights")


def _seconds(c) -> Column:
    return F.timestamp_diff("SECOND", F.lit(_EPOCH).cast("timestamp_ntz"), c)


def _nearer() -> Column:
    """The nearer of ``before`` and ``after`` within LINK_HOURS, else null; equal gaps take the earlier, then the lower icao24."""
    def gap(c: str) -> Column:
        away = F.abs(_seconds(F.col(f"{c}.first_seen_ts")) - F.col("s"))
        return F.when(away <= LINK_HOURS * 3600, F.struct(away.alias("gap"), F.col(f"{c}.first_seen_ts").alias("first_seen_ts"), F.col(f"{c}.icao24").alias("icao24")))
    return F.least(gap("before"), gap("after"))


def _linked(tried: DataFrame, kind: str) -> DataFrame:
    """One row of each departure: what its mode-S found, else its callsign."""
    found = F.struct(F.when(F.col("one").isNull(), 2).when(F.col(kind) == "mode_s", 0).otherwise(1).alias("pref"),
                     F.when(F.col("one").isNotNull(), F.col(kind)).alias("kind"), "one")
    return tried.groupBy("id").agg(F.min(found).alias("f")).select(
        "id.*", F.col("f.kind").alias("link_key"), F.col("f.one.icao24").alias("icao24"),
        F.col("f.one.first_seen_ts").alias("first_seen_ts"), F.col("f.one.gap").alias("gap_seconds"))


def link_observed(dep_operator: DataFrame, observed: DataFrame, id_cols: list[str]) -> DataFrame:
    """Each operated departure with its nearest observed flight of the same aircraft, LINK_HOURS away at
    most (midnight does not matter).

    The aircraft is matched on mode-S = icao24; a departure that finds none so is tried by callsign. Both sides are
    put together by key and time bucket (an observation also goes into the two buckets beside its own), and
    one ordered pass forward and one back give each departure the last and the next observation: rows grow with
    the input, not with the pairs of an identifier. Departures without a key are spread by their identity.
    ``link_key`` is null where nothing was found; equal gaps take the earlier, then the lower icao24.
    """
    offers = lambda a, b: F.explode(F.array(
        F.struct(F.lit("mode_s").alias("kind"), F.col(a).alias("key")),
        F.struct(F.lit("callsign").alias("kind"), F.col(b).alias("key")))).alias("by")
    span = LINK_HOURS * 3600
    dep = dep_operator.select(F.struct(*id_cols).alias("id"), _seconds(F.coalesce(actual_time("departure"), "departure_scheduled_utc")).alias("s"),
                              offers("aircraft_mode_s", "callsign"))
    alone = F.col("by.key").isNull() | F.col("s").isNull()
    dep = dep.select("id", "s", "by", F.floor(F.col("s") / span).alias("bucket"), F.when(alone, F.xxhash64("id")).otherwise(F.lit(0)).alias("spread"))
    obs = observed.where(F.col("first_seen_ts").isNotNull()).select(
        F.struct("first_seen_ts", "icao24").alias("seen"), _seconds(F.col("first_seen_ts")).alias("s"), offers("icao24", "callsign"))
    own = F.floor(F.col("s") / span)
    obs = obs.where(F.col("by.key").isNotNull()).select(
        "seen", "s", "by", F.explode(F.array(own - 1, own, own + 1)).alias("bucket"), F.lit(0).cast("bigint").alias("spread"))
    rows = dep.unionByName(obs, allowMissingColumns=True)
    group = Window.partitionBy("by", "bucket", "spread")
    ties = [F.col("id").isNotNull(), F.col("seen.icao24").desc_nulls_first()]
    near = {name: F.last("seen", ignorenulls=True).over(group.orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0))
            for name, order in (("before", F.col("s").asc()), ("after", F.col("s").desc()))}
    rows = rows.withColumns(near).where(F.col("id").isNotNull())
    return _linked(rows.withColumn("one", _nearer()), "by.kind")


def link_observed_ranges(dep_operator: DataFrame, observed: DataFrame, id_cols: list[str]) -> DataFrame:
    """D7 for feeds with a junk identifier: the rows of ``link_observed``, with no limit on the rows of one identifier in a task.

    ``link_observed`` sorts one identifier's rows of a time bucket in one task and writes nothing; here both sides are
    put in ranges of key and time and neighbours are carried across them (``with_neighbours``), so even an identifier, or one second of it, that
    holds a third of all rows spreads over many tasks. Observations of one key and second are one offer, taken from the lowest
    icao24. Departures without a key or time skip the search.
    """
    offers = lambda a, b: F.inline(F.array(
        F.struct(F.lit("mode_s").alias("kind"), F.col(a).alias("key")),
        F.struct(F.lit("callsign").alias("kind"), F.col(b).alias("key"))))
    dep = dep_operator.select(F.struct(*id_cols).alias("id"), _seconds(F.coalesce(actual_time("departure"), "departure_scheduled_utc")).alias("s"),
                              offers("aircraft_mode_s", "callsign"))
    dep = materialize(dep, "link-departures")
    alone = F.col("key").isNull() | F.col("s").isNull()
    obs = observed.where(F.col("first_seen_ts").isNotNull()).select(
        F.struct("first_seen_ts", "icao24").alias("seen"), _seconds(F.col("first_seen_ts")).alias("s"), offers("icao24", "callsign"))
    obs = obs.where(F.col("key").isNotNull()).groupBy("kind", "key", "s").agg(
        F.min_by("seen", F.struct(F.col("seen.icao24").isNull(), F.col("seen.icao24"), F.col("seen.first_seen_ts"))).alias("seen"))
    rows = with_neighbours(dep.where(~alone).unionByName(obs, allowMissingColumns=True), ["kind", "key"], "s", "seen", F.xxhash64("id"))
    tried = rows.select("id", "kind", _nearer().alias("one"))
    return _linked(tried.unionByName(dep.where(alone).select("id", "kind"), allowMissingColumns=True), "kind")
