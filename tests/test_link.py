"""D7 on cases the derived tables do not hold: midnight, callsign after mode-S, a junk identifier."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerostage.operators import neighbours
from aerostage.plans import kpi

T0 = dt.datetime(2025, 1, 2, 23, 50)
DEP = ("row_id bigint, flight_date date, callsign string, aircraft_mode_s string, departure_scheduled_utc timestamp_ntz, "
       "departure_revised_utc timestamp_ntz, departure_runway_utc timestamp_ntz")
OBS = "icao24 string, callsign string, first_seen_ts timestamp_ntz"


def _links(spark, dep, obs):
    rows = [(i, T0.date(), call, mode, at, None, None) for i, call, mode, at in dep]
    out = kpi.link_observed(spark.createDataFrame(rows, DEP), spark.createDataFrame(obs, OBS), ["row_id"])
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    return {r["row_id"]: (r["link_key"], r["icao24"], r["gap_seconds"]) for r in out.collect()}


def test_link_cases(spark):
    minute = dt.timedelta(minutes=1)
    dep = [(1, None, "A1", T0), (2, "C2", "NONE", T0), (3, "C9", "A9", T0), (4, None, None, T0), (5, "C2", "A1", None), (6, None, "A6", T0)]
    obs = [("A1", "X", T0 + 20 * minute), ("A1", "X", T0 - 30 * minute), ("B2", "C2", T0 - 5 * minute), ("A9", "Z", T0 + 13 * 60 * minute),
           ("A6", None, T0 - 7 * minute), ("A6", None, T0 + 7 * minute), (None, None, T0)]
    assert _links(spark, dep, obs) == {1: ("mode_s", "A1", 1200), 2: ("callsign", "B2", 300), 3: (None, None, None), 4: (None, None, None),
                                       5: (None, None, None), 6: ("mode_s", "A6", 420)}


def test_link_junk_identifier(spark):
    second = dt.timedelta(seconds=1)
    dep = [(i, None, "000000", T0 + 2 * i * second) for i in range(500)]
    obs = [("000000", None, T0 + (2 * i + 1) * second) for i in range(500)]
    got = _links(spark, dep, obs)
    assert len(got) == 500 and all(v == ("mode_s", "000000", 1) for v in got.values())


def _hot(spark, dep_s: str, obs_s: str, n: int):
    at = lambda e: F.timestamp_add("SECOND", F.expr(e), F.lit(T0).cast("timestamp_ntz"))
    none = F.lit(None)
    dep = spark.range(n).select(F.col("id").alias("row_id"), F.lit(T0.date()).alias("flight_date"), none.cast("string").alias("callsign"),
                                F.lit("000000").alias("aircraft_mode_s"), at(dep_s).alias("departure_scheduled_utc"),
                                *[none.cast("timestamp_ntz").alias(f"departure_{x}_utc") for x in ("revised", "runway")])
    obs = spark.range(n).select(F.lit("000000").alias("icao24"), none.cast("string").alias("callsign"), at(obs_s).alias("first_seen_ts"))
    return dep, obs


def test_rows_of_one_identifier_spread_over_ranges(spark):
    """300,000 departures and as many observations of one junk identifier: every range is a small share, and
    the offers carried across the ranges give every departure its neighbour."""
    n = 300_000
    dep, obs = _hot(spark, "cast(2 * id as bigint)", "cast(2 * id + 1 as bigint)", n)
    out = kpi.link_observed_ranges(dep, obs, ["row_id"])
    got = out.agg(F.count("*"), F.count_if(F.expr("gap_seconds = 1 and icao24 = '000000' and link_key = 'mode_s'"))).first()
    assert tuple(got) == (n, n)
    rows = spark.range(n).select(F.lit("x").alias("k"), "id", F.lit(0).alias("s"), F.lit(None).cast("int").alias("seen"))
    sizes = [r["count"] for r in neighbours.in_ranges(rows, ["k"], "s", "seen", F.xxhash64("id"), 16).groupBy("__part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * n / 16  # even where all rows share one second


def test_one_observation_reaches_every_range(spark):
    """One offer in the middle of 20,000 departures: all ranges before and after take it, within the hours allowed."""
    n = 20_000
    dep, _ = _hot(spark, "cast(10 * id as bigint)", "cast(id as bigint)", n)
    _, obs = _hot(spark, "cast(id as bigint)", "cast(100000 + id * 0 as bigint)", 3)
    out = kpi.link_observed_ranges(dep, obs, ["row_id"])
    want = F.when(F.abs(F.col("row_id") * 10 - 100000) <= kpi.LINK_HOURS * 3600, F.abs(F.col("row_id") * 10 - 100000))
    assert out.count() == n and out.where(~F.col("gap_seconds").eqNullSafe(want)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_neighbours_equal_a_plain_search(spark, seed):
    rng = random.Random(seed)
    offers = {(rng.choice("ab"), rng.randrange(40)): i for i in range(12)}
    asks = [(i, rng.choice("abc"), rng.randrange(40)) for i in range(120)]
    rows = [(None, k, s, v) for (k, s), v in offers.items()] + [(i, k, s, None) for i, k, s in asks]
    df = spark.createDataFrame(rows, "id int, k string, s int, v int")
    got = {r["id"]: (r["before"], r["after"]) for r in neighbours.with_neighbours(df, ["k"], "s", "v", F.xxhash64("id"), 11).collect()}
    assert len(got) == len(asks)
    for i, k, s in asks:
        before = max(((t, v) for (q, t), v in offers.items() if q == k and t <= s), default=(None, None))
        later = min(((t, v) for (q, t), v in offers.items() if q == k and t > s), default=(None, None))
        assert got[i][0] == before[1]
        assert got[i][1] in ((later[1],) if before[0] != s else (later[1], before[1]))


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], "id int, k string, s int, v int")
    assert neighbours.with_neighbours(df, ["k"], "s", "v", F.xxhash64("id"), 4).collect() == []


def test_both_forms_link_alike(spark):
    rng = random.Random(4)
    minute = dt.timedelta(minutes=1)
    some = lambda: rng.choice([None, "A1", "A2", "000000"])
    dep = spark.createDataFrame([(i, T0.date(), some(), some(), rng.choice([None, T0 + rng.randrange(-900, 900) * minute]), None, None)
                                 for i in range(300)], DEP)
    obs = spark.createDataFrame([(some(), some(), T0 + rng.randrange(-1800, 1800) * minute) for _ in range(200)], OBS)
    plain, ranged = (sorted(map(str, f(dep, obs, ["row_id"]).collect())) for f in (kpi.link_observed, kpi.link_observed_ranges))
    assert plain == ranged and len(plain) == 300


def test_range_form_on_the_cases(spark, monkeypatch):
    monkeypatch.setattr(kpi, "link_observed", kpi.link_observed_ranges)
    test_link_cases(spark)
    test_link_junk_identifier(spark)
