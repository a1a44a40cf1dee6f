"""Property tests: operators against plain-Python brute force on random rows with nulls and ties."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerostage.functions.casts import parse_local_time, parse_utc_time
from aerostage.operators import global_row_number, keep_first, pair_merge
from aerostage.operators.dedup import asc, desc

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

key = st.sampled_from(["a", "b", None])
small = st.one_of(st.none(), st.integers(0, 3))
rows_strategy = st.lists(st.tuples(key, key, small, small, small), min_size=1, max_size=40)


def _sort_key(v, descending=False):
    # warehouse order: null is the largest value, so it comes last ascending and first descending
    if descending:
        return (0, 0) if v is None else (1, -v)
    return (1, 0) if v is None else (0, v)


@SETTINGS
@given(rows_strategy)
def test_pair_merge_matches_the_self_join_definition(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "row_id long, k1 string, k2 string, o int, x int, y int")
    got = {r.row_id: (r.x, r.y) for r in pair_merge(df, ["k1", "k2"], [asc("o")], ["x", "y"]).collect()}

    groups = {}
    for r in data:
        groups.setdefault((r[1], r[2]), []).append(r)
    want = {}
    for (k1, k2), members in groups.items():
        ranked = sorted(members, key=lambda r: (_sort_key(r[3]), r[0]))
        p = ranked[0]
        s = ranked[1] if len(ranked) > 1 and k1 is not None and k2 is not None else None
        want[p[0]] = (p[4] if p[4] is not None else (s[4] if s else None),
                      p[5] if p[5] is not None else (s[5] if s else None))
    assert got == want


@SETTINGS
@given(rows_strategy)
def test_keep_first_matches_sorted_groups(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "row_id long, k1 string, k2 string, o int, x int, y int")
    got = sorted(r.row_id for r in keep_first(df, ["k1"], [desc("o")]).collect())
    groups = {}
    for r in data:
        groups.setdefault(r[1], []).append(r)
    want = sorted(min(m, key=lambda r: (_sort_key(r[3], descending=True), r[0]))[0] for m in groups.values())
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["EDDF", "eddf", "LFPG", "OMDB", "A", "Z"])),
                min_size=1, max_size=60), st.integers(1, 9))
def test_global_row_number_matches_enumeration(spark, codes, parts):
    data = list(enumerate(codes))
    df = spark.createDataFrame(data, "row_id long, icao string")
    got = sorted((r.row_id, r.n) for r in global_row_number(df, [asc("icao"), asc("row_id")], "n", parts).collect())
    order = sorted(data, key=lambda r: ((1, "") if r[1] is None else (0, r[1]), r[0]))
    want = sorted((r[0], i + 1) for i, r in enumerate(order))
    assert got == want


offsets = st.integers(-12 * 4, 14 * 4).map(lambda q: q * 15)  # minutes, quarter-hour steps
moments = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 12, 31)).map(
    lambda d: d.replace(microsecond=0))


@SETTINGS
@given(st.lists(st.tuples(moments, offsets, st.booleans(), st.booleans()), min_size=1, max_size=30))
def test_time_text_round_trip(spark, cases):
    rows = []
    for utc, off, with_secs, t_sep in cases:
        utc = utc if with_secs else utc.replace(second=0)
        local = utc + dt.timedelta(minutes=off)
        sign = "-" if off < 0 else "+"
        suffix = "Z" if off == 0 and t_sep else f"{sign}{abs(off) // 60:02d}:{abs(off) % 60:02d}"
        fmt = "%Y-%m-%d" + ("T" if t_sep else " ") + ("%H:%M:%S" if with_secs else "%H:%M")
        rows.append((local.strftime(fmt) + suffix, utc, local))
    df = spark.createDataFrame([(t,) for t, _, _ in rows], "t string")
    got = df.select(parse_utc_time("t").alias("u"), parse_local_time("t").alias("l")).collect()
    assert [(r.u, r.l) for r in got] == [(u, lo) for _, u, lo in rows]
