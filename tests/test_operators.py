"""Edge rows for the DataFrame operators."""

from pyspark.sql import functions as F

from aerostage.operators import align, explode_array, flatten, global_row_number, keep_first, pair_merge
from aerostage.operators.dedup import asc, desc
from aerostage.plans import staging
from aerostage.plans.catalog import dep_base

from conftest import SF_CHECK


def test_keep_first_duplicates_ties_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, "a", 5), (3, "a", 4), (4, None, 1), (5, None, 2), (6, "b", None), (7, "b", 3)],
        "row_id long, k string, v int")
    got = {r.k: r.row_id for r in keep_first(df, ["k"], [desc("v")]).collect()}
    # ties broken by row_id; null keys form one group; a null order value sorts first when descending
    assert got == {"a": 1, None: 5, "b": 6}


def test_keep_first_without_row_id_uses_all_columns(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x")], "k string, v int, w string")
    assert keep_first(df, ["k"], [asc("v")]).first().w == "x"


def test_pair_merge_groups_of_one_two_three_and_null_keys(spark):
    rows = [
        (1, "A", "M", 1, None, None),       # group of one
        (2, "B", "M", 1, None, "x2"),       # primary missing x, secondary has it
        (3, "B", "M", 2, "y3", "x3"),
        (4, "C", "M", 1, "p4", "q4"),       # primary complete
        (5, "C", "M", 2, "p5", "q5"),
        (6, "C", "M", 3, "p6", "q6"),       # rank 3 always lost
        (7, None, "M", 1, None, None),      # null key: grouped, never merged
        (8, None, "M", 2, "y8", "x8"),
    ]
    df = spark.createDataFrame(rows, "row_id long, cs string, ms string, s int, y string, x string")
    out = {r.row_id: (r.y, r.x) for r in pair_merge(df, ["cs", "ms"], [asc("s")], ["x", "y"]).collect()}
    assert out == {1: (None, None), 2: ("y3", "x2"), 4: ("p4", "q4"), 7: (None, None)}


def test_window_pair_merge_equals_self_join_form(spark):
    base = dep_base(spark, SF_CHECK)
    a = staging.departures_operator(base)
    b = staging.departures_operator_grouped(base)
    assert a.count() == b.count() == a.unionByName(b).distinct().count()


def test_global_row_number_matches_sorted_position_with_a_hot_key(spark):
    # one value holds a third of the rows; numbering must still be dense, ordered and unique
    df = spark.range(3000).select(F.col("id").alias("row_id"),
                                  F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.format_string("K%05d", "id"))
                                  .alias("icao"))
    got = global_row_number(df, [asc("icao"), asc("row_id")], name="n", num_partitions=7)
    rows = sorted((r.icao, r.row_id, r.n) for r in got.collect())
    assert [n for _, _, n in rows] == list(range(1, 3001))


def test_explode_missing_and_empty_arrays(spark):
    df = spark.createDataFrame([("A", [(1,), (2,)]), ("B", []), ("C", None)], "k string, legs array<struct<n:int>>")
    assert [(r.k, r.n) for r in explode_array(df, "legs", ["k"]).collect()] == [("A", 1), ("A", 2)]


def test_flatten_depth_three_keeps_arrays(spark):
    df = spark.createDataFrame([(1, ((("u", "l"),), ["Basic"]))],
                               "id int, departure struct<t: struct<s: struct<utc: string, local: string>>, q: array<string>>")
    flat = flatten(df)
    assert flat.columns == ["id", "departure_t_s_utc", "departure_t_s_local", "departure_q"]
    assert flat.first().departure_q == ["Basic"]


def test_scalar_where_struct_declared_reads_null(spark):
    js = spark.sparkContext.parallelize(['{"departure": 5, "number": "X1"}', '{"number": "X2"}'])
    df = spark.read.schema("number string, departure struct<airport: struct<icao: string>>").json(js)
    got = sorted((r.number, r.icao) for r in df.select("number", F.col("departure.airport.icao").alias("icao")).collect())
    assert got == [("X1", None), ("X2", None)]


def test_align_sorted_union_of_keys(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2, 3.0)], "b int, c double")
    out = align([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(out.collect(), key=lambda r: r.b) == [("x", 1, None), (None, 2, 3.0)]


def test_operators_on_empty_input(spark):
    from aerostage.plans.checks import CHECKS, run_checks

    empty = spark.createDataFrame([], "row_id long, icao string, k1 string, k2 string, o int, x int")
    assert global_row_number(empty, [asc("icao"), asc("row_id")], "n").count() == 0
    assert pair_merge(empty, ["k1", "k2"], [asc("o")], ["x"]).count() == 0
    assert keep_first(empty, ["k1"], [asc("o")]).count() == 0
    base = spark.createDataFrame([], "flight_number string, flight_date date, airport_icao string, "
                                     "departure_scheduled_utc timestamp_ntz, arrival_airport_icao string, "
                                     "arrival_scheduled_utc timestamp_ntz")
    out = run_checks(base, "stg_departures_base").collect()
    assert len(out) == len(CHECKS["stg_departures_base"]) and all(r.failures == 0 and r.passed for r in out)
