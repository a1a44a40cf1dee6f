"""Each check kind on a passing and a failing table (Q1-Q7), nulls included."""

from aerostage.plans.checks import CHECKS, Check, run_checks


def failures(spark, rows, schema, check):
    df = spark.createDataFrame(rows, schema)
    return run_checks(df, "t", [check]).first().failures


def test_declared_check_count():
    assert sum(len(v) for v in CHECKS.values()) == 57


def test_not_null(spark):
    c = Check("not_null", ("a",))
    assert failures(spark, [(1,), (2,)], "a int", c) == 0
    assert failures(spark, [(1,), (None,), (None,)], "a int", c) == 2


def test_unique_ignores_nulls(spark):
    c = Check("unique", ("a",))
    assert failures(spark, [(1,), (None,), (None,)], "a int", c) == 0
    assert failures(spark, [(1,), (1,), (2,), (2,), (3,)], "a int", c) == 2


def test_unique_combination_groups_nulls(spark):
    c = Check("unique_combination_of_columns", ("a", "b"))
    assert failures(spark, [(1, None), (2, None)], "a int, b int", c) == 0
    assert failures(spark, [(1, None), (1, None)], "a int, b int", c) == 1


def test_accepted_values_counts_distinct_bad_values_null_passes(spark):
    c = Check("accepted_values", ("s",), ("Departed",))
    assert failures(spark, [("Departed",), (None,)], "s string", c) == 0
    assert failures(spark, [("Departed",), ("X",), ("X",), ("Y",)], "s string", c) == 2


def test_not_accepted_values(spark):
    c = Check("not_accepted_values", ("s",), ("Arrived", "Delayed"))
    assert failures(spark, [("Canceled",), (None,)], "s string", c) == 0
    assert failures(spark, [("Arrived",), ("Arrived",)], "s string", c) == 1


def test_not_both_null_and_only_both_null(spark):
    rows, schema = [(None, None), ("A", None), (None, "B")], "a string, b string"
    assert failures(spark, rows, schema, Check("not_both_null", ("a", "b"))) == 1
    assert failures(spark, rows, schema, Check("only_both_null", ("a", "b"))) == 2
    assert failures(spark, [(None, None)], schema, Check("only_both_null", ("a", "b"))) == 0


def test_result_has_one_row_per_check(spark):
    df = spark.createDataFrame([(1, "x")], "a int, s string")
    checks = [Check("not_null", ("a",)), Check("unique", ("a",)), Check("accepted_values", ("s",), ("x",))]
    out = run_checks(df, "m", checks)
    assert out.columns == ["model", "check_name", "failures", "passed"]
    assert sorted(r.check_name for r in out.collect()) == sorted(c.name for c in checks)
    assert all(r.passed for r in out.collect())
