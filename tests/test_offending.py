"""Every declared check returns its failing rows, on tables broken in every way, as the oracle's own declaration does."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest

from aerostage.plans import checks
from aerostage.plans.oracle_checks import counts_sql, declared, rows_sql

ALL = {**checks.CHECKS, **checks.RAW_CHECKS}


def test_both_declarations_hold_the_same_checks():
    for model, own in ALL.items():
        assert Counter(c.name for c in own) == Counter(name for name, _, _ in declared(model)), model
    assert sum(len(v) for v in checks.CHECKS.values()) == 57


def broken(spark, model, n=400):
    r = random.Random(model)
    columns = sorted({c for check in ALL[model] for c in check.columns})
    values = {
        "status": ["Departed", "Arrived", "Approaching", "Delayed", "Canceled", None], "codeshare_status": ["IsOperator", "IsCodeshared", None],
        "flight_date": [dt.date(2025, 1, 1), dt.date(2025, 1, 2), None],
    }
    pick = lambda c: r.choice(values.get(c) or [f"{c}{k}" for k in range(6)] + [None])
    rows = [(i, *[pick(c) for c in columns]) for i in range(n)]
    rows += [(n + i, *rows[r.randrange(n)][1:]) for i in range(40)]  # repeated keys, null ones among them
    schema = "row_id bigint, " + ", ".join(f"{c} {'date' if c == 'flight_date' else 'string'}" for c in columns)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("model", sorted(ALL))
def test_failing_rows_of_broken_tables_equal_sql(spark, model):
    df = broken(spark, model)
    con = duckdb.connect()
    con.register("t", df.toArrow())
    cols = ["row_id", *sorted({c for check in ALL[model] for c in check.columns})]
    want = con.sql(rows_sql({model: "t"}, cols)).fetchall()
    got = [tuple(x) for x in checks.offending_rows(df, model).select("model", "check_name", *cols).collect()]
    assert Counter(got) == Counter(want)
    assert {x[1] for x in got} == {c.name for c in ALL[model]}, "every check fails somewhere"
    counted = con.sql(counts_sql({model: "t"})).fetchall()
    assert Counter(tuple(x) for x in checks.run_checks(df, model).collect()) == Counter(counted)


def test_hot_repeated_key_and_empty_table(spark):
    df = spark.range(20_000).selectExpr("id AS row_id", "IF(id < 15000, 'hot', string(id)) AS icao24", "bigint(IF(id < 15000, 1, id)) AS firstSeen")
    got = checks.offending_rows(df, "raw_flights")
    assert got.count() == 15_000 and got.where("icao24 <> 'hot'").isEmpty()
    assert checks.offending_rows(df.limit(0), "raw_flights").isEmpty()
