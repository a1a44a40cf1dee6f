"""Every query of the staging library equals its DuckDB oracle (rows, columns, values) on the small tables."""

import pytest

import __spark_entry__ as E
from aerostage.plans.catalog import queries
from aerostage.plans.oracle import oracle_sql
from tools.compare import compare

from conftest import SF_SMALL

NAMES = sorted(queries())  # optional subpackages test their own


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(NAMES)
    assert set(E.oracle_sql()) <= set(E.queries()) >= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res.get("ok") is True, res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema


def test_contract_loads_without_a_spark_context():
    """The driver may list queries before any session exists: nothing may build a Column at import."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import __spark_entry__ as E; q = E.queries(); s = E.oracle_sql(); "
            "assert set(s) <= set(q); print(*sorted(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert set(NAMES) <= set(out.stdout.split())
