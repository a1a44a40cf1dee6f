"""Data-quality checks (Q1-Q7) over the staging models, one result row per declared check.

Failures count what the check's query returns, as in the warehouse's test runner:

* ``not_null``: rows with a null;  ``not_both_null`` / ``only_both_null``: offending rows
* ``accepted_values`` / ``not_accepted_values``: distinct offending values (null is never offending)
* ``unique`` (non-null values) and ``unique_combination_of_columns`` (nulls group together): duplicated keys

All row-level and value-set checks of one model run in one grouped pass (value columns plus one
failure flag per check, counted; partial aggregation leaves a few combinations per map task), and
each uniqueness check is one ``groupBy`` over just its key columns. Hot keys and values are counted
map-side before any shuffle; no check expands or gathers the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.functions.predicates import ARRIVED_STATUSES, DEPARTED, OPERATOR


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.kind}({','.join(self.columns)})"


def _nn(*cols):
    return [Check("not_null", (c,)) for c in cols]


def _accepted(col, values):
    return Check("accepted_values", (col,), tuple(values))


def _not_accepted(col, values):
    return Check("not_accepted_values", (col,), tuple(values))


_OP = _accepted("codeshare_status", [OPERATOR])
_ARRIVED = list(ARRIVED_STATUSES)

# Declared checks of every staging model (57 in all).
CHECKS: dict[str, list[Check]] = {
    "stg_airports": [Check("not_null", ("airport_key",)), Check("unique", ("airport_key",)),
                     Check("not_null", ("airport_icao",)), Check("unique", ("airport_icao",))],
    "stg_flights": _nn("icao24", "first_seen_ts") + [
        Check("unique_combination_of_columns", ("icao24", "first_seen_ts"))],
    "stg_departures_base": _nn("flight_number", "flight_date", "airport_icao", "departure_scheduled_utc") + [
        Check("unique_combination_of_columns", ("flight_number", "flight_date", "airport_icao",
                                                "departure_scheduled_utc", "arrival_airport_icao",
                                                "arrival_scheduled_utc"))],
    "stg_departures_not_departed": _nn("flight_number", "flight_date", "airport_icao") + [
        _not_accepted("status", [DEPARTED]), _OP],
    "stg_departures_operator": _nn("flight_number", "flight_date", "airport_icao", "departure_scheduled_utc") + [
        _accepted("status", [DEPARTED]), _OP,
        Check("not_both_null", ("callsign", "aircraft_mode_s")),
        Check("unique_combination_of_columns", ("flight_number", "flight_date", "callsign", "aircraft_mode_s",
                                                "airport_icao", "arrival_airport_icao"))],
    "stg_departures_unlinkable": _nn("flight_number", "flight_date", "airport_icao", "departure_scheduled_utc") + [
        _accepted("status", [DEPARTED]), _OP, Check("only_both_null", ("callsign", "aircraft_mode_s"))],
    "stg_arrivals_base": _nn("flight_number", "flight_date", "airport_icao", "arrival_scheduled_utc") + [
        Check("unique_combination_of_columns", ("flight_number", "flight_date", "departure_airport_icao",
                                                "departure_scheduled_utc", "airport_icao", "arrival_scheduled_utc"))],
    "stg_arrivals_not_arrived": _nn("flight_number", "flight_date", "airport_icao") + [
        _not_accepted("status", _ARRIVED), _OP],
    "stg_arrivals_operator": _nn("flight_number", "flight_date", "airport_icao", "arrival_scheduled_utc") + [
        _accepted("status", _ARRIVED), _OP,
        Check("not_both_null", ("callsign", "aircraft_mode_s")),
        Check("unique_combination_of_columns", ("flight_number", "flight_date", "callsign", "aircraft_mode_s",
                                                "departure_airport_icao", "airport_icao"))],
    "stg_arrivals_unlinkable": _nn("flight_number", "flight_date", "airport_icao", "arrival_scheduled_utc") + [
        _accepted("status", _ARRIVED), _OP, Check("only_both_null", ("callsign", "aircraft_mode_s"))],
}

# Declared constraints of the raw tables (NOT NULL columns, primary keys), run as checks: the loads
# do not enforce them, which is why staging de-duplicates.
RAW_CHECKS: dict[str, list[Check]] = {
    "raw_departures": _nn("flight_date", "airport_icao"),
    "raw_arrivals": _nn("flight_date", "airport_icao"),
    "raw_flights": _nn("icao24", "firstSeen") + [Check("unique_combination_of_columns", ("icao24", "firstSeen"))],
    "raw_airports": _nn("airport") + [Check("unique", ("airport",))],
}

RESULT_COLUMNS = ["model", "check_name", "failures", "passed"]


def _row_flag(check: Check):
    """Boolean column marking a failing row of a row-level check, or None for other kinds."""
    cols = [F.col(c) for c in check.columns]
    if check.kind == "not_null":
        return cols[0].isNull()
    if check.kind == "not_both_null":
        return reduce(lambda a, b: a & b, [c.isNull() for c in cols])
    if check.kind == "only_both_null":
        return reduce(lambda a, b: a | b, [c.isNotNull() for c in cols])
    return None


def _bad_value(check: Check):
    c = F.col(check.columns[0])
    return ~c.isin(list(check.values)) if check.kind == "accepted_values" else c.isin(list(check.values))


VALUE_KINDS = ("accepted_values", "not_accepted_values")
GROUP_KINDS = ("unique", "unique_combination_of_columns")


def _profile(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level and value-set checks of one model in one grouped pass.

    Rows are grouped by the value-set columns and one failure flag per row-level check, with a row
    count: partial aggregation collapses each map task to a few distinct combinations, so only those
    cross the shuffle. Row failures are then sums of counts, value failures distinct offending values,
    both computed on that small table.
    """
    row = [(c, _row_flag(c)) for c in checks if c.kind not in VALUE_KINDS + GROUP_KINDS]
    values = [c for c in checks if c.kind in VALUE_KINDS]
    value_cols = sorted({c.columns[0] for c in values})
    grouped = df.groupBy(*[F.col(v) for v in value_cols],
                         *[flag.alias(f"__f{i}") for i, (_, flag) in enumerate(row)]).agg(
        F.count(F.lit(1)).alias("__n"))
    aggs = [F.sum(F.when(F.col(f"__f{i}"), F.col("__n")).otherwise(F.lit(0))) for i in range(len(row))]
    aggs += [F.count_distinct(F.when(_bad_value(c), F.col(c.columns[0]))) for c in values]
    named = [c for c, _ in row] + values
    out = grouped.agg(*[F.coalesce(a, F.lit(0)).cast("bigint").alias(f"c{i}") for i, a in enumerate(aggs)])
    stack = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(named))
    return out.selectExpr(f"stack({len(named)}, {stack}) AS (check_name, failures)")


def _duplicates(df: DataFrame, check: Check) -> DataFrame:
    keyed = df.select(*check.columns)
    if check.kind == "unique":
        keyed = keyed.where(F.col(check.columns[0]).isNotNull())
    dup = keyed.groupBy(*check.columns).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures"))


def run_checks(df: DataFrame, model: str, checks: list[Check] | None = None) -> DataFrame:
    """One row per check: (model, check_name, failures, passed)."""
    checks = {**CHECKS, **RAW_CHECKS}[model] if checks is None else checks
    parts = []
    if any(c.kind not in GROUP_KINDS for c in checks):
        parts.append(_profile(df, checks))
    for c in checks:
        if c.kind in GROUP_KINDS:
            parts.append(_duplicates(df, c).select(F.lit(c.name).alias("check_name"),
                                                   F.col("failures").cast("bigint").alias("failures")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(F.lit(model).alias("model"), "check_name", "failures",
                      (F.col("failures") == 0).alias("passed"))


def run_all(models: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [run_checks(df, name) for name, df in models.items()])


# ---- the failing rows themselves -------------------------------------------------------------------
def offending_rows(df: DataFrame, model: str, checks: list[Check] | None = None) -> DataFrame:
    """Every row that fails a declared check, once for each check it fails: model, check_name and all columns of ``df``.

    Row-level and value checks are flags of the row, exploded in one pass without a shuffle. A uniqueness check fails
    for every row of a repeated key: the keys are counted with a partial aggregation, and the rows meet the
    repeated ones (few, unless the table is broken) in a semi join, whose nulls group together as in the check.
    """
    checks = {**CHECKS, **RAW_CHECKS}[model] if checks is None else checks
    single = [c for c in checks if c.kind not in GROUP_KINDS]
    parts = []
    if single:
        flags = [F.when(_bad_value(c) if c.kind in VALUE_KINDS else _row_flag(c), F.lit(c.name)) for c in single]
        parts.append(df.withColumn("check_name", F.explode(F.array_compact(F.array(*flags)))))
    for i, c in enumerate(c for c in checks if c.kind in GROUP_KINDS):
        keyed = df.select(*[F.col(k).alias(f"__k{i}_{k}") for k in c.columns])
        if c.kind == "unique":
            keyed = keyed.where(F.col(f"__k{i}_{c.columns[0]}").isNotNull())
        again = keyed.groupBy(*keyed.columns).count().where(F.col("count") > 1)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}_{k}")) for k in c.columns])
        parts.append(df.join(again, same, "left_semi").withColumn("check_name", F.lit(c.name)))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(F.lit(model).alias("model"), "check_name", *[F.col(f"`{n}`") for n in df.columns])
