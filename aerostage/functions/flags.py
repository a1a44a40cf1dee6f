"""Ranking flags used as window sort keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def reliability_score(runway="arrival_runway_utc", revised="arrival_revised_utc") -> Column:
    """2 with a runway time, 1 with only a revised time, else 0."""
    return (F.when(F.col(runway).isNotNull(), F.lit(2))
            .when(F.col(revised).isNotNull(), F.lit(1))
            .otherwise(F.lit(0)))


def completeness_flag(strict: bool = False) -> Column:
    """Sort key of the most-complete-departure dedup: 0 sorts first.

    ``strict=False`` is the staging rule as deployed: a record is pushed back when it lacks a revised
    departure, *has* a runway departure, or lacks any arrival time. ``strict=True`` pushes back a record
    that lacks any of the five times instead (what the rule's comment describes).
    """
    runway = F.col("departure_runway_utc").isNull() if strict else F.col("departure_runway_utc").isNotNull()
    needed = ["departure_revised_utc", "arrival_scheduled_utc", "arrival_revised_utc", "arrival_runway_utc"]
    return (runway | ~reduce(and_, [F.col(c).isNotNull() for c in needed])).cast("int")
