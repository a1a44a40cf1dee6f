"""Keep the first row of each group.

``row_number() = 1`` over a window is planned by Spark as a ``WindowGroupLimit``: a partial top-1 runs
in every map task *before* the shuffle, so a group of repeated copies, however hot, sends at most one
row per map task across the network. Only the surviving rows are sorted and ranked.

Null order follows the warehouse the models were written for: nulls sort as the largest value
(``ASC NULLS LAST``, ``DESC NULLS FIRST``). Ties are always broken (``row_id`` when present, else every
other column), so results repeat run after run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RN = "__rn"


def asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def _sortable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.StructType):
        return all(_sortable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _sortable(t.elementType)
    return True


def default_tiebreak(df: DataFrame, keys) -> list[Column]:
    """``row_id`` when present; else every other sortable column, in column-name order (so the rule
    does not depend on how a table's columns happen to be ordered)."""
    if "row_id" in df.columns:
        return [asc("row_id")]
    skip = {k for k in keys if isinstance(k, str)}
    fields = sorted((f for f in df.schema.fields if f.name not in skip and _sortable(f.dataType)), key=lambda f: f.name)
    return [asc(f.name) for f in fields]


def _order(order) -> list[Column]:
    return [asc(o) if isinstance(o, str) else o for o in order]


def rank_within(df: DataFrame, keys, order, tiebreak=None, name: str = RN) -> DataFrame:
    tb = default_tiebreak(df, keys) if tiebreak is None else _order(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*_order(order), *tb)
    return df.withColumn(name, F.row_number().over(w))


def keep_first(df: DataFrame, keys, order, tiebreak=None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` then ``tiebreak``."""
    return rank_within(df, keys, order, tiebreak).where(F.col(RN) == 1).drop(RN)
