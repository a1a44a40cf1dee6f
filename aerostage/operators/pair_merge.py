"""Merge the two best records of a flight (J1, J2) without a self join.

The staging rule ranks the rows of each group, keeps rank 1 and fills its missing times from rank 2
through a left self join on the group keys. Here the same result comes from one window: ranks are
limited to 2 (a ``WindowGroupLimit``, partial before the shuffle), then ``lead`` over the same window
reads rank 2 onto rank 1, so no join and no second shuffle are needed.

Semantics kept from the join form: window grouping treats null keys as equal but an equi-join does
not, so when any key is null the primary gets no fill (its rank-2 row is still dropped). Rank 3 and
beyond are always dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostage.operators.dedup import _order, default_tiebreak

RN = "__pair_rn"


def pair_merge(df: DataFrame, keys: list[str], order, fill: list[str], tiebreak=None,
               output: list[str] | None = None) -> DataFrame:
    """Rank-1 row of each group with ``fill`` columns coalesced from the rank-2 row.

    ``output`` names the result columns (default: all input columns). Columns in ``fill`` are
    coalesced; the rest come from the primary row.
    """
    tb = default_tiebreak(df, keys) if tiebreak is None else _order(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*_order(order), *tb)
    top2 = df.withColumn(RN, F.row_number().over(w)).where(F.col(RN) <= 2)
    linked = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    cols = output or df.columns
    merged = top2.select(
        *[
            (F.coalesce(F.col(c), F.when(linked, F.lead(F.col(c)).over(w))) if c in fill else F.col(c)).alias(c)
            for c in cols
        ],
        F.col(RN),
    )
    return merged.where(F.col(RN) == 1).drop(RN)
