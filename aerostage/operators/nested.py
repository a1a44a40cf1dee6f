"""Nested-record operators: safe path reads (N1-N4), array to rows (N5), flatten (N7), key alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path(p: str, default=None) -> Column:
    """Dotted path read. A missing object on the way reads as null; ``default`` replaces only that null."""
    c = F.col(p)
    return c if default is None else F.coalesce(c, F.lit(default))


def select_paths(df: DataFrame, fields, extra: dict[str, Column] | None = None) -> DataFrame:
    """Project ``(name, dotted path or None, type)`` rows; a ``None`` path takes ``extra[name]``."""
    extra = extra or {}
    cols = []
    for name, p, t in fields:
        src = extra[name] if p is None else path(p)
        cols.append(src.cast(t).alias(name))
    return df.select(*cols)


def explode_array(df: DataFrame, array_col: str, keep: list[str]) -> DataFrame:
    """One row per array element, its fields as columns; a null or missing array gives no row."""
    return df.select(*keep, F.inline(F.col(array_col)))


def _flat_columns(schema: T.StructType, prefix: str, sep: str, parent: str | None) -> list[Column]:
    out = []
    for f in schema.fields:
        ref = f"{parent}.`{f.name}`" if parent else f"`{f.name}`"
        name = f"{prefix}{sep}{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType):
            out.extend(_flat_columns(f.dataType, name, sep, ref))
        else:
            out.append(F.col(ref).alias(name))
    return out


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields become top-level columns named by their joined path; arrays stay values."""
    return df.select(*_flat_columns(df.schema, "", sep, None))


def align(frames: list[DataFrame]) -> DataFrame:
    """Bag union over the union of all columns, missing ones null, columns in sorted order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns))
