"""Nested records without a declared schema (N1, N7, N8), as VARIANT values parsed from JSON text.

* ``get_path``: a dotted read that tells a present null from a missing key (only the missing one gets the default);
* ``leaf_paths``: the keys that occur anywhere, found by Spark level by level;
* ``flatten_unknown``: records as columns over the sorted union of those keys, absent ones null.

Malformed text and records that are no objects have no keys. The number of different keys must be one that a table
can have as columns: the driver gets one row for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text) -> Column:
    """JSON text as a variant; null where it is malformed."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def _json_path(keys: Sequence[str]) -> str:
    out = "$"
    for k in keys:
        quote = "'" if "'" not in k else '"'
        if quote in k:
            raise ValueError(f"a key with both quotes: {k}")
        out += f"[{quote}{k}{quote}]"
    return out


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def get_path(v, path: str | Sequence[str], default: str | None = None) -> Column:
    """Text of the value at a path (keys, or their dotted form). A missing key, or a value that is no object on the way,
    gives ``default``; a null that is present at the end stays null; an object or array is given as JSON."""
    v = F.col(v) if isinstance(v, str) else v
    keys = path.split(".") if isinstance(path, str) else list(path)
    found = F.try_variant_get(v, _json_path(keys), "variant")
    return (F.when(found.isNull(), F.lit(default).cast("string")).when(F.is_variant_null(found), F.lit(None).cast("string"))
            .otherwise(F.coalesce(F.try_variant_get(v, _json_path(keys), "string"), F.to_json(found))))


#: Levels of nested objects that one pass over the records opens.
LEVELS = 4


def leaf_paths(df: DataFrame, col: str) -> list[tuple[str, ...]]:
    """Paths of all values of a variant column that are no objects, in any record; sorted by joined name, then path.

    A pass opens the objects of ``LEVELS`` levels; what is no object goes through as it is. Only where objects are left below
    that is there another pass. Equal paths are combined in each task before the shuffle.
    """
    spark = df.sparkSession
    level = df.select(F.array().cast("array<string>").alias("path"), F.col(col).alias("v"))
    level = level.select("path", "v", _is_object(F.col("v")).alias("object")).where("object")
    key, value, inside = F.col("key"), F.col("value"), F.col("key").isNotNull()
    while True:
        for _ in range(LEVELS):
            opened = level.lateralJoin(spark.tvf.variant_explode_outer(F.when(F.col("object"), F.col("v")).outer()))
            opened = opened.where(inside | ~F.col("object"))  # an object without keys ends here
            level = opened.select(F.when(inside, F.concat(F.col("path"), F.array(key))).otherwise(F.col("path")).alias("path"),
                                  value.alias("v"), F.when(inside, _is_object(value)).otherwise(F.lit(False)).alias("object"))
        found = level.select("path", "object").distinct().collect()
        if not any(r["object"] for r in found):
            return sorted({tuple(r["path"]) for r in found}, key=lambda p: ("_".join(p), p))


def flatten_unknown(df: DataFrame, col: str, keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """``keep`` and a text column for every key of the variant column ``col``, nested keys joined by ``sep``, in sorted
    order. A record without the key, or with an object in its place, has null there; arrays are JSON values. Where two paths
    join to one name the first that is there counts."""
    names: dict[str, list[Column]] = {}
    for path in leaf_paths(df, col):
        value = F.try_variant_get(F.col(col), _json_path(path), "variant")
        text = F.when(value.isNotNull() & ~_is_object(value), get_path(col, path))
        names.setdefault(sep.join(path), []).append(text)
    return df.select(*keep, *[F.coalesce(*values).alias(name) for name, values in sorted(names.items())])
