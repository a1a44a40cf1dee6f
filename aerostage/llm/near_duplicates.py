"""One document of each near-duplicate group, by the n-gram Jaccard join (4).

A row is named by its id and a hash of its text, not by the id alone: ids may repeat or be null.

Defined cases: of a group the row with the smallest (id, text hash) stays, null ids last. Rows equal in id and text are
one document and one of them stays. A text without words is in no group; such rows without an id all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.common import BROADCAST_ROWS, saved
from aerostage.llm.ngram_join import links

_ROW = ["no_id", "id", "text_hash"]


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, columns unchanged, of each group of near-duplicate rows, and all rows that are in none."""
    row = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"))
    profile, roots = links(docs.select(row.alias("row"), F.col(text).alias("text")), "row", "text")
    found = saved(profile.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        F.col("doc_id").alias("row"), F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("comp")), "near-components")
    small = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    # groups of more than one row, and the row of each that stays
    groups = found.where("comp is not null").groupBy("comp").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first <> last")
    groups = saved(groups.select("comp", "first"), "near-groups")
    gone = saved(found.join(small(groups), "comp").where("row <> first").select("row").distinct(), "near-gone")
    again = found.where("comp is not null or not row.no_id").groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row")
    again = saved(again, "near-again")

    named = docs.withColumn("__row", row)
    named = named.select(*docs.columns, *[F.col(f"__row.{c}").alias(f"__{c}") for c in _ROW])

    def join(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = small(keys.select(*[F.col(f"row.{c}").alias(f"__k_{c}") for c in _ROW]))
        return df.join(keys, F.col("__id").eqNullSafe(F.col("__k_id")) & (F.col("__text_hash") == F.col("__k_text_hash")), how)

    kept = join(named, gone, "left_anti")
    if not again.isEmpty():
        once = join(kept, again, "left_semi").dropDuplicates([f"__{c}" for c in _ROW])
        kept = join(kept, again, "left_anti").unionByName(once)
    return kept.select(*docs.columns)
