"""Mixing sources to target weights (6), DataFrame functions only.

The sources (code point order, null last) weigh 5, 2, 1, repeating, and share 150 % of all words; a target
stops at twice its source's words and the excess is shared again by weight (closed-form water filling over
one row for each source). Every document has a 60-bit position from md5 of its id and text. Words are
summed by source and position bucket; the bucket in which a source's budget ends is summed again at finer
buckets (12, then 20, then 28 bits), so only boundary buckets are read again and nothing is sorted. A
source ends with one threshold: positions below it are in. Budgets nest: a target over the source's words
takes every document once and those below the threshold once more.

Defined cases: a null text has size 0. Rows equal in id and text share a position and are taken or left
together. A source without words has target 0. The last document is in if that brings the sum nearer to
the target. An empty table gives no rows. Other columns are not read by ``mix``; ``mixed_documents``
returns them unchanged and repeats rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostage.llm.common import BROADCAST_ROWS, read, saved

#: Weights by position in the order of sources, and the share of all words to take (fixed values).
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
#: Bits of the position that each histogram adds.
LEVELS = (12, 20, 28)
BITS = sum(LEVELS)


def words(text: Column) -> Column:
    """Number of runs of bytes other than blanks (0x20, 0x09-0x0D); 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def position(doc_id: Column, text: Column) -> Column:
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    digest = F.md5(F.concat(part(doc_id), F.lit(":"), F.md5(part(text).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """Text that sorts and joins like the source, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sizes: DataFrame) -> DataFrame:
    """(skey, source_size, target) from (skey, size): one row for each source."""
    total = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    ranked = total.withColumn("rank", F.row_number().over(Window.orderBy("skey")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * MAX_REPEAT
    every = Window.partitionBy()
    up = Window.orderBy("ratio", "rank")
    t = (ranked.withColumn("w", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("w"))
         .withColumn("all", F.sum(F.col("source_size").cast("double")).over(every) * SHARE)
         .withColumn("before", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("rest", F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))
         .withColumn("free", F.col("cap") > F.col("level") * F.col("w"))
         .withColumn("n", F.row_number().over(up)))
    final = F.min(F.when(F.col("free"), F.struct("n", "level"))).over(every)["level"]
    return t.withColumn("final", final).select(
        "skey", "source_size", F.least("cap", F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"))


def thresholds(sizes: DataFrame) -> DataFrame:
    """(skey, source_size, target, base, threshold): every document ``base`` times, once more below ``threshold``."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = saved(targets(sizes).withColumn("base", copies.cast("int"))
                  .withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
                  .withColumn("threshold", F.lit(0).cast("bigint")).withColumn("done", F.col("budget") <= 0), "mix-sources")
    small = state.count() <= BROADCAST_ROWS  # one row for each source
    shift = BITS
    for bits in LEVELS:
        shift -= bits
        last = shift == 0
        hint = F.broadcast(state) if small else state
        inside = sizes.join(hint.where(~F.col("done")), "skey").where(
            F.shiftright("pos", shift + bits) == F.shiftright("threshold", shift + bits))
        hist = inside.groupBy("skey", F.shiftright("pos", shift).alias("bucket")).agg(
            F.sum("size").alias("s"), F.first("budget").alias("budget"))
        upto = F.sum("s").over(Window.partitionBy("skey").orderBy("bucket"))
        ends = (hist.withColumn("upto", upto).where(F.col("upto") > F.col("budget")).groupBy("skey")
                .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("s")).alias("before"), "s")).alias("e")))
        more = (F.col("e.before") + F.col("e.s") / 2 <= F.col("budget")).cast("bigint") if last else F.lit(0)
        found = F.col("e").isNotNull()
        state = saved(state.join(ends, "skey", "left").select(
            "skey", "source_size", "target", "base",
            F.when(found, F.col("budget") - F.col("e.before")).otherwise(F.col("budget")).alias("budget"),
            F.when(found, F.shiftleft("e.bucket", shift) + more).when(F.col("done"), F.col("threshold"))
            .otherwise(F.lit(1 << BITS)).alias("threshold"),
            (F.col("done") | ~found).alias("done")), "mix-level")
    return state.select("skey", "source_size", "target", "base", "threshold")


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), source_key(F.col(source)).alias("skey"),
                       words(F.col(text)).alias("size"), position(F.col(doc_id), F.col(text)).alias("pos"))


def _copies() -> Column:
    return F.col("base") + (F.col("pos") < F.col("threshold")).cast("int")


def _with(rows: DataFrame, plan: DataFrame, key: str = "skey") -> DataFrame:
    """Attach each source's row: broadcast while there are few sources, else a shuffle join that AQE may split."""
    return rows.join(F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan, key)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each document: doc_id, size, source_size, target (its source's), copies, taken (words)."""
    sizes = saved(_sizes(docs, doc_id, text, source), "mix-sizes")
    plan = thresholds(sizes)
    return _with(sizes, plan).select("doc_id", "size", "source_size", "target", _copies().alias("copies"),
                                     (F.col("size") * _copies()).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it, with their columns unchanged."""
    sizes = saved(_sizes(docs, doc_id, text, source), "mix-sizes")
    plan = thresholds(sizes).select(F.struct("skey", "base", "threshold").alias("__plan"))
    keyed = docs.withColumn("__key", source_key(F.col(source)))
    rows = keyed.join(F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan, F.col("__key") == F.col("__plan.skey"))
    copies = F.col("__plan.base") + (position(F.col(doc_id), F.col(text)) < F.col("__plan.threshold")).cast("int")
    return (rows.withColumn("__copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
