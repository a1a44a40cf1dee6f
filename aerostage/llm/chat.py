"""Chat formatting (2): quotation linking.

A message's lines are split by quote level (leading ``>`` signs). Consecutive lines of one level form a passage. Lines,
and the sentences and whole text of passages of several lines, are normalised (lower case, blanks collapsed), hashed and
joined to the last earlier message of the conversation that wrote the same as its own; so a re-wrapped quote is found by
its passage. The message that most of the level-1 lines and passages come from is the parent (the later one on a tie).
Where none of level 1 is linked, a line of a deeper level is looked for one level up in the earlier messages, and if no
one quoted it there, in their own text. Roots and depths follow from the parents by pointer doubling, and each message
gets its place in its thread, where every message comes after its parent; the text returned is the message without quotes.

Writers and quotes of a line meet in one ordered window for each conversation, line and range of TURNS turns, with the last
writer of the earlier ranges carried over, so a line that all messages repeat makes no pairs; a very long conversation is
numbered, and its mails are derived, in ranges of turns too, never in one group.

Defined cases: a null or empty text has no lines. A quote that no earlier message of the conversation wrote
links nothing. Blank lines and lines ending in "wrote:" before a quote are not linked. Rows equal in conversation
and turn share parent, root and depth. Null conversation ids form one conversation; null turns come first
and are never a parent. An empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostage.llm.bytetext import strings
from aerostage.llm.common import read, saved, semi_join

_LEVEL = re.compile(r"^((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"\bwrote:\s*$")
_SENTENCE = re.compile(r"(?<=[.!?]) ")
#: Turns numbered, and searched for a line, in one window group.
TURNS = 1_000


def _levelled(text: str | None) -> list[tuple[int, str]]:
    """(level, row without quote signs) of every row but attributions; level 0 is own text."""
    out = []
    rows = (text or "").split("\n")
    for at, row in enumerate(rows):
        m = _LEVEL.match(row)
        if not m and _ATTRIBUTION.search(row) and at + 1 < len(rows) and rows[at + 1].startswith(">"):
            continue
        out.append((m.group(1).count(">"), row[m.end():]) if m else (0, row))
    return out


def split_quotes(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(own text without quotes, [(level, normalised line) of every line with words]); level 0 is own text."""
    rows = _levelled(text)
    return "\n".join(r for level, r in rows if not level).strip("\n"), [(level, " ".join(r.lower().split())) for level, r in rows if r.strip()]


def passages(text: str | None) -> list[tuple[int, str]]:
    """(level, normalised text) of each passage (lines of one level without a blank one between them) and of each of
    its sentences, as far as they are not lines themselves."""
    out = []
    for level, run in groupby(_levelled(text), lambda x: (x[0], not x[1].strip())):
        if level[1]:
            continue
        own = [" ".join(r.lower().split()) for _, r in run]
        whole = " ".join(own)
        out += [(level[0], x) for x in dict.fromkeys([whole, *_SENTENCE.split(whole)]) if x not in own]
    return out


def parse(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) with ``own`` (text without quotes), ``depth_quoted`` and ``lines``
    (level and hash of each line and passage)."""
    def run(batches):
        for batch in batches:
            own, deepest, lines = [], [], []
            for text in strings(batch, "text").to_pylist():
                clean, parts = split_quotes(text)
                own.append(clean)
                deepest.append(max((level for level, _ in parts), default=0))
                lines.append([{"level": level, "line": line} for level, line in [*parts, *passages(text)]])
            kind = pa.list_(pa.struct([("level", pa.int32()), ("line", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(own, pa.string()), pa.array(deepest, pa.int32()), pa.array(lines, kind)],
                                             ["conv_id", "turn", "role", "own", "quote_levels", "lines"])

    kinds = {f.name: f.dataType.simpleString() for f in messages.schema.fields}
    parsed = messages.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, own string, quote_levels int, lines array<struct<level:int,line:string>>")
    return parsed.withColumn("lines", F.transform("lines", lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["line"]).alias("hash"))))


def _lines(parsed: DataFrame) -> DataFrame:
    return parsed.where("turn is not null").select("conv", "turn", F.explode("lines").alias("l")).select("conv", "turn", "l.level", "l.hash")


def _elected(writers: DataFrame, quotes: DataFrame, long: DataFrame, n_long: int) -> DataFrame:
    """(conv, turn, parent) from ``quotes`` (conv, turn, tier, at, hash, n): the votes of the lowest tier that has any go
    to the last earlier turn of ``writers`` (conv, turn, at, hash)."""
    span = F.floor(F.col("turn") / TURNS).alias("range")
    none = lambda kind: F.lit(None).cast(kind)
    rows = writers.select("conv", "hash", "at", "turn", span, F.col("turn").alias("wrote"), none("int").alias("tier"), none("bigint").alias("n")).unionByName(
        quotes.select("conv", "hash", "at", "turn", span, none(writers.schema["turn"].dataType).alias("wrote"), "tier", "n"))
    key = ["conv", "hash", "at"]
    before = F.max("wrote").over(Window.partitionBy(*key, "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    found = rows.withColumn("origin", before).where("tier is not null")
    if n_long:  # the last writer of the earlier ranges
        spans = semi_join(rows, long, ["conv"], n_long).groupBy(*key, "range").agg(F.max("wrote").alias("last"))
        carried = spans.select(*key, "range", F.max("last").over(Window.partitionBy(*key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
        found = found.join(carried.where("carried is not null"), [*key, "range"], "left").withColumn("origin", F.coalesce("origin", "carried"))
    votes = found.where("origin is not null").groupBy("conv", "turn", "tier", "origin").agg(F.sum("n").alias("n"))
    return votes.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("tier"), "n", "origin"))["origin"].alias("parent"))


def parents(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent) of the messages whose quotes are linked."""
    line = _lines(parsed)
    long = parsed.groupBy("conv").agg(F.min("turn").alias("a"), F.max("turn").alias("b")).where(F.floor(F.col("a") / TURNS) < F.floor(F.col("b") / TURNS)).select("conv")
    long = saved(long, "chat-long")
    n_long = long.count()
    written = line.where("level = 0").select("conv", "turn", F.lit(0).alias("at"), "hash").distinct()
    quoted = line.where("level = 1").groupBy("conv", "turn", "hash").agg(F.count(F.lit(1)).alias("n"))
    first = saved(_elected(written, quoted.withColumn("tier", F.lit(1)).withColumn("at", F.lit(0)), long, n_long), "chat-first-level")
    # messages without a linked level 1 go by their deeper levels
    left = saved(parsed.where("quote_levels > 1 and turn is not null").select("conv", "turn", "lines").join(first, ["conv", "turn"], "left_anti"), "chat-deeper")
    if left.isEmpty():
        return first
    deep = _lines(left).where("level > 1").groupBy("conv", "turn", "level", "hash").agg(F.count(F.lit(1)).alias("n"))
    sought = deep.select("conv", "turn", "hash", "n", F.explode(F.array(
        F.struct(F.lit(1).alias("tier"), (F.col("level") - 1).alias("at")), F.struct(F.lit(2).alias("tier"), F.lit(0).alias("at")))).alias("s"))
    convs = saved(left.select("conv").distinct(), "chat-deeper-conversations")
    writers = semi_join(line, convs, ["conv"], convs.count()).select("conv", "turn", F.col("level").alias("at"), "hash").distinct()
    second = _elected(writers, sought.select("conv", "turn", "hash", "n", "s.tier", "s.at"), long, n_long)
    return first.unionByName(second)


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every linked message, by pointer doubling. Only messages whose root is still
    a reply itself go into the next round, so one long thread costs the others no rounds."""
    active = saved(links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")), "chat-links")
    ended: list[DataFrame] = []
    while True:
        known = reduce(DataFrame.unionByName, ended, active)
        up = known.select("conv", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = active.join(up, ["conv", "root"], "left")
        step = saved(joined.select("conv", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                   F.col("next").isNotNull().alias("moved")), "chat-threads")
        ended.append(step.where("not moved").drop("moved"))
        active = step.where("moved").drop("moved")
        if active.isEmpty():
            return reduce(DataFrame.unionByName, ended)


def link_quotes(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, parent_turn, root_turn, depth, position (in its thread, from 0), quote_levels, text."""
    rows = messages.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parsed = saved(parse(rows).withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), "chat-parsed")
    links = saved(parents(parsed), "chat-parents")
    tree = threads(links).join(links, ["conv", "turn"])
    out = parsed.drop("lines").join(tree, ["conv", "turn"], "left").withColumn("root", F.coalesce("root", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
    out = saved(out.withColumn("range", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / TURNS)), "chat-rows")
    counts = out.groupBy("conv", "root", "range").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("conv", "root").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select(F.col("conv").alias("sc"), F.col("root").alias("sr"), F.col("range").alias("sg"), F.coalesce(before, F.lit(0)).alias("shift"))
    at = F.row_number().over(Window.partitionBy("conv", "root", "range").orderBy("turn", "own", "role")) - 1
    same = (F.col("conv") == F.col("sc")) & F.col("root").eqNullSafe(F.col("sr")) & (F.col("range") == F.col("sg"))
    return out.withColumn("at", at).join(shift, same).select(
        "conv_id", "turn", "role", F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"), "depth",
        (F.col("at") + F.col("shift")).cast("bigint").alias("position"), "quote_levels", F.col("own").alias("text"))


def as_mail(conversations: DataFrame) -> DataFrame:
    """The conversations as a mail thread that Spark derives from them: every message quotes the turn before
    it, and that one's quotation of the turn before, with nested quote signs. Turns before are looked up in ranges of
    TURNS turns; the first two of a range get the last two texts of the ranges before it."""
    quote = lambda c, sign: F.when(F.length(c) > 0, F.concat(F.lit(sign), F.regexp_replace(c, "\n", f"\n{sign}")))
    rows = conversations.select("conv_id", "turn", "role", "text", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))).alias("range"))
    w = Window.partitionBy("conv_id", "range").orderBy("turn")
    near = rows.select("*", F.lag("text", 1).over(w).alias("one"), F.lag("text", 2).over(w).alias("two"), F.row_number().over(w).alias("at"))
    long = saved(rows.groupBy("conv_id").agg(F.min("range").alias("a"), F.max("range").alias("b")).where("a < b").select(F.col("conv_id").alias("c")), "chat-long-mail")
    if not long.isEmpty():
        size = F.count(F.lit(1)).over(Window.partitionBy("conv_id", "range"))
        ends = near.withColumn("size", size).join(long, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").where("at > size - 2")
        tails = ends.groupBy("conv_id", "range").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]).alias("tail"))
        v = Window.partitionBy("conv_id").orderBy("range")
        none = F.array().cast("array<string>")
        carried = tails.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.concat(
            F.coalesce(F.lag("tail", 2).over(v), none), F.coalesce(F.lag("tail", 1).over(v), none)).alias("past"))
        back = lambda k: F.when(F.size("past") >= k, F.element_at("past", -k))
        near = near.join(carried, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")), "left").select(
            "conv_id", "turn", "role", "text", F.when(F.col("at") > 1, F.col("one")).otherwise(back(1)).alias("one"),
            F.when(F.col("at") > 2, F.col("two")).when(F.col("at") == 2, back(1)).otherwise(back(2)).alias("two"))
    return near.select(
        "conv_id", "turn", "role", F.concat_ws("\n", quote(F.col("two"), "> > "), quote(F.col("one"), "> "), F.col("text")).alias("text"))


def op2_chat_quotes(spark, sf_dir: str) -> DataFrame:
    return link_quotes(as_mail(read(spark, sf_dir, "conversations")))
