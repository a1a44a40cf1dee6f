"""Sharding (7): Karmarkar-Karp differencing over indivisible groups of equal texts.

A group (equal texts) weighs its rows times their size. Differencing keeps partial partitions - one sum for
each shard - and repeatedly combines the two with the largest spread, the largest sum of one with the
smallest of the other. Groups are hashed into blocks of about BLOCK; each block is differenced in one
task and ends as one partial partition; the blocks' partitions are differenced in turn, until one is left.
A level divides the number of units by BLOCK, so no task, and never the driver, sees all groups.

Defined cases: a null text has size 1 (no bytes, plus 1) and forms one group with the empty texts. Rows with
the same id are separate rows; null ids are kept. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostage.llm.common import read, saved

SHARDS = 8
#: Units (groups, or blocks of the level below) differenced in one task.
BLOCK = 8_192
#: Rows numbered in one window group.
SLOT_ROWS = 50_000


def difference(units: list[list[int]]) -> list[list[int]]:
    """Karmarkar-Karp: for each unit (its sum in each of k places) the final place of each of its places."""
    sums, joined, heap = [], [], []
    for i, u in enumerate(units):
        order = sorted(range(len(u)), key=lambda p: (-u[p], p))
        sums.append([u[p] for p in order])
        joined.append(order)
        heap.append((sums[i][-1] - sums[i][0], i))
    heapq.heapify(heap)
    k = len(units[0])
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        pairs = [(x + y, p, k - 1 - p) for p, (x, y) in enumerate(zip(sums[a], reversed(sums[b])))]
        pairs.sort(key=lambda q: (-q[0], q[1]))
        sums[a] = sums[b] = None
        sums.append([q[0] for q in pairs])
        joined.append((a, b, pairs))
        heapq.heappush(heap, (pairs[-1][0] - pairs[0][0], len(sums) - 1))
    place = {heap[0][1]: list(range(k))}
    out: list[list[int]] = [[]] * len(units)
    for node in range(len(joined) - 1, -1, -1):
        mine = place.pop(node)
        if node < len(units):
            final = [0] * k
            for at, p in enumerate(joined[node]):
                final[p] = mine[at]
            out[node] = final
            continue
        a, b, pairs = joined[node]
        left, right = [0] * k, [0] * k
        for at, (_, p, q) in enumerate(pairs):
            left[p], right[q] = mine[at], mine[at]
        place[a], place[b] = left, right
    return out


def _level(units: DataFrame, shards: int, block: int) -> DataFrame:
    """(unit, up, places) for units (unit, up, sums): ``places[i]`` is where place i of the unit goes in block ``up``."""

    def run(table):
        table = table.sort_by([("unit", "ascending")])
        places = difference(table.column("sums").to_pylist())
        return pa.table({"unit": table.column("unit"), "up": table.column("up"), "sums": table.column("sums"),
                         "places": pa.array(places, pa.list_(pa.int32()))})

    return units.groupBy("up").applyInArrow(run, "unit string, up bigint, sums array<bigint>, places array<int>")


def balance(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """(unit, shard) for groups (unit string, weight bigint)."""
    zeros = [F.lit(0).cast("bigint")] * (shards - 1)
    units = groups.select("unit", F.array(F.col("weight").cast("bigint"), *zeros).alias("sums"))
    n, levels = groups.count(), []
    while True:
        blocks = max(1, -(-n // block))
        up = F.pmod(F.xxhash64("unit"), F.lit(blocks)).cast("bigint")
        done = saved(_level(units.select("unit", up.alias("up"), "sums"), shards, block), "shard-level")
        levels.append(done)
        if blocks == 1:
            break
        each = F.posexplode(F.arrays_zip("sums", "places"))
        merged = (done.select("up", each).groupBy("up", F.col("col.places").alias("p")).agg(F.sum("col.sums").alias("s"))
                  .groupBy("up").agg(F.sort_array(F.collect_list(F.struct("p", "s"))).alias("ps")))  # one entry for each shard
        units = saved(merged.select(F.col("up").cast("string").alias("unit"), F.col("ps.s").alias("sums")), "shard-units")
        n = blocks
    out = levels[0].select("unit", "up", F.element_at("places", 1).alias("place"))  # a group sits in its first place
    for above in levels[1:]:
        above = above.select(F.col("unit").alias("__unit"), F.col("up").alias("__up"), "places")
        out = out.join(above, F.col("up").cast("string") == F.col("__unit")).select(
            "unit", F.col("__up").alias("up"), F.element_at("places", F.col("place") + 1).alias("place"))
    return out.select("unit", F.col("place").alias("shard"))


def numbered(rows: DataFrame, by: str, order: list[str], name: str, per_window: int = SLOT_ROWS) -> DataFrame:
    """Gapless numbers from 0 in each ``by``: rows are numbered in hash buckets of about ``per_window`` and
    shifted by the counts of the buckets before."""
    buckets = max(1, -(-rows.count() // per_window))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = rows.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select(by, "__bucket", F.coalesce(before, F.lit(0)).alias("__shift"))
    at = F.row_number().over(Window.partitionBy(by, "__bucket").orderBy(*order)) - 1
    return (rows.withColumn("__at", at).join(shift, [by, "__bucket"])
            .withColumn(name, (F.col("__at") + F.col("__shift")).cast("bigint")).drop("__at", "__shift", "__bucket"))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null under this law)."""
    value = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = saved(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(value).cast("bigint") + 1).alias("size"),
                             F.crc32(value).alias("text_crc32"), F.md5(value).alias("unit")), "shard-rows")
    groups = rows.groupBy("unit", "size").agg(F.count(F.lit(1)).alias("n")).select("unit", (F.col("n") * F.col("size")).alias("weight"))
    placed = saved(rows.join(balance(groups, shards, block), "unit"), "shard-placed")
    return numbered(placed, "shard", ["doc_id", "unit"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
