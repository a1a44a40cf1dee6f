"""Best-fit packing (3): documents become token pieces, pieces become sequences of bounded length.

Tokens: byte-level BPE of the given vocabulary file (``bpe``), then the end id.

Packing: full pieces are sequences of their own. The others are spread by hash over blocks of about
BLOCK pieces; each block is packed best-fit decreasing with a segment tree over remaining capacities, which
finds the tightest open sequence in logarithmic time. A block leaves one poorly filled sequence at most.

Defined cases: a null or empty text is one piece holding the end id. Repeated rows (and ids) are packed
each for itself; equal rows are interchangeable. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bpe import encode_texts
from aerostage.llm.bytetext import slices, strings
from aerostage.llm.common import read, saved

LENGTH = 1024
END = 2
#: Pieces packed together in one task.
BLOCK = 16_384
#: Bytes of text encoded together.
SLICE = 2 << 20

def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           length: int = LENGTH, end: int = END) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids (binary). Only documents longer than
    ``length`` are cut, into pieces of ``length`` tokens of which the first may be shorter."""
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts, ids = strings(batch, "text"), batch.column(0)
            for lo, hi in slices(texts, SLICE):
                tokens, bounds = encode_texts(texts.slice(lo, hi - lo), vocabulary)
                n = np.diff(bounds) + 1  # and the end id
                tokens = np.insert(tokens.astype("<u4"), bounds[1:], end)
                count = -(-n // length)
                source = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
                stop = n[source] - length * (count[source] - 1 - piece)
                start = np.maximum(0, stop - length)
                offsets = np.r_[0, np.cumsum(stop - start)].astype(np.int32) * np.int32(4)
                data = pa.Array.from_buffers(pa.binary(), len(source), [None, pa.py_buffer(offsets), pa.py_buffer(tokens)])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(lo + source)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(stop - start, pa.int64()), data], ["doc_id", "piece", "start", "length", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


class Capacities:
    """Segment tree over remaining capacities: which of them open sequences have."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        at = capacity + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out an open sequence with the least capacity of at least ``need``: (capacity, sequence)."""
        tree, at = self.any, need + self.size
        while not tree[at]:  # climb until a right neighbour has something, then go down on its left
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the right end of a level
                return None
            if not tree[at]:
                continue
        while at < self.size:
            at = 2 * at if tree[2 * at] else 2 * at + 1
        capacity = at - self.size
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            while at and not (at < self.size and (tree[2 * at] or tree[2 * at + 1])):
                tree[at] = 0
                at >>= 1
        return capacity, sequence


def best_fit(lengths, length: int = LENGTH) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each piece; ``lengths`` in descending order."""
    tree, count, sequences, offsets = Capacities(length), 0, [], []
    for need in lengths:
        need = int(need)
        if found := tree.tightest(need):
            capacity, sequence = found
        else:
            capacity, sequence, count = length, count, count + 1
        sequences.append(sequence)
        offsets.append(length - capacity)
        if capacity > need:
            tree.put(capacity - need, sequence)
    return sequences, offsets


def place(rows: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset to pieces (any columns with doc_id, piece and length; read more than once,
    so hand over a written table). Full pieces get negative sequence ids."""
    full = F.col("length") >= length
    number = -1 - F.monotonically_increasing_id()
    whole = rows.where(full).withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("bigint"))
    part = rows.where(~full)
    blocks = max(1, -(-part.count() // block))
    spread = part.withColumn("__block", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    names = [*rows.columns, "sequence_id", "offset"]

    def run(key, table):
        table = table.sort_by([("length", "descending")])
        seq, off = best_fit(table.column("length").to_pylist(), length)
        base = np.int64(key[0].as_py()) << np.int64(32)
        table = table.drop_columns(["__block"])
        return (table.append_column("sequence_id", pa.array(np.array(seq, np.int64) + base))
                .append_column("offset", pa.array(off, pa.int64()))).select(names)

    return spread.groupBy("__block").applyInArrow(run, whole.schema).unionByName(whole)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         length: int = LENGTH, end: int = END) -> DataFrame:
    """Placed pieces with their ids."""
    return place(saved(pieces(docs, doc_id, text, vocabulary, length, end), "pack-pieces"), length)


def sequences(placed: DataFrame) -> DataFrame:
    """The training sequences themselves: sequence_id and the ids of its pieces in order (binary); a
    sequence has ``length`` ids at most, which bounds each group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def digests(docs: DataFrame) -> DataFrame:
    """Placed pieces with the crc32 of their ids in the ids' place; ids are dropped before anything is written."""
    rows = pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(saved(rows, "pack-digests")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
