"""Periodic run detection (11): maximal repetitions of words, by Kruskal on descending common prefixes.

The suffixes of a text's words are ordered by prefix doubling; the ranks of every doubling step give the common
prefix (LCP) of neighbours in that order. Suffix classes are then united by decreasing LCP with a union-find whose sets
keep their positions in order. Two positions p < q that become neighbours of one set at LCP l, with q - p <= l,
are a seed: words p .. q + l - 1 have the smallest period q - p (no position between them repeats the same l words),
and nothing more to the right. The seed whose left neighbours differ is a whole run; the others are later pieces of it.
Unions of equal LCP count as one step, so a seed must still be neighbours after the last of them.

A run of length >= max(LEAST_LENGTH, LEAST_POWERS * period) has a seed of LCP >= length - period, so only suffixes
whose first LEAST_LCP words repeat inside their text are ever united: a bound that drops no run.

Texts are independent: one pass without a shuffle. A text needs about 4 bytes for each word and doubling step,
the steps being the logarithm of its longest repeat, and about 30 bytes for each byte of the text in all.

Defined cases: null, empty and blank texts have no words, no run and an empty collapsed text. Repeated rows and
equal or null ids are reported each; a null id has no checksum, so its text is never edited by the query. Other
columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import Texts, slices, strings
from aerostage.llm.common import read

LEAST_LENGTH, LEAST_POWERS = 6, 4
#: Least LCP of a seed of such a run: length - period is 5 for period 1 and grows with the period.
LEAST_LCP = LEAST_LENGTH - 1
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def neighbours(word: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, LCP) of neighbouring suffixes of one text with LCP >= LEAST_LCP.

    ``word`` is any number equal for equal words, ``text`` the ascending text of each word, ``end`` its text's end.
    """
    n = len(word)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none
    order = np.lexsort((word, text))
    new = np.r_[True, (word[order][1:] != word[order][:-1]) | (text[order][1:] != text[order][:-1])]
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(new)
    rank[order] = first[np.cumsum(new) - 1]
    ranks, size = [rank.astype(np.int32 if n < 1 << 31 else np.int64)], 1
    slots = np.flatnonzero(~(new & np.r_[new[1:], True]))  # places in the order whose class has more suffixes
    live = None
    while len(slots):
        if size == 4:  # from here on only classes that repeat four words are left
            live = slots
        at = order[slots]
        ahead = at + size
        inside = ahead < end[at]
        follow = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        key = np.lexsort((follow, rank[at]))
        at, follow, old = at[key], follow[key], rank[at][key]
        order[slots] = at
        new = np.r_[True, (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])]
        rank = rank.copy()
        rank[at] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        size *= 2
        ranks.append(rank.astype(ranks[0].dtype))
        slots = slots[~(new & np.r_[new[1:], True])]
    if live is None or not len(live):
        return none, none, none
    pair = live[:-1][np.diff(live) == 1]
    x, y = order[pair], order[pair + 1]
    same = ranks[2][x] == ranks[2][y]
    x, y = x[same], y[same]
    a, b, lcp = x.copy(), y.copy(), np.zeros(len(x), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        fits = (a < end[x]) & (b < end[y])
        eq = fits & (ranks[level][np.where(fits, a, 0)] == ranks[level][np.where(fits, b, 0)])
        step = eq.astype(np.int64) << level
        a, b, lcp = a + step, b + step, lcp + step
    keep = lcp >= LEAST_LCP
    return x[keep], y[keep], lcp[keep]


def seeds(x: list[int], y: list[int], lcp: list[int]) -> list[tuple[int, int, int]]:
    """(p, q, LCP) of the positions that become neighbours at an LCP that makes a run long enough.
    The lists hold one text's suffix pairs by descending LCP."""
    parent: dict[int, int] = {}
    sets: dict[int, list[int]] = {}

    def find(i: int) -> int:
        up = parent.setdefault(i, i)
        while up != parent[up]:
            parent[up] = up = parent[parent[up]]
        parent[i] = up
        return up

    found, level = [], []

    def settle() -> None:
        for p, q, l in level:
            own = sets[find(p)]
            at = bisect_left(own, p)
            if at + 1 < len(own) and own[at + 1] == q:
                found.append((p, q, l))
        level.clear()

    before = -1
    for i, j, l in zip(x, y, lcp):
        if l != before:
            settle()
            before = l
        i, j = find(i), find(j)
        a, b = sets.get(i) or [i], sets.get(j) or [j]
        if len(a) < len(b):
            i, j, a, b = j, i, b, a
        last = -1
        for k, p in enumerate(b):  # the smaller set's positions, ascending, into the gaps of the larger one
            at = bisect_left(a, p)
            if at and (low := a[at - 1]) > last and p - low <= l and p - low + l >= max(LEAST_LENGTH, LEAST_POWERS * (p - low)):
                level.append((low, p, l))
            if at < len(a):
                high = a[at]
                if (k + 1 == len(b) or b[k + 1] > high) and high - p <= l and high - p + l >= max(LEAST_LENGTH, LEAST_POWERS * (high - p)):
                    level.append((p, high, l))
            last = p
        if len(b) < 16:
            for p in b:
                insort(a, p)
        else:
            a += b
            a.sort()  # two ascending runs: one linear merge
        parent[j] = i
        sets[i] = a
        sets.pop(j, None)
    settle()
    return found


def find_runs(word: np.ndarray, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period; ``bounds`` are the texts' word bounds."""
    end = bounds[1:][text]
    x, y, lcp = neighbours(word, text, end)
    order = np.lexsort((-lcp, text[x]))
    x, y, lcp = x[order], y[order], lcp[order]
    owner = text[x]
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(x) else np.zeros(1, np.int64)
    rows = []
    for lo, hi in zip(cut[:-1], cut[1:]):
        t = owner[lo]
        first = bounds[t]
        for p, q, l in seeds(x[lo:hi].tolist(), y[lo:hi].tolist(), lcp[lo:hi].tolist()):
            if p == first or word[p - 1] != word[q - 1]:
                rows.append((t, p - first, q - p + l, q - p))
    got = np.array(sorted(rows, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)
    return got[:, 0], got[:, 1], got[:, 2], got[:, 3]


def _collapse(raw: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    words = raw.split()
    if len(start):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        words = [words[i] for i in kept.tolist()]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, runs (start, length and period in words, by start and period) and the collapsed text: its words
    joined by one blank, without those that lie in a run after the run's first period."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(strings(batch, "text"), "")
            for lo, hi in slices(texts):
                part = texts.slice(lo, hi - lo)
                t = Texts(part)
                owner = t.words()[2]
                got, start, length, period = find_runs(t.word_hash(), owner, np.searchsorted(owner, np.arange(t.n + 1)))
                cut = np.searchsorted(got, np.arange(t.n + 1))
                raw = t.b.tobytes()
                out = []
                for i in range(t.n):
                    own = slice(cut[i], cut[i + 1])
                    out.append(_collapse(raw[t.off[i]:t.off[i + 1]], start[own], length[own], period[own]))
                found = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), found), pa.array(out, pa.string())],
                    ["doc_id", "runs", "collapsed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, text): every tenth document by checksum of its id gets a periodic tail, as the contract states."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", h.alias("h"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(strings(batch, "text"), "")
            hashes = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                part = texts.slice(lo, hi - lo)
                t = Texts(part)
                n = t.word_counts()
                raw, out = t.b.tobytes(), []
                for i in range(t.n):
                    own, key = raw[t.off[i]:t.off[i + 1]], hashes[lo + i]
                    if key is not None and key % 10 == 0 and n[i]:
                        words, g = own.split(), key // 10
                        a = g % len(words)
                        p = 1 + (len(words) - a) // (3 + g % 8)
                        tail = words[a:a + p]
                        own = b" ".join(words[:a] + (tail * (-(-(len(words) - a) // p)))[:len(words) - a])
                    out.append(own.decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(out, pa.string())],
                                                 ["doc_id", "n_words", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, text string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.concat_ws("\n", line), F.lit("\n"))).otherwise("")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("__best.before")).alias("start"), F.col("__best.length").alias("length"),
        (-F.col("__best.less")).alias("period"), F.expr("1000 * __best.length div -__best.less").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
