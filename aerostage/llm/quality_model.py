"""Quality classifier (1): histogram gradient-boosted trees over document statistics.

Spark computes the statistics of the labelled training documents and, in scoring, of every document. The
trees are grown on the driver from a bounded sample (about SAMPLE_ROWS labelled rows, chosen by a hash of
the id: SAMPLE_ROWS x len(FEATURES) numbers), then flattened into arrays and walked for a whole batch at
once, one numpy step for each tree level.

Defined cases: a null or empty text has all statistics 0 and gets a score like any other. Rows with null ids
are scored, not learned from, and not held out. With no labels, or labels of one kind, the score is the share
of label 1 (0.5 without labels). Repeated rows are scored each. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import Texts, slices, strings
from aerostage.llm.common import fold, read
from aerostage.llm.quality_rules import _BANG, _LETTER, _SYMBOL, _UPPER, base_figures

SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
TREES, DEPTH, BINS, RATE, LEAST_ROWS, RIDGE = 60, 5, 64, 0.2, 20, 1.0

FEATURES = ["log_bytes", "log_words", "word_chars", "capitals", "digits", "symbols", "bangs", "stops", "commas", "quotes", "slashes",
            "lines", "dup_lines", "distinct_words", "repeat_words", "top_word", "non_ascii", "lettered", "short_words", "long_words"]


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT, _STOP, _COMMA, _QUOTE, _SLASH = (_table(x) for x in (b"0123456789", b".", b",;:", b"\"'()-", b"/@=_\\+~^{}[]"))


def statistics(t: Texts) -> np.ndarray:
    """One row of FEATURES for each text."""
    f = base_figures(t)
    starts, ends, text = t.words()
    words, size = np.maximum(f["n_words"], 1), np.maximum(np.diff(t.off), 1)
    count = lambda flags: t.per_text(flags[t.b])
    upper = count(_table(bytes(range(65, 91))))
    cased = np.maximum(upper + count(_table(bytes(range(97, 123)))), 1)
    distinct, top = np.zeros(t.n), np.zeros(t.n)
    if len(text):
        key = np.sort((text.astype(np.uint64) << np.uint64(48)) | (t.word_hash() >> np.uint64(16)))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        owner = (key[first] >> np.uint64(48)).astype(np.int64)
        distinct = np.bincount(owner, minlength=t.n)
        np.maximum.at(top, owner, np.diff(np.r_[first, len(key)]))
    total = np.r_[0, np.cumsum(_LETTER[t.b])]
    by_word = lambda flags: np.bincount(text[flags], minlength=t.n)
    return np.column_stack([
        np.log1p(np.diff(t.off)), np.log1p(f["n_words"]), f["word_chars"] / words, upper / cased, count(_DIGIT) / size, f["n_symbols"] / words,
        count(_BANG) / words, count(_STOP) / words, count(_COMMA) / words, count(_QUOTE) / words, count(_SLASH) / words,
        f["n_lines"] / words, f["n_dup_lines"] / np.maximum(f["n_lines"], 1), distinct / words, f["n_repeat_words"] / words, top / words,
        t.per_text(t.b >= 128) / size, by_word(total[ends] > total[starts]) / words, by_word(ends - starts <= 2) / words, by_word(ends - starts >= 12) / words,
    ]).astype(np.float32)


@dataclass
class Trees:
    """Complete binary trees: node k of a level has children 2k+1 and 2k+2; ``leaf`` holds the last level."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # go right where the value is above
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the log loss; split search over BINS quantile bins of each feature."""
    n, width = x.shape
    share = float(y.mean()) if n else 0.5
    none = Trees(float(np.log(share / (1 - share))) if 0 < share < 1 else (6.0 if share == 1 else -6.0), *(np.zeros((0, 1)),) * 3)
    if not n or not 0 < share < 1:
        return none
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    usable = np.array([[b < len(edges[f]) for b in range(BINS)] for f in range(width)])
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    margin = np.full(n, none.base)
    out = []
    flat = binned + np.arange(width) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            hist = lambda w: np.bincount(at, None if w is None else np.repeat(w, width), many * width * BINS).reshape(many, width, BINS).cumsum(2)
            gl, hl, cl = hist(g), hist(h), hist(None)
            gt, ht, ct = gl[:, :1, -1:], hl[:, :1, -1:], cl[:, :1, -1:]
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain[(cl < LEAST_ROWS) | (ct - cl < LEAST_ROWS) | ~usable[None]] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6:
                    feature[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        spot = node - inner
        leaf = -RATE * np.bincount(spot, g, leaves) / (np.bincount(spot, h, leaves) + RIDGE)
        margin += leaf[spot]
        out.append((feature, cut, leaf))
    return Trees(none.base, *(np.array(v) for v in zip(*out)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, y): about ``rows`` labelled rows outside the held-out fold, whole texts, one for each id: of
    contradicting labels the largest, of several texts the least. The chosen ids are broadcast; their number, and so
    that of the rows, is bounded by ``rows`` (a hash threshold), whatever the size of ``labels`` and ``docs``."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT)).groupBy("id").agg(F.max("y").alias("y"))
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text") -> Trees:
    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                x = statistics(Texts(texts.slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.string()), batch.column(2).slice(lo, hi - lo), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))],
                    ["doc_id", "y", "x"])

    got = labelled_sample(docs, labels, label, rows, doc_id, text).mapInArrow(run, "doc_id string, y int, x array<float>").toArrow()
    got = got.sort_by([("doc_id", "ascending")])  # the same trees whatever order the tasks end in
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if len(got) else np.zeros((0, len(FEATURES)), np.float32)
    return grow(x, got.column("y").to_numpy().astype(float))


def score_quality(docs: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                score = trees.score(statistics(Texts(texts.slice(lo, hi - lo))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score)], ["doc_id", "score"])

    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))


def op1_quality_model(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return score_quality(docs, fit(docs, labels))
