"""Toxicity (8): votes of the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are the whole words of the lower-cased text, of any length, with their digits, and beside them byte 5-grams of
its letters, so a word and its inflections share terms too. The vocabulary is every term of the labelled sample that
marks one class (in LEAST_DOCS documents, by odds and chi-square against the other class), however many these are.
Examples are the labelled sample itself (about TOXIC_ROWS and OTHER_ROWS rows, chosen by a hash of the id), sorted by
their heaviest term and cut into blocks of BLOCK; for each term and block that has it the index knows the largest
weight. A query sums these into an upper bound for each block and scores blocks in descending order until the
bound of the next is below the k-th best cosine, so the neighbours are exact. Their labels vote with weight cosine
squared, with a prior of PRIOR votes at the base rate; a text without any term gets the toxic share of the
examples without terms. ``evidence`` lists the nearest examples' ids.

Spark counts terms and builds the examples' vectors; the driver gets the vocabulary and the examples' sparse
vectors, both bounded by the sample.

Defined cases: null and empty texts have no terms. Rows with null ids are scored, not learned from, and not
held out; ids may be of any type. Of contradicting labels of one id the largest counts, of several texts of one id
the least. Without labels, or with one kind, every score is the toxic share (0 without labels). Repeated rows
are scored each; neighbours at equal cosine are taken in index order. Other columns are not read, whatever their
names. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import U64, Texts, slices, strings
from aerostage.llm.common import fold, read, saved

FOLDS, HELD_OUT = 5, 0
CUT = 0.5
#: Bounds of the labelled sample: toxic rows, other rows.
TOXIC_ROWS, OTHER_ROWS = 6_000, 14_000
LEAST_DOCS, LEAST_ODDS, LEAST_CHI = 5, 4.0, 15.0
NEIGHBOURS, BLOCK, PRIOR = 15, 64, 0.5
EVIDENCE = 3
GRAM = 5

_LETTERS = np.full(256, 32, np.uint8)  # other signs become blanks
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_WORDS = _LETTERS.copy()
_WORDS[48:58] = np.arange(48, 58)
#: Set in the number of a whole word; a 5-gram fills 40 bits.
_WORD = U64(1 << 63)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text of each 5-gram, gram as an integer, number of texts); grams have one blank at most, at an end."""
    padded = pc.binary_join_element_wise("", pc.utf8_lower(pc.fill_null(texts, "")), "    ", " ")
    t = Texts(padded.cast(pa.string()), _LETTERS)
    n = max(0, len(t.b) - GRAM + 1)
    g = np.zeros(n, np.uint64)
    for k in range(GRAM):
        g |= t.b[k:n + k].astype(np.uint64) << U64(8 * k)
    blank = np.r_[0, np.cumsum(t.b == 32)]
    ok = blank[GRAM - 1:n + GRAM - 1] - blank[1:n + 1] == 0  # no blank inside
    ok &= blank[GRAM:n + GRAM] - blank[:n] <= 1
    at = np.flatnonzero(ok)
    text = np.searchsorted(t.off, at, "right") - 1
    inside = at + GRAM <= t.off[1:][text]
    return text[inside], g[at[inside]], t.n


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text of each term, term as an integer, number of texts): 5-grams and whole words."""
    text, g, n = grams(texts)
    t = Texts(pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.string()), _WORDS)
    return np.concatenate([text, t.words()[2]]), np.concatenate([g, t.word_hash() | _WORD]), n


@dataclass
class Index:
    """Vocabulary and block-max inverted index over the examples that have a term.

    A cell is a term in a block that has it; a term's cells and a cell's postings lie between neighbouring bounds.
    """

    terms: np.ndarray  # ascending
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    cells: np.ndarray  # (terms + 1): bounds of a term's cells
    cell_block: np.ndarray
    cell_max: np.ndarray
    posts: np.ndarray  # (cells + 1): bounds of a cell's postings
    post_doc: np.ndarray
    post_weight: np.ndarray
    base: float  # toxic share of all examples
    without: float  # and of those without a term

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest, best first; ties in index order."""
        many = self.cells[term + 1] - self.cells[term]
        cell = np.repeat(self.cells[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        w = np.repeat(weight, many)
        by_block = np.argsort(self.cell_block[cell], kind="stable")
        cell, w = cell[by_block], w[by_block]
        block = self.cell_block[cell]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(block)]
        bound = np.add.reduceat(w * self.cell_max[cell], first) if len(first) else np.zeros(0)
        order = np.argsort(-bound, kind="stable")
        best_doc, best = np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(order), 4):
            chosen = order[at:at + 4]
            kth = best[k - 1] if len(best) >= k else 0.0
            chosen = chosen[bound[chosen] >= kth - 1e-9]
            if not len(chosen):
                break
            own = np.concatenate([np.arange(first[c], last[c]) for c in chosen])
            lo, size = self.posts[cell[own]], self.posts[cell[own] + 1] - self.posts[cell[own]]
            place = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            doc, at_doc = np.unique(self.post_doc[place], return_inverse=True)
            sums = np.bincount(at_doc, np.repeat(w[own], size) * self.post_weight[place], len(doc))
            best_doc = np.concatenate([best_doc, doc])
            best = np.concatenate([best, sums])
            keep = np.lexsort((best_doc, -np.round(best, 9)))[:k]
            best_doc, best = best_doc[keep], best[keep]
        return best_doc, np.minimum(best, 1.0)

    def vectors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bounds of each text, term, weight): L2-normalised TF-IDF over the vocabulary, logarithmic counts."""
        text, g, n = terms(texts)
        if not len(self.terms):
            return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.searchsorted(self.terms, g)
        found = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == g)
        key, count = np.unique(text[found] * len(self.terms) + at[found], return_counts=True)
        text, term = key // len(self.terms), key % len(self.terms)
        w = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(text, w * w, n))
        return np.searchsorted(text, np.arange(n + 1)), term, w / norm[text]

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list]]:
        bounds, term, weight = self.vectors(texts)
        out, evidence = np.full(len(bounds) - 1, self.without), [[] for _ in range(len(bounds) - 1)]
        for i in np.flatnonzero(np.diff(bounds) > 0):
            own = slice(bounds[i], bounds[i + 1])
            doc, cosine = self.nearest(term[own], weight[own])
            vote = cosine**2
            out[i] = (vote @ self.toxic[doc] + PRIOR * self.base) / (vote.sum() + PRIOR)
            evidence[i] = [self.ids[d] for d in doc[:EVIDENCE].tolist()]
        return np.clip(out, 0, 1), evidence


def build_index(terms: np.ndarray, idf: np.ndarray, ids: list, toxic: np.ndarray, bounds: np.ndarray, term: np.ndarray, weight: np.ndarray) -> Index:
    """Index over examples given as sparse rows, in the order of their ids."""
    has = np.diff(bounds) > 0
    row = np.repeat(np.arange(len(ids)), np.diff(bounds))
    heavy = np.full(len(ids), -1)
    order = np.lexsort((-weight, row))
    first = np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]]) if len(row) else np.zeros(0, np.int64)
    heavy[row[order][first]] = term[order][first]
    ranked = np.argsort(heavy, kind="stable")
    ranked = ranked[has[ranked]]
    new = np.full(len(ids), -1)
    new[ranked] = np.arange(len(ranked))
    doc = new[row]
    order = np.lexsort((doc, term))
    doc, term, weight = doc[order], term[order], weight[order]
    cell = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] // BLOCK != doc[:-1] // BLOCK)]) if len(doc) else np.zeros(0, np.int64)
    top = np.maximum.reduceat(weight, cell) if len(cell) else np.zeros(0)
    base = float(toxic.mean()) if len(toxic) else 0.0
    without = float(toxic[~has].mean()) if (~has).any() else base
    return Index(terms, idf, [ids[r] for r in ranked.tolist()], toxic[ranked].astype(float), np.searchsorted(term[cell], np.arange(len(terms) + 1)),
                 doc[cell] // BLOCK, top, np.r_[cell, len(doc)], doc, weight, base, without)


def examples(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str = "toxic") -> DataFrame:
    """(doc_id, text, y): labelled rows outside the held-out fold, about TOXIC_ROWS and OTHER_ROWS of them by a
    hash of the id, one row for each id; the chosen ids are broadcast, their number being bounded by these parameters."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT)).groupBy("id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each label
    share = lambda y, most: int(min(1.0, most / max(n.get(y, 0), 1)) * (1 << 20))
    limit = F.when(F.col("y") == 1, F.lit(share(1, TOXIC_ROWS))).otherwise(F.lit(share(0, OTHER_ROWS)))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < limit)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def vocabulary(sample: DataFrame, toxic: int, other: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, idf) that mark one class, by document counts; those of the sample, which bounds them, reach the driver."""
    def run(batches):
        keys, n = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        for batch in batches:
            texts, label = strings(batch, "text"), batch.column(2).to_numpy()
            for lo, hi in slices(texts):
                text, g, _ = terms(texts.slice(lo, hi - lo))
                order = np.lexsort((g, text))
                text, g = text[order], g[order]
                first = np.r_[True, (g[1:] != g[:-1]) | (text[1:] != text[:-1])] if len(g) else np.zeros(0, bool)
                y = label[lo:hi][text[first]]
                both, at = np.unique(np.concatenate([keys, g[first]]), return_inverse=True)
                old, new = at[:len(keys)], at[len(keys):]
                count = np.zeros((len(both), 2), np.int64)
                count[old] = n
                count[:, 0] += np.bincount(new[y == 0], minlength=len(both))
                count[:, 1] += np.bincount(new[y == 1], minlength=len(both))
                keys, n = both, count
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["gram", "other", "toxic"])

    df = sample.mapInArrow(run, "gram bigint, other bigint, toxic bigint").groupBy("gram").agg(F.sum("other").alias("o"), F.sum("toxic").alias("t"))
    total = toxic + other
    docs = F.col("o") + F.col("t")
    odds = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("o") + 0.5) / (other + 1))
    expect = docs * (toxic / total)
    chi = F.pow(F.col("t") - expect, 2) * (total / toxic) * (total / other) / (docs * (1 - docs / (total + 1.0)))
    top = (df.where(docs >= LEAST_DOCS).withColumn("odds", odds).withColumn("chi", chi)
           .where((F.col("chi") >= LEAST_CHI) & ((F.col("odds") >= LEAST_ODDS) | (F.col("odds") <= 1 / LEAST_ODDS)))
           .select("gram", (F.col("o") + F.col("t")).alias("n")).toArrow())
    g, n = top.column("gram").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(g)
    return g[order], np.log(1 + total / n[order])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    sample = saved(examples(docs, labels, doc_id, text), "toxicity-examples")
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    words, idf = vocabulary(sample, toxic, other) if toxic and other else (np.zeros(0, np.uint64), np.zeros(0))
    empty = np.zeros(0, np.int64)
    index = build_index(words, idf, [], np.zeros(0), np.zeros(1, np.int64), empty, np.zeros(0))

    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                bounds, term, weight = index.vectors(texts.slice(lo, hi - lo))
                offsets = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(weight, pa.float64()))], ["doc_id", "y", "term", "weight"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(run, f"doc_id {kind}, y int, term array<int>, weight array<double>").toArrow().sort_by([("doc_id", "ascending")])
    if not len(rows):
        return index
    term = rows.column("term").combine_chunks()
    bounds = np.r_[0, np.cumsum(pc.list_value_length(term).to_numpy(zero_copy_only=False))]
    return build_index(words, idf, rows.column("doc_id").to_pylist(), rows.column("y").to_numpy(), bounds,
                       term.flatten().to_numpy().astype(np.int64), rows.column("weight").combine_chunks().flatten().to_numpy())


def score_toxicity(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the nearest examples) for every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                score, evidence = shared.value.score(texts.slice(lo, hi - lo))
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.array(score), pa.array(evidence, pa.list_(ids.type))], ["doc_id", "score", "evidence"])

    out = rows.mapInArrow(run, f"doc_id {kind}, score double, evidence array<{kind}>")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"), "evidence")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return score_toxicity(docs, fit(docs, labels))
