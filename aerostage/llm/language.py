"""Language ID (5): Bloom filters of byte 4-grams, bit-sliced so that one slot holds a bit for each language, in as
many 62-bit words as the languages need.

A lookup ANDs the slots of a gram and returns every language that may contain it. A document's hits are
counted for each language, corrected for the filter's false positives (fill ** hashes), and the language with
the largest share of contained grams wins. A gram belongs to a language if it is met often enough there:
MIN_COUNT times, and with at least RELATIVE of the highest rate in any language, so quotations and names
from another language don't count.

The model is fitted on a bounded sample: about SAMPLE_DOCS training documents of each language, chosen by a
hash of the id. Grams are counted by Spark; the driver gets the filter and a row for each language. The filter has
SLOTS slots (of 8 bytes for each 62 languages) for each gram of the language with the most: a language's false hits
depend on its own grams only, so they stay below (HASHES / SLOTS) ** HASHES however many languages and grams there
are. Every language of the training rows is learned.

Defined cases: a null text or one without a letter is ``und`` with score 0. A text without any known gram
gets the most frequent language with score 0. Rows with null ids are predicted and not learned from. With no
training rows all is ``und``. Repeated rows are predicted each. An empty table gives no rows.
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

SAMPLE_DOCS = 8_000
FOLDS, HELD_OUT = 4, 2
MIN_COUNT, RELATIVE = 3, 0.2
SLOTS = 16
#: Languages in one mask word.
WORD_BITS = 62
#: Odd multipliers of the hash functions.
HASHES = (0x5BD1E995, 0x1B873593, 0x2C1B3C6D)

_LETTERS = np.full(256, 32, np.uint8)  # other signs become blanks
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def grams(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram at each byte, whether it lies in one text and has one blank at most)."""
    b = t.b.astype(np.uint32)
    n = max(0, len(b) - 3)
    g = b[:n] | (b[1:n + 1] << 8) | (b[2:n + 2] << 16) | (b[3:n + 3] << 24)
    blank = np.r_[0, np.cumsum(t.b == 32)]
    ok = blank[4:n + 4] - blank[:n] <= 1
    for k in range(1, 4):
        edge = t.off[1:-1] - k
        ok[edge[(edge >= 0) & (edge < n)]] = False
    return g, ok


def _lowered(texts: pa.Array) -> Texts:
    padded = pc.binary_join_element_wise("", pc.utf8_lower(pc.fill_null(texts, "")), "  ", " ")  # text, one blank, two blanks
    return Texts(padded.cast(pa.string()), _LETTERS)


@dataclass
class LanguageModel:
    languages: list[str]
    masks: np.ndarray  # words x slots; bit l % WORD_BITS of word l // WORD_BITS of a slot: language l
    false_hits: np.ndarray  # chance that an absent gram is found, by language
    common: int  # most frequent language

    def languages_of(self, g: np.ndarray) -> np.ndarray:
        """Mask words (words x grams) of the languages that contain each gram, or seem to."""
        shift = U64(32 - int(np.log2(self.masks.shape[1])))
        out = None
        for c in HASHES:
            m = self.masks[:, ((g.astype(np.uint64) * U64(c)) & U64(0xFFFFFFFF)) >> shift]
            out = m if out is None else out & m
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (the winner's part of all languages' shares) and the winner's own corrected share of each text."""
        t = _lowered(texts)
        if not self.languages or not t.n:
            return ["und"] * t.n, np.zeros(t.n), np.zeros(t.n)
        g, ok = grams(t)
        pad = len(t.b) - len(g)
        mask = np.where(ok, self.languages_of(g), 0)
        total = np.maximum(t.per_text(np.r_[ok, np.zeros(pad, bool)]), 1)
        best, own, all_ = np.zeros(t.n, np.int64), np.full(t.n, -1.0), np.zeros(t.n)
        for l in range(len(self.languages)):
            hits = t.per_text(np.r_[(mask[l // WORD_BITS] >> (l % WORD_BITS)) & 1, np.zeros(pad, mask.dtype)])
            share = np.clip((hits / total - self.false_hits[l]) / (1 - self.false_hits[l]), 0, 1)
            best[share > own] = l
            own = np.maximum(own, share)
            all_ += share
        score = np.where(all_ > 0, own / np.where(all_ > 0, all_, 1), 0.0)
        best = np.where(all_ > 0, best, self.common)
        ascii_ = t.per_text((t.b >= 97) & (t.b < 123)) > 0
        other = t.per_text(t.b >= 128) > 0
        out = [self.languages[k] for k in best]
        for i in np.flatnonzero(~ascii_):
            if not other[i] or not any(ch.isalpha() for ch in texts[int(i)].as_py() or ""):
                out[i], score[i], own[i] = "und", 0.0, 0.0
        return out, score, own


def _counted(train: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, gram, n) summed over each task and then by Spark."""
    index = {l: i for i, l in enumerate(languages)}

    def run(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            texts = strings(batch, "text")
            codes = np.array([index[l] for l in batch.column(0).to_pylist()], np.uint64)
            for lo, hi in slices(texts):
                t = _lowered(texts.slice(lo, hi - lo))
                g, ok = grams(t)
                code = np.repeat(codes[lo:hi], np.diff(t.off))[:len(g)]
                k, n = np.unique(((code << U64(32)) | g)[ok], return_counts=True)
                both = np.concatenate([keys, k])
                keys, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys >> U64(32)).astype(np.int32)), pa.array((keys & U64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    return train.mapInArrow(run, "lang int, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, sample: int = SAMPLE_DOCS) -> LanguageModel:
    """Model from (lang, text, doc_id) rows with a language."""
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((1, 1 << 10), np.int64), np.zeros(0), 0)
    many = {l: sample / n for l, n in sizes.items() if n > sample}
    share = F.coalesce(F.create_map(*[F.lit(x) for l in sorted(many) for x in (l, many[l])])[F.col("lang")], F.lit(1.0)) if many else F.lit(1.0)
    chosen = train.where((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)) < share)
    counts = _counted(chosen.select("lang", "text"), languages)
    counts = saved(counts, "gram-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    per = F.create_map(*[F.lit(x) for l, n in sorted(totals.items()) for x in (l, float(max(n, 1)))]) if totals else F.create_map(F.lit(0), F.lit(1.0))
    rates = counts.withColumn("rate", F.col("n") / per[F.col("lang")])
    top = rates.groupBy("gram").agg(F.max("rate").alias("top"))
    kept = rates.where(f"n >= {MIN_COUNT}").join(top, "gram").where(F.col("rate") >= RELATIVE * F.col("top"))
    words = range(-(-len(languages) // WORD_BITS))
    bit = F.expr(f"shiftleft(1L, lang % {WORD_BITS})")
    kept = saved(kept.select("lang", "gram"), "language-grams")
    bits = kept.groupBy("gram").agg(*[F.bit_or(F.when(F.floor(F.col("lang") / WORD_BITS) == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"mask{w}") for w in words])
    most = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    size = max(1 << 16, 1 << (SLOTS * most - 1).bit_length())
    shift = 32 - (size.bit_length() - 1)
    slots = F.array(*[F.shiftright((F.col("gram") * c).bitwiseAND(0xFFFFFFFF), shift) for c in HASHES])
    filled = bits.select(F.explode(slots).alias("slot"), *[f"mask{w}" for w in words]).groupBy("slot").agg(*[F.bit_or(f"mask{w}").alias(f"mask{w}") for w in words])
    masks = np.zeros((len(words), size), np.int64)
    for r in filled.toLocalIterator():  # as many rows as slots at most
        masks[:, r["slot"]] = r[1:]
    kind = np.uint8 if len(languages) <= 8 else np.int64
    fill = np.array([((masks[l // WORD_BITS] >> (l % WORD_BITS)) & 1).mean() for l in range(len(languages))])
    return LanguageModel(languages, masks.astype(kind), fill ** len(HASHES), max(range(len(languages)), key=lambda l: (sizes[languages[l]], -l)))


def _train_rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.col(doc_id).alias("doc_id")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))


def identify(docs: DataFrame, model: LanguageModel | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from the other folds unless a model is given."""
    m = model or fit(_train_rows(docs, doc_id, text, lang))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(m)  # bounded by the training sample

    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                pred, score, _ = shared.value.predict(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language contains at least ``least`` of the text's grams
    (the winner's corrected share). Unlike the score it doesn't fall with the number of learned languages; no margin
    over the runner-up is asked for, which would drop clean texts of two close languages or of one with two tags."""
    m = docs.sparkSession.sparkContext.broadcast(fit(_train_rows(docs, doc_id, text, lang)))

    def run(batches):
        for batch in batches:
            texts = strings(batch, text)
            for lo, hi in slices(texts):
                pred, _, own = m.value.predict(texts.slice(lo, hi - lo))
                kept = (np.array(pred, object) != "und") & (own >= least)
                if kept.any():
                    yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
