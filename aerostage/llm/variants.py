"""Spelling variant grouping (12): words one edit apart, found with a variable-length gram index.

1. Gram dictionary: all grams of QMIN to QMAX characters are counted over the words; a gram is extended by one
   character only if it occurs more often than a threshold, so the dictionary keeps short grams where they are
   rare and long ones where they are common. The threshold is GRAM_WORDS, or what keeps the dictionary under
   DICTIONARY grams, whatever the number of words (an extended gram has LETTERS children at most).
2. Decomposition: at each place the longest gram of the dictionary, without those inside an earlier one.
3. Bound: for each place of one insertion, deletion or replacement the grams that it can touch are counted: those
   across the place, those that end at it and could grow, and those behind it that a gram across the place could
   swallow. The most of any place is the word's number of affected grams A; a word one edit away shares all
   others, at the same place or one further where the lengths differ.
4. List merging: of a word's grams only the A + 1 rarest lists are merged: two words that share all but A of their
   grams meet in one of these. Lists hold (gram, word length, place), so only words of fitting length meet.
   A word of which one edit may touch every gram is entered under all its grams; two such words
   are compared by the same rule over plain bigrams, of which one edit touches two at most.
5. Verification: words whose letters' parities differ in more than two bits are two edits apart; for the others the
   edit distance decides.

Everything is a join or a grouping of the word table; the driver holds the dictionary only. The words of the
query come from whole texts by a pass with counts added up before the shuffle.

Defined cases: null, empty and letterless texts have no words; a row without an id counts, but none of its runs is
changed by the query. Repeated rows count each. Characters above U+00FF end a run. Other columns are not read. No
words: no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import Texts, slices, strings
from aerostage.llm.common import read, saved

QMIN, QMAX = 2, 4
GRAM_WORDS, DICTIONARY, LETTERS = 1_000, 500_000, 90
LEAST_LENGTH, LEAST_COUNT = 5, 3
SHORTEST = 4
#: The query's changed runs: one of so many by checksum.
CHANGED = 97
#: Words counted in one task before they go out.
HELD_WORDS = 200_000

_CRC = np.array([zlib.crc32(bytes([k])) ^ zlib.crc32(b"\0") for k in range(256)], np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---- words ---------------------------------------------------------------------------------------

def crc_of_spans(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each byte span, carried on from the checksum ``before`` it."""
    out = ~before.astype(np.uint32)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    starts, size, state = starts[order], size[order], out[order]
    short = int(np.searchsorted(-size, -64))  # the longer ones come first and go through the library
    for i in range(short):
        state[i] = ~np.uint32(zlib.crc32(b[starts[i]:starts[i] + size[i]].tobytes(), int(~state[i])))
    for k in range(int(size[short]) if short < len(size) else 0):
        live = slice(short, int(np.searchsorted(-size, -k)))
        state[live] = _CRC[(state[live] ^ b[starts[live] + k]) & 0xFF] ^ (state[live] >> np.uint32(8))
    out[order] = ~state
    return out


def letter_runs(texts: pa.Array) -> Texts:
    """Texts whose words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased."""
    t = Texts(texts, _LOWER)
    two = t.b == 0xC3  # of a valid text: the first byte of U+00C0 to U+00FF
    letter = ((t.b >= 97) & (t.b <= 122)) | two
    letter[1:] |= two[:-1]
    t.b[~letter] = 32
    return t


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", changed: int | None = None) -> DataFrame:
    """(word, n) of the letter runs of whole texts with LEAST_LENGTH code points and LEAST_COUNT occurrences.
    With ``changed``, a run whose crc32 with its document's id is divisible by it loses one code point first."""
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        held: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()

        for batch in batches:
            texts, ids = pc.fill_null(strings(batch, "text"), ""), batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                t = letter_runs(texts.slice(lo, hi - lo))
                starts, ends, owner = t.words()
                if not len(starts):
                    continue
                h = t.word_hash()
                if changed:  # one row for each word of each text, with its occurrences
                    order = np.lexsort((h, owner))
                    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])]
                    at = order[new]
                    count = np.diff(np.r_[np.flatnonzero(new), len(order)])
                    before = np.array([zlib.crc32(f"{i}:".encode()) if i is not None else 0 for i in ids[lo:hi]], np.uint32)[owner[at]]
                    known = np.array([i is not None for i in ids[lo:hi]])[owner[at]]
                    crc = crc_of_spans(t.b, starts[at], ends[at], before)
                    hit = known & (crc % changed == 0)
                    raw = t.b.tobytes()
                    for k in np.flatnonzero(hit).tolist():
                        word = raw[starts[at[k]]:ends[at[k]]].decode()
                        gone = int(crc[k]) % len(word)
                        word = word[:gone] + word[gone + 1:]
                        if len(word) >= LEAST_LENGTH:
                            held[word] += int(count[k])
                    at, count = at[~hit], count[~hit]
                else:
                    at, count = np.arange(len(starts)), np.ones(len(starts), np.int64)
                first = np.r_[0, np.cumsum(t.b == 0xC3)]
                long = ends[at] - starts[at] - (first[ends[at]] - first[starts[at]]) >= LEAST_LENGTH
                at, count = at[long], count[long]
                if len(at):
                    _, one, kind = np.unique(h[at], return_index=True, return_inverse=True)
                    total = np.bincount(kind, count).astype(np.int64).tolist()
                    raw = t.b.tobytes()
                    for s, e, n in zip(starts[at[one]].tolist(), ends[at[one]].tolist(), total):
                        held[raw[s:e].decode()] += n
                if len(held) > HELD_WORDS:
                    yield from out()
        if held:
            yield from out()

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---- grams ---------------------------------------------------------------------------------------

class Words:
    """A batch of words, one byte for each code point: ``b`` bytes, ``off`` bounds, ``of`` word of each byte."""

    def __init__(self, words: list[str]):
        data = [w.encode("latin-1") for w in words]
        size = np.array([len(d) for d in data], np.int64)
        self.b = np.frombuffer(b"".join(data) + bytes(QMAX), np.uint8).astype(np.uint64)
        self.off = np.r_[0, np.cumsum(size)]
        self.of = np.repeat(np.arange(len(size)), size)
        self.n, self.size = len(size), size

    def packed(self, at: np.ndarray, q: np.ndarray | int) -> np.ndarray:
        """The ``q`` bytes from each place as one number (of 7 bytes at most); different strings differ."""
        out = np.zeros(len(at), np.uint64)
        for k in range(int(np.max(q)) if len(at) else 0):
            take = np.asarray(q) > k
            out |= np.where(take, self.b[np.minimum(at + k, len(self.b) - 1)], 0).astype(np.uint64) << np.uint64(8 * k)
        return out


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


class Dictionary:
    """Grams as numbers, ascending, with their occurrences; which of them are extended; and the inner pieces of all."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]
        size = np.zeros(len(grams), np.int64)
        for k in range(QMAX):
            size += (self.grams >> np.uint64(8 * k)) > 0
        longer = size > QMIN
        mask = (np.uint64(1) << (np.uint64(8) * (size[longer] - 1).astype(np.uint64))) - np.uint64(1)
        self.extended = np.unique(self.grams[longer] & mask)
        inner = []
        for a in range(1, QMAX):
            rest, left = self.grams >> np.uint64(8 * a), size - a
            for m in range(1, QMAX - a + 1):
                inner.append(np.unique(rest[left >= m] & np.uint64((1 << 8 * m) - 1)))
        self.inner = np.unique(np.concatenate(inner)) if inner else self.grams

    def decompose(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(byte place, length, number) of each gram of the words' decomposition."""
        at = np.arange(w.off[-1])
        left = w.off[1:][w.of] - at if len(at) else at
        at, left = at[left >= QMIN], left[left >= QMIN]
        match, number = np.full(len(at), QMIN), w.packed(at, QMIN)
        for q in range(QMIN + 1, QMAX + 1):
            key = w.packed(at, q)
            longer = (left >= q) & _in(key, self.grams)
            match[longer], number[longer] = q, key[longer]
        end = at + match
        furthest = np.r_[0, np.maximum.accumulate(end)[:-1]] if len(at) else end
        kept = end > furthest  # words follow each other, so an earlier word's grams end before
        return at[kept], match[kept], number[kept]

    def affected(self, w: Words, at: np.ndarray, size: np.ndarray, number: np.ndarray) -> np.ndarray:
        """For each word the most grams that one edit can touch."""
        own, end = w.of[at], at + size
        last = w.off[1:][own]
        grows = _in(number, self.extended)
        # places of an edit: replaced or deleted bytes, and gaps (one more than bytes) for insertions
        changed = np.zeros(w.off[-1], np.int64)
        gaps = np.zeros(w.off[-1] + w.n, np.int64)
        gap = lambda p: p + own
        for k in range(QMAX):  # inside the gram
            np.add.at(changed, (at + k)[k < size], 1)
            np.add.at(gaps, gap(at + k)[(0 < k) & (k < size)], 1)
        np.add.at(changed, end[grows & (end < last)], 1)  # right behind it
        np.add.at(gaps, gap(end)[grows], 1)
        for back in range(QMAX):  # in front: the piece from the edit to the gram's end lies inside a gram
            p = at - back
            inside = (p >= w.off[own]) & (end - p < QMAX)
            hit = np.flatnonzero(inside)
            hit = hit[_in(w.packed(p[hit], (end - p)[hit]), self.inner)]
            np.add.at(gaps, gap(p)[hit], 1)
            hit = hit[p[hit] > w.off[own[hit]]]
            np.add.at(changed, p[hit] - 1, 1)
        most = np.zeros(w.n, np.int64)
        np.maximum.at(most, w.of, changed)
        np.maximum.at(most, np.repeat(np.arange(w.n), w.size + 1), gaps)
        return most


def gram_dictionary(words: DataFrame) -> Dictionary:
    def run(batches):
        for batch in batches:
            w = Words(batch.column(0).to_pylist())
            at = np.arange(w.off[-1])
            left = w.off[1:][w.of] - at if len(at) else at
            for q in range(QMIN, QMAX + 1):
                gram, n = np.unique(w.packed(at[left >= q], q), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), q, np.int32)), pa.array(n)], ["gram", "q", "n"])

    counted = saved(words.select("word").mapInArrow(run, "gram bigint, q int, n bigint").groupBy("gram", "q").agg(F.sum("n").alias("n")), "gram-counts")
    total = counted.where(F.col("q") < QMAX).agg(F.sum("n")).first()[0] or 0
    often = max(GRAM_WORDS, -(-total * LETTERS // DICTIONARY))
    parents = counted.where((F.col("n") > often) & (F.col("q") < QMAX)).select(F.col("gram").alias("parent"), (F.col("q") + 1).alias("q"))
    longer = counted.where(F.col("q") > QMIN).withColumn("parent", F.col("gram").bitwiseAND(F.expr("shiftleft(1L, 8 * (q - 1)) - 1")))
    kept = counted.where(F.col("q") == QMIN).select("gram", "n").unionByName(longer.join(parents, ["parent", "q"], "left_semi").select("gram", "n"))
    got = kept.toArrow()  # LETTERS ** QMIN + DICTIONARY grams at most
    return Dictionary(got.column("gram").to_numpy().view(np.uint64), got.column("n").to_numpy())


# ---- the join ------------------------------------------------------------------------------------

def _lists(words: DataFrame, decompose) -> DataFrame:
    """(word, size, gram, place, weak, parity) list entries, ``decompose`` giving those of a batch of words."""
    def run(batches):
        for batch in batches:
            w = Words(batch.column(0).to_pylist())
            at, gram, weak = decompose(w)
            own = w.of[at]
            letter = np.uint64(1) << (w.b[:w.off[-1]] & np.uint64(63))
            parity = np.bitwise_xor.reduceat(letter, w.off[:-1]) if w.n else letter
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), pa.array(w.size[own].astype(np.int32)), pa.array(gram.view(np.int64)),
                 pa.array((at - w.off[own]).astype(np.int32)), pa.array(weak[own]), pa.array(parity[own].view(np.int64))],
                ["word", "size", "gram", "place", "weak", "parity"])

    return words.select("word").mapInArrow(run, "word string, size int, gram bigint, place int, weak boolean, parity bigint")


def _rarest(w: Words, at: np.ndarray, number: np.ndarray, count: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Indices of the first ``take`` grams of each word, rarest first."""
    own = w.of[at]
    order = np.lexsort((at, number, count, own))
    nth = np.arange(len(order)) - np.searchsorted(own[order], own[order])
    return order[nth < take[own[order]]]


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) of all words of ``words`` (column ``word``, distinct, code points up to U+00FF) one edit apart, each pair
    once. Words of less than SHORTEST code points, of which one edit touches every bigram, have no pair."""
    words = words.where(F.length("word") >= SHORTEST)
    grams = gram_dictionary(words)
    shared = words.sparkSession.sparkContext.broadcast(grams)  # bounded by DICTIONARY

    def variable(w: Words):
        d = shared.value
        at, size, number = d.decompose(w)
        most = d.affected(w, at, size, number)
        total = np.bincount(w.of[at], minlength=w.n)
        weak = total <= most
        count = d.counts[np.minimum(np.searchsorted(d.grams, number), len(d.grams) - 1)] if len(d.grams) else number
        some = _rarest(w, at, number, count, np.where(weak, total, most + 1))
        return at[some], number[some], weak

    def bigrams(w: Words):
        """Of the weak words: an edit touches two bigrams at most, so the three rarest lists are merged."""
        d = shared.value
        at = np.arange(w.off[-1])
        at = at[w.off[1:][w.of] - at >= 2] if len(at) else at
        number = w.packed(at, 2)
        count = d.counts[np.minimum(np.searchsorted(d.grams, number), len(d.grams) - 1)]
        some = _rarest(w, at, number, count, np.full(w.n, 3))
        return at[some], number[some], np.ones(w.n, bool)

    def pairs(lists: DataFrame, weak_too: bool) -> DataFrame:
        # a replacement leaves the place of every other gram, an insertion moves those behind it by one
        reach = F.explode(F.array(*[F.struct((F.col("size") + a).alias("size"), (F.col("place") + b).alias("place")) for a, b in ((0, 0), (1, 0), (1, 1))]))
        left = lists.select(F.col("word").alias("a"), F.col("gram"), F.col("weak").alias("weak_a"), F.col("parity").alias("parity_a"),
                            F.col("size").alias("size_a"), reach.alias("r"))
        left = left.select("a", "gram", "weak_a", "parity_a", "size_a", F.col("r.size").alias("size"), F.col("r.place").alias("place"))
        right = lists.withColumnRenamed("word", "b")
        met = left.join(right, ["gram", "size", "place"]).where((F.col("size_a") < F.col("size")) | (F.col("a") < F.col("b")))
        met = met if weak_too else met.where(~(F.col("weak_a") & F.col("weak")))
        met = met.where(F.bit_count(F.col("parity").bitwiseXOR(F.col("parity_a"))) <= 2)
        # the edit distance before the duplicates are dropped: it is cheap and leaves few pairs
        return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")

    lists = saved(_lists(words, variable), "gram-lists")
    weak = saved(lists.where("weak").select("word").distinct(), "weak-words")
    plain = saved(_lists(weak, bigrams), "bigram-lists")
    return saved(pairs(lists, False).unionByName(pairs(plain, True)).distinct(), "near-words")


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word, n): its near word of largest n if that is
    twice its own, and the last of the forms that follow."""
    pairs = near_words(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = (both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b").groupBy("a")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("b").alias("form"))).alias("f")))
    own = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    takes = (-F.col("f.less")) >= 2 * F.col("n")
    own = saved(own.select("word", F.when(takes, F.col("f.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                           F.when(takes, -F.col("f.less")).alias("form_n")), "forms")
    # each word points to its form; pointers are followed twice as far in each round (n doubles at every step, so they are few)
    ends = saved(own.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = saved(ends.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ends = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    words = saved(count_words(read(spark, sf_dir, "documents"), changed=CHANGED), "words")
    return spelling_variants(words)
