"""Document fingerprints (9): SpotSigs.

A signature is an anchor word with the CHAIN content words that follow it. Anchors are the common words of the corpus
itself: for each script the ANCHORS words in the most documents, if these are at least one in ANCHOR_SHARE of the script's
documents and LEAST_DOCS. Content words are those that are not anchors, so navigation text and lists of names,
which lack anchors, leave few. Where GAP words pass without an anchor (another language, code, tables), every second
word by its hash stands in as one: a rule of the words just before, so an edit changes signatures only near it. Words
are lower-cased letters and digits; of scripts without blanks every character is a word. A text too short for a
chain has the shingles of SHINGLE characters of its words, or of its bytes if it has none, so every non-empty text
has a fingerprint and equal texts have equal ones.

The fingerprint is the ascending list of distinct 32-bit signatures, in base64. Fingerprints are partitioned by set
length: with bounds growing by 1 / threshold, a set can only reach the threshold with sets of its own partition and
the next, and a comparison stops as soon as the signatures left can't reach it. Only where that says "below the
threshold" is the exact Jaccard counted out, as the query returns it too. ``near_pairs`` joins all fingerprints of
a corpus by the rarest signatures of each.

Defined cases: null and empty texts have the empty fingerprint, whose likeness is 1 with itself and 0 with
any other. Documents are ordered by id, null first, then text; ids are numbers or texts (other types in the order of their
texts); repeated rows follow each other. The row after the last is the first; a single row follows itself. Other columns
are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostage.llm.bytetext import U64, Texts, mix, slices, strings
from aerostage.llm.common import partitions, read, saved

#: Anchors of a script: at most so many words, in one of so many of its documents at least, and in so many.
ANCHORS, ANCHOR_SHARE, LEAST_DOCS = 64, 50, 5
GAP = 8
CHAIN, SHINGLE = 2, 5
THRESHOLD = 0.75
#: Entries counted in one task before they go out.
HELD_WORDS = 1_000_000

_WORDS = np.full(256, 32, np.uint8)  # other signs become blanks
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _WORDS[_lo:_hi] = np.arange(_lo, _hi)
#: Code points of scripts without blanks, and punctuation beyond ASCII (fixed ranges).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FFF), (0x3040, 0x9FFF), (0xF900, 0xFAFF))
PUNCTUATION = ((0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20))


def _within(code: np.ndarray, ranges) -> np.ndarray:
    out = np.zeros(len(code), bool)
    for lo, hi in ranges:
        out |= (code >= lo) & (code <= hi)
    return out


class Tokens:
    """Words of a slice of texts: ``text`` and ``hash`` of each, and its ``script``: 0 for Latin letters and digits, 1 for
    scripts without blanks, else the block of 256 code points of its first character."""

    def __init__(self, texts: pa.Array):
        t = Texts(pc.utf8_lower(texts).cast(pa.string()), _WORDS)
        three = np.flatnonzero((t.b >= 0xE0) & (t.b < 0xF0))
        code = ((t.b[three].astype(np.int32) & 0xF) << 12) | ((t.b[three + 1].astype(np.int32) & 0x3F) << 6) | (t.b[three + 2] & 0x3F)
        sign = three[_within(code, PUNCTUATION)]
        for k in range(3):
            t.b[sign + k] = 32
        alone = three[_within(code, UNSPACED)]
        inside = t.b != 32
        starts = np.zeros(len(t.b) + 3, bool)
        starts[1:len(t.b)] = inside[1:] & ~inside[:-1]
        edge = np.concatenate([t.off[:-1], alone, alone + 3])
        edge = edge[edge < len(t.b)]
        starts[edge[inside[edge]]] = True
        at = np.flatnonzero(starts[:len(t.b)])
        blanks = np.flatnonzero(~inside)
        stop = np.r_[blanks, len(t.b)]
        end = np.minimum(stop[np.searchsorted(blanks, at)], np.r_[at[1:], len(t.b)]) if len(at) else at
        self.text = np.searchsorted(t.off, at, "right") - 1
        self.n = t.n
        self.end = np.minimum(end, t.off[1:][self.text]) if len(at) else end
        self.start, self.t = at, t
        self.hash = t.span_hash(at, self.end)
        lead = t.b[at].astype(np.int64)
        script = np.where(lead < 0x80, 0, np.where(lead < 0xE0, (lead & 0x1F) >> 2, 2))
        script[(lead >= 0xC3) & (lead <= 0xC9)] = 0
        wide = np.searchsorted(three, at)
        is_three = (lead >= 0xE0) & (lead < 0xF0)
        script[is_three] = code[wide[is_three]] >> 8
        script[np.isin(at, alone)] = 1
        self.script = script


def find_anchors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ascending hashes of the anchors: words by document counts over all rows. The driver gets the words that pass the share,
    ANCHOR_SHARE times the words of a document at most, and a row for each script."""
    def run(batches):
        held, many = [], 0

        def out():
            key = np.concatenate(held, 1)
            order = np.lexsort((key[1], key[0]))
            key = key[:, order]
            first = np.flatnonzero(np.r_[True, (key[0, 1:] != key[0, :-1]) | (key[1, 1:] != key[1, :-1])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[0, first].astype(np.int32)), pa.array(key[1, first]), pa.array(np.add.reduceat(key[2], first))], ["script", "word", "n"])

        for batch in batches:
            texts = pc.fill_null(strings(batch, "text"), "")
            for lo, hi in slices(texts):
                w = Tokens(texts.slice(lo, hi - lo))
                if not len(w.text):
                    continue
                order = np.lexsort((w.hash, w.script, w.text))
                t, c, h = w.text[order], w.script[order], w.hash[order].view(np.int64)
                new = np.r_[True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])]
                held.append(np.stack([c[new], np.zeros(new.sum(), np.int64), np.ones(new.sum(), np.int64)]))  # a document of the script
                word = new | np.r_[True, h[1:] != h[:-1]]
                o = np.lexsort((h[word], c[word]))
                cc, hh = c[word][o], h[word][o]
                first = np.flatnonzero(np.r_[True, (cc[1:] != cc[:-1]) | (hh[1:] != hh[:-1])])
                held.append(np.stack([cc[first], hh[first], np.diff(np.r_[first, len(cc)])]))
                many += len(first)
                if many > HELD_WORDS:
                    yield from out()
                    held, many = [], 0
        if held:
            yield from out()

    rows = docs.select(F.col(text).cast("string").alias("text"))
    counted = saved(rows.mapInArrow(run, "script int, word bigint, n bigint").groupBy("script", "word").agg(F.sum("n").alias("n")), "anchor-counts")
    scripts = {r["script"]: r["n"] for r in counted.where("word = 0").collect()}  # one row for each script
    if not scripts:
        return np.zeros(0, np.uint64)
    least = F.create_map(*[F.lit(x) for s, n in sorted(scripts.items()) for x in (s, max(LEAST_DOCS, -(-n // ANCHOR_SHARE)))])
    common = counted.where((F.col("word") != 0) & (F.col("n") >= least[F.col("script")])).collect()
    found: dict[int, list] = {}
    for r in sorted(common, key=lambda r: (-r["n"], r["word"])):
        found.setdefault(r["script"], []).append(r["word"])
    return np.unique(np.array([w for words in found.values() for w in words[:ANCHORS]], np.int64).view(np.uint64))


def spots(texts: pa.Array, anchors: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """Ascending distinct signatures of each text."""
    texts = pc.fill_null(texts, "")
    w = Tokens(texts)
    h, text = w.hash, w.text
    place = np.arange(len(h))
    listed = np.zeros(len(h), bool)
    if len(anchors):
        listed = anchors[np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)] == h
    bounds = np.searchsorted(text, np.arange(w.n + 1))
    before = np.maximum.accumulate(np.where(listed, place, -1)) if len(h) else place
    since = place - np.maximum(before, bounds[:-1][text] - 1) if len(h) else place
    head = listed | ((since >= GAP) & (h & U64(1 << 17) > 0))
    content = np.flatnonzero(~listed)
    heads = np.flatnonzero(head)
    nth = np.searchsorted(content, heads, "right")  # first content word behind the anchor
    fits = nth + chain <= len(content)
    heads, nth = heads[fits], nth[fits]
    fits = text[content[nth + chain - 1]] == text[heads] if len(heads) else np.zeros(0, bool)
    heads, nth = heads[fits], nth[fits]
    sig = h[heads]
    for k in range(chain):
        sig = sig * U64(0xD6E8FEB86659FD93) + h[content[nth + k]]
    sig = (mix(sig) >> U64(32)).astype(np.uint32)
    owner = text[heads]
    cut = np.searchsorted(owner, np.arange(w.n + 1))
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    out = []
    for i in range(w.n):
        own = sig[cut[i]:cut[i + 1]]
        if not len(own) and size[i]:
            own = _short(w, bounds[i], bounds[i + 1], texts[i])
        out.append(np.unique(own))
    return out


def _short(w: Tokens, lo: int, hi: int, text: pa.Scalar) -> np.ndarray:
    """Signatures of a text without a chain: shingles of its words' characters, else of its bytes."""
    raw = w.t.b.tobytes() if hi > lo else b""
    data = b" ".join(raw[s:e] for s, e in zip(w.start[lo:hi].tolist(), w.end[lo:hi].tolist())).decode() if hi > lo else text.as_py()
    pieces = [data[k:k + SHINGLE] for k in range(max(1, len(data) - SHINGLE + 1))]
    t = Texts(pa.array(pieces))
    return (mix(t.span_hash(t.off[:-1], t.off[1:])) >> U64(32)).astype(np.uint32)


def encode(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard of two ascending distinct lists; 1 for two empty ones."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return both / (len(x) + len(y) - both)


def length_partition(n: int, threshold: float = THRESHOLD) -> int:
    """Partition of a set of ``n``: neighbours' bounds differ by the factor 1 / threshold."""
    return int(np.floor(np.log(max(n, 1)) / -np.log(threshold) + 1e-9))


def reaches(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> float | None:
    """Jaccard if it reaches the threshold, else None: by length first, then in steps that stop as soon as the
    signatures left can't make up for those already missed."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if len(small) < threshold * len(large):
        return None
    may_miss = len(small) - threshold / (1 + threshold) * (len(x) + len(y)) + 1e-9
    missed, step = 0, 64
    for k in range(0, len(small), step):
        part = small[k:k + step]
        at = np.searchsorted(large, part)
        missed += int((large[np.minimum(at, len(large) - 1)] != part).sum())
        if missed > may_miss:
            return None
    both = len(small) - missed
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def compared(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard through the length partitions and the pruned comparison; counted out where it is below the threshold."""
    if abs(length_partition(len(x)) - length_partition(len(y))) <= 1:
        found = reaches(x, y)
        if found is not None:
            return found
    return likeness(x, y)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_spots, part (length partition) and fingerprint of every row."""
    anchors = find_anchors(docs, text) if anchors is None else anchors
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                got = spots(texts.slice(lo, hi - lo), anchors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in got], pa.int32()),
                     pa.array([length_partition(len(s)) for s in got], pa.int32()), pa.array([encode(s) for s in got])], ["doc_id", "n_spots", "part", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_spots int, part int, fingerprint string")


def near_pairs(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness) between different fingerprints that reach the threshold, as representatives (smallest
    id of each fingerprint). Candidates share a length partition or lie in neighbouring ones, and share one of
    the first (1 - threshold) n + 1 signatures, rarest first, of which a reaching pair has one in common: what very many
    documents share (a boilerplate passage) is not among the first of a text that has anything else."""
    kind = prints.schema["doc_id"].dataType.simpleString()
    classes = saved(prints.where("n_spots > 0").groupBy("fingerprint", "n_spots", "part").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")

    def signatures(batches):
        for batch in batches:
            for rep, part, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                s = decode(value)
                first = len(s) - int(np.ceil(threshold * len(s) - 1e-9)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rep] * len(s), batch.schema.field(0).type), pa.array([part] * len(s), pa.int32()),
                     pa.array([len(s)] * len(s), pa.int32()), pa.array([first] * len(s), pa.int32()), pa.array(s.astype(np.int64))],
                    ["rep", "part", "size", "first", "sig"])

    every = classes.select("rep", "part", "fingerprint").mapInArrow(signatures, f"rep {kind}, part int, size int, first int, sig bigint")
    every = every.join(every.groupBy("sig").agg(F.count(F.lit(1)).alias("n")), "sig")
    nth = F.row_number().over(Window.partitionBy("rep").orderBy("n", "sig"))
    h = saved(every.withColumn("nth", nth).where("nth <= first and n > 1").select("rep", "part", "size", "sig"), "fingerprint-heads")
    x = h.select(F.col("rep").alias("a"), F.col("size").alias("size_a"), "part", "sig")
    y = h.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), "sig")
    fits = F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b") - 1e-9
    pairs = x.join(y, ["part", "sig"]).where((F.col("a") != F.col("b")) & fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    value = classes.select("rep", "fingerprint")
    both = pairs.join(value.toDF("a", "fa"), "a").join(value.toDF("b", "fb"), "b")

    def verify(batches):
        for batch in batches:
            c = batch.to_pydict()
            got = [reaches(decode(p), decode(q), threshold) for p, q in zip(c["fa"], c["fb"])]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.float64())], ["a", "b", "likeness"])

    return both.select("a", "b", "fa", "fb").mapInArrow(verify, f"a {kind}, b {kind}, likeness double").where("likeness is not null")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) characters replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(bucket, doc_id, text, extra): rows sorted by id inside range buckets; each bucket ends with an extra row,
    the first of the next bucket, so every row's successor follows it. One shuffle of the rows; the bounds
    come from ids alone, one value for each bucket."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    many = max(2, 2 * partitions(docs.sparkSession))
    if isinstance(rows.schema["doc_id"].dataType, T.NumericType):
        ids = rows.select(F.col("doc_id").cast("double").alias("doc_id")).where("doc_id is not null")
        cuts = ids.agg(F.percentile_approx("doc_id", [k / many for k in range(1, many)], 10_000)).first()[0] or []
        splits = [-float("inf"), *sorted({float(c) for c in cuts}), float("inf")]
        number = rows.withColumn("__id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf"))))
        if len(splits) > 2:
            placed = Bucketizer(splits=splits, inputCol="__id", outputCol="__b").transform(number).withColumn("bucket", F.col("__b").cast("int")).drop("__b", "__id")
        else:
            placed = number.withColumn("bucket", F.lit(0)).drop("__id")
    else:  # bounds from about 100 ids a bucket, chosen by hash
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
        n = rows.count()
        some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // (100 * many)))) == 0).where("doc_id is not null").select("doc_id").distinct()
        got = sorted((r[0] for r in some.limit(200 * many).collect()), key=str.encode)
        cuts = sorted({got[k * len(got) // many] for k in range(1, many)}, key=str.encode) if got else []
        below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
        placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(below))
    order = F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id")
    firsts = placed.groupBy("bucket").agg(F.min(order).alias("f"))  # one row for each bucket
    before = F.lag("bucket").over(Window.orderBy("bucket"))
    last = F.max("bucket").over(Window.partitionBy())  # before the first bucket comes the last
    edges = firsts.select(F.col("bucket").alias("__of"), F.col("f.doc_id").alias("__first"), F.coalesce(before, last).alias("__to"))
    at = (F.col("bucket") == F.col("__of")) & F.col("doc_id").eqNullSafe(F.col("__first"))
    # of rows that tie on a bucket's first id only the first text is the successor
    extra = (placed.join(F.broadcast(edges), at).groupBy("__to").agg(F.min(F.struct("text", "doc_id")).alias("m"))
             .select(F.col("m.doc_id").alias("doc_id"), F.col("m.text").alias("text"), F.col("__to").alias("bucket"), F.lit(1).alias("extra")))
    return (placed.withColumn("extra", F.lit(0)).unionByName(extra).repartitionById(many, "bucket")
            .sortWithinPartitions("bucket", "extra", F.asc_nulls_first("doc_id"), "text"))


def edit_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of every text, of its edited text, and their likeness to each other and the next text."""
    anchors = find_anchors(docs, text)
    rows = with_next(docs, doc_id, text)

    def report(ids: pa.Array, values: list[str]):
        """Rows for all but the last value, whose successors are known."""
        texts, following = values[:-1], values[1:]
        changed = [edited(a, b) for a, b in zip(texts, following)]
        own, other = spots(pa.array(values, pa.string()), anchors), spots(pa.array(changed, pa.string()), anchors)
        return [
            ids, pa.array([len(a) for a in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array([encode(s) for s in own[:-1]]),
            pa.array([encode(s) for s in other]), pa.array([compared(a, b) for a, b in zip(own, other)]),
            pa.array([compared(a, b) for a, b in zip(own, own[1:])]),
        ]

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None  # a row whose successor is still to come
        for batch in batches:
            b = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = b.slice(b.num_rows - 1, 1)
            texts, last = strings(b, "text"), b.column(b.schema.get_field_index("extra")).to_numpy()
            for lo, hi in slices(texts, 1 << 20):
                hi = min(hi + 1, b.num_rows)  # with the successor of the slice's last row
                if hi - lo < 2:
                    continue
                wanted = pa.array(last[lo:hi - 1] == 0)
                got = report(b.column(0).slice(lo, hi - lo - 1), texts.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(got, names).filter(wanted)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "extra").mapInArrow(
        run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edit_report(read(spark, sf_dir, "documents"))
