"""N-gram Jaccard join (4): rare-first prefix filtering with length, positional and suffix filters.

A document's set holds its distinct 5-word shingles (ASCII lower case; a shorter text is one shingle). Equal
sets form a class. Shingles are ordered rare first: a count-min row of 2**BUCKET_BITS counters, summed over
all documents, gives each shingle a frequency level (powers of two over the mean), and the order is
(level, hash). Two sets that reach the threshold share a shingle in their prefixes of that order, so only
prefixes are shuffled, each entry with the set's size and its position there.

Links are needed up to components, so pairs are tried in two rounds. First every member of a prefix group is
paired with the group's two heaviest members (see ``_weighted``) and its predecessor. Components of the verified links follow. Second,
in groups that still hold several components, members of different components are paired, all of them,
in blocks. A pair is verified once, by intersecting whole sets. A pair inside one component needs no
test: its class is known already. So no group's pairs are expanded as a whole and none that matters is lost.

Filters for sizes a, b and the least shared number s = ceil(3 (a + b) / 7): length (the smaller reaches 75 %
of the larger), positional (shingles left after this one suffice for s) and suffix (differing bits of the
sets' parity bitmaps may not exceed a + b - 2 s); what is left is verified on whole sets.

Defined cases: null, empty or blank texts have an empty set, link with nothing and are their own component.
Rows with a null id join through their text; a component of null ids has a null id. Repeated rows are
in one class. An empty table gives no rows. Other columns are not read by ``jaccard_components``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostage.llm.bytetext import U64, Texts, mix, text_slices
from aerostage.llm.common import BROADCAST_ROWS, read, saved, semi_join
from aerostage.llm.components import components

WORDS = 5
BUCKET_BITS = 20
_CHUNK = 4096
#: Members of one prefix group that are paired in one task; larger groups are cut into blocks.
GROUP_BLOCK = 2_000
#: Earlier shared keys that an entry carries, and pairs looked at in one step.
EARLIER = 6
PAIRS_AT_ONCE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(t: Texts, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' distinct shingles in ascending order in each text, bounds of each text)."""
    count = t.word_counts()
    at, h = t.windows(size)
    text = t.words()[2][at]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = (np.cumsum(count) - count)[short]
        acc = np.zeros(len(short), np.uint64)
        words = t.word_hash()
        for k in range(size - 1):
            more = count[short] > k
            acc[more] = acc[more] * U64(0xD6E8FEB86659FD93) + words[first[more] + k]
        h = np.concatenate([h, mix(acc + count[short].astype(np.uint64) * U64(0x9E3779B97F4A7C15))])
        text = np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        h, text = h[order], text[order]
    bounds = np.searchsorted(text, np.arange(t.n + 1))
    out, sizes = [], np.zeros(t.n, np.int64)
    for i in range(t.n):
        if bounds[i + 1] > bounds[i]:
            own = np.unique(h[bounds[i]:bounds[i + 1]])
            out.append(own)
            sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.r_[0, np.cumsum(sizes)]


def _signatures(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set; a set's class is the first."""
    n = np.diff(bounds).astype(np.uint64)
    out = []
    for salt in (0x8BB84B93962EACC9, 0x2D358DCCAA6C78A5):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ U64(salt)), out=total[1:])
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + n).view(np.int64))
    return out[0], out[1]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def _bits(h: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set over about two bits for each member, as 64-bit words: an element in only one of
    two sets flips one bit, so differing bits never outnumber differing elements."""
    size = max(64, 1 << max(0, 2 * len(h) - 1).bit_length())
    odd = np.bincount(((h >> U64(8)) & U64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _bitmaps(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    bits = [_bits(h[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in bits])], pa.int32()), pa.array(np.concatenate(bits)))


def _profile(rows: DataFrame) -> DataFrame:
    """Every document's (doc_id, n, cls, check, bits) and, in rows with a part, each task's shingle counters."""
    def run(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int32)
        for batch, t in text_slices(batches, table=_LOWER):
            h, bounds = shingles(t)
            np.add.at(counts, (h >> U64(64 - BUCKET_BITS)).astype(np.int64), 1)
            cls, check = _signatures(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(cls), pa.array(check), _bitmaps(h, bounds), pa.nulls(t.n, pa.int32()), pa.nulls(t.n, pa.binary())], names)
        used = [k for k in range(len(counts) // _CHUNK) if counts[k * _CHUNK:(k + 1) * _CHUNK].any()]
        if used:
            m = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.array(used, pa.int32()),
                 pa.array([counts[k * _CHUNK:(k + 1) * _CHUNK].tobytes() for k in used], pa.binary())], names)

    names = ["doc_id", "n", "cls", "check", "bits", "part", "counts"]
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, cls bigint, check bigint, bits array<bigint>, part int, counts binary")


def _levels(parts: DataFrame) -> np.ndarray:
    """Frequency level of each counter: log2 of its count over twice the mean; a table of fixed size."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(counts.as_buffer(), np.int32).astype(np.int64)
                total[part] = total[part] + own if part in total else own
        for part, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["part", "counts"])

    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in parts.select("part", "counts").repartition("part").mapInArrow(run, "part int, counts binary").collect():
        counts[r["part"] * _CHUNK:(r["part"] + 1) * _CHUNK] = np.frombuffer(r["counts"], np.int64)
    floor = 2 * counts.mean() + 4
    return np.clip(np.floor(np.log2(np.maximum(counts, floor) / floor)), 0, 255).astype(np.uint8)


def _postings(rows: DataFrame, levels: np.ndarray) -> DataFrame:
    """Prefix entries (key, cls, spot: size and position) of every class; a class once for each task."""
    def run(batches):
        done: set[int] = set()
        for _, t in text_slices(batches, table=_LOWER):
            h, bounds = shingles(t)
            cls, _ = _signatures(h, bounds)
            keys = (levels[(h >> U64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64) << U64(56)) | (h >> U64(8))
            n = np.diff(bounds)
            out = []
            for i in range(t.n):
                c = int(cls[i])
                if n[i] and c not in done:
                    done.add(c)
                    prefix = int(n[i] - (3 * n[i] + 3) // 4 + 1)
                    own = keys[bounds[i]:bounds[i + 1]]
                    out.append((i, np.sort(own)[:prefix]))
            if out:
                sizes = [len(k) for _, k in out]
                which = np.repeat([i for i, _ in out], sizes)
                pos = np.concatenate([np.arange(s) for s in sizes])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for _, k in out]).view(np.int64)), pa.array(cls[which]), pa.array((n[which] << 32) | pos)], ["key", "cls", "spot"])

    return rows.mapInArrow(run, "key bigint, cls bigint, spot bigint")


def _shared(postings: DataFrame) -> DataFrame:
    """Entries whose key another class has as well, once for each key and class."""
    def run(batches):
        held: pa.RecordBatch | None = None  # last row, and whether its key was met before
        met = False
        for batch in batches:
            if not batch.num_rows:
                continue
            b = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, cls = b.column(0).to_numpy(), b.column(1).to_numpy()
            same = np.r_[False, key[1:] == key[:-1]]
            fresh = ~same | np.r_[True, cls[1:] != cls[:-1]]
            b, key, same = b.filter(pa.array(fresh)), key[fresh], same[fresh]
            shared = same.copy()
            shared[:-1] |= same[1:]
            shared[0] |= met
            if len(key) > 1 and shared[:-1].any():
                yield b.slice(0, len(key) - 1).filter(pa.array(shared[:-1]))
            met = bool(shared[-1])
            held = b.slice(len(key) - 1, 1)
        if held is not None and met:
            yield held

    found = postings.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(run, postings.schema)
    return found.select("key", "cls", F.shiftright("spot", 32).cast("int").alias("n"), F.col("spot").bitwiseAND(0xFFFFFFFF).cast("int").alias("pos"))


def _passes(a: str, b: str) -> Column:
    """Length and positional filters of two entries of one key."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (100 * F.least(na, nb) >= 75 * F.greatest(na, nb)) & (left >= F.floor((3 * (na + nb) + 6) / 7))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(f"{a}.cls", f"{b}.cls").alias("a"), F.greatest(f"{a}.cls", f"{b}.cls").alias("b")]


def _attach(rows: DataFrame, by_class: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table of one row for each class on ``cls``: broadcast while it is small, a shuffle join beyond."""
    return rows.join(F.broadcast(by_class) if by_class.count() <= BROADCAST_ROWS else by_class, "cls", how)


def _weighted(shared: DataFrame) -> DataFrame:
    """Entries with ``weight``: how many other classes share the entries of this class, for each of its
    shingles. In a group of near copies the least edited ones weigh most."""
    met = shared.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return _attach(shared, saved(met.groupBy("cls").agg((F.sum("m") / F.max("n")).alias("weight")), "join-weights"))


def _star_pairs(weighted: DataFrame) -> DataFrame:
    """Every member of a prefix group with the group's two heaviest members and its predecessor by weight."""
    w = Window.partitionBy("key").orderBy(F.desc("weight"), "cls")
    entry = F.struct("cls", "n", "pos")
    rows = weighted.select(entry.alias("x"), F.first(entry).over(w).alias("y"), F.nth_value(entry, 2).over(w).alias("z"), F.lag(entry).over(w).alias("p"))
    return (rows.select("x", F.explode(F.array("y", "z", "p")).alias("y")).where("y is not null and y.cls <> x.cls")
            .where(_passes("x", "y")).select(*_pair("x", "y")).distinct())


def _cross_pairs(shared: DataFrame, comps: DataFrame, block: int) -> DataFrame:
    """Pairs of entries of one key in different components, by blocks of ``block`` members of a key. An
    entry knows the class's last few shared keys before this one: two entries with one of them in common
    have met at that earlier key, so the pair is not produced again."""
    rows = _attach(shared, comps.withColumnRenamed("node", "cls"), "left").withColumn("comp", F.coalesce("root", "cls")).drop("root")
    group, before = Window.partitionBy("key"), Window.partitionBy("cls").orderBy("pos")
    mixed = (rows.withColumn("lo", F.min("comp").over(group)).withColumn("hi", F.max("comp").over(group))
             .withColumn("g", F.ceil(F.count(F.lit(1)).over(group) / block).cast("int")).where("lo <> hi").drop("lo", "hi"))
    mixed = mixed.select("*", *[F.coalesce(F.lag("key", k + 1).over(before), F.lit(0)).alias(f"p{k}") for k in range(EARLIER)])
    every = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda o: F.struct(F.least(o, F.col("s")).alias("i"), F.greatest(o, F.col("s")).alias("j")))
    names = ["key", "i", "j", "comp", "s", "cls", "n", "pos", *[f"p{k}" for k in range(EARLIER)]]
    dealt = (mixed.withColumn("s", F.pmod(F.hash("cls"), F.col("g"))).withColumn("ij", F.explode(every))
             .select("*", "ij.i", "ij.j").select(names))

    def run(batches):
        for table in _whole_groups(batches, 3):
            c = {k: table.column(k).to_numpy() for k in names}
            key = np.stack([c["key"], c["i"], c["j"]])
            new_group = np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]
            new_comp = new_group | np.r_[True, c["comp"][1:] != c["comp"][:-1]]
            n = len(new_group)
            end = lambda new: np.r_[np.flatnonzero(new), n][np.cumsum(new)]  # noqa: E731  index after a row's run
            first, last = end(new_comp), end(new_group)
            count = last - first  # partners of a row: the group's rows of later components
            done = np.r_[0, np.cumsum(count)]
            at = 0
            while at < n:
                to = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS_AT_ONCE, "right")) - 1)
                x = np.repeat(np.arange(at, to), count[at:to])
                y = np.arange(len(x)) - np.repeat(done[at:to] - done[at], count[at:to]) + first[x]
                at = to
                cross = (c["i"][x] == c["j"][x]) | (c["s"][x] != c["s"][y])
                na, nb = c["n"][x].astype(np.int64), c["n"][y].astype(np.int64)
                need = (3 * (na + nb) + 6) // 7
                left = np.minimum(na - c["pos"][x], nb - c["pos"][y])
                fine = np.flatnonzero(cross & (100 * np.minimum(na, nb) >= 75 * np.maximum(na, nb)) & (left >= need))
                x, y = x[fine], y[fine]
                met = np.zeros(len(x), bool)
                for k in range(EARLIER):
                    own = c[f"p{k}"][x]
                    for m in range(EARLIER):
                        met |= (own == c[f"p{m}"][y]) & (own != 0)
                x, y = x[~met], y[~met]
                if len(x):
                    a, b = c["cls"][x], c["cls"][y]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "comp")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _whole_groups(batches, n_keys: int):
    """Tables of whole groups (equal first ``n_keys`` columns) from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(n_keys)])
        cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        starts_new = bool(held) and any(held[-1].column(k)[-1].as_py() != int(keys[k, 0]) for k in range(n_keys))
        if starts_new:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if len(cut):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cut[-1]))]).combine_chunks()
            held = [batch.slice(int(cut[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _may_reach(x: str, y: str) -> Column:
    """Suffix filter on whole sets: differing bits of the parity bitmaps (the longer folded to the shorter)."""
    def fold(a: str, b: str) -> Column:
        half = F.size(b)
        folded = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) == 2 * half, folded).otherwise(F.col(a))

    differing = F.aggregate(F.zip_with(fold(x, y), fold(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    total = F.col("nx") + F.col("ny")
    comparable = (F.size(x) <= 2 * F.size(y)) & (F.size(y) <= 2 * F.size(x))
    return ~comparable | (differing <= total - 2 * F.floor((3 * total + 6) / 7))


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, shared) of the pairs whose whole sets reach the threshold: bitmaps first, then the sets of the
    classes that are left."""
    part = lambda key, col, as_, size: classes.select(F.col("cls").alias(key), F.col(col).alias(as_), F.col("n").alias(size))
    near = (pairs.join(part("a", "bits", "x", "nx"), "a").join(part("b", "bits", "y", "ny"), "b")
            .where(_may_reach("x", "y")).select("a", "b"))
    near = saved(near, "join-near")
    sets = _sets(rows, classes, near.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    found = near.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    return found.where("175 * shared >= 75 * total").select("a", "b", "shared")


def _id(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def _classes(profile: DataFrame) -> DataFrame:
    """(cls, n, bits, id): each non-empty class and the id of one of its documents."""
    return profile.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min(_id("doc_id")).alias("id"))


def _sets(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, ids) of the wanted classes, read again from one document of each."""
    chosen = saved(classes.select("cls", "id").join(wanted, "cls"), "join-wanted")
    n = chosen.count()

    def run(batches):
        for _, t in text_slices(batches, table=_LOWER):
            h, bounds = shingles(t)
            cls, _ = _signatures(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(h.view(np.int64)))], ["cls", "ids"])

    texts = semi_join(rows.withColumn("id", _id("doc_id")), chosen.select("id").distinct(), ["id"], n).select("text")
    found = semi_join(texts.mapInArrow(run, "cls bigint, ids array<bigint>"), chosen.select("cls"), ["cls"], n)
    return saved(found.dropDuplicates(["cls"]), "join-sets")


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_block: int = GROUP_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(profile, roots): every document's (doc_id, n, cls, check, bits) and every linked class's (node, root)."""
    rows = _rows(docs, doc_id, text)
    both = saved(_profile(rows), "join-profile")
    profile = both.where("part is null").drop("part", "counts")
    shared = saved(_shared(_postings(rows, _levels(both.where("part is not null")))), "join-shared")
    classes = saved(_classes(profile), "join-classes")
    first = saved(_verified(saved(_star_pairs(_weighted(shared)), "join-pairs"), classes, rows), "join-star")
    roots = components(first, "a", "b")
    second = saved(_verified(saved(_cross_pairs(shared, roots, group_block), "join-pairs"), classes, rows), "join-cross")
    if second.isEmpty():
        return profile, roots
    merged = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second.select("a", "b"))
    return profile, components(merged, "a", "b")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    profile, roots = links(docs, doc_id, text)
    rows = profile.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("comp"))
    smallest = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("low"))
    return rows.join(smallest, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))
