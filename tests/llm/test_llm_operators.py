"""The dealt operators: against brute force on a small table, and over rows of every awkward kind."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerostage.llm import chat, fingerprints, language, mixing, near_duplicates, ngram_join, packing, pii, quality_model, quality_rules, runs, sharding, toxicity, variants
from aerostage.llm.common import read, ship

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean, cls bigint, size int, bucket int"


def _row(i, text, lang="en", source="s"):
    return (i, text, lang, source, len(text or ""), 0.5, True, 1, 2, 3)


AWKWARD = [
    _row(1, None), _row(2, ""), _row(3, "   \n\t "), _row(None, "a text without an id that has some words"), _row(4, "a", None, None),
    _row(5, "the quick brown fox jumps over the lazy dog again"), _row(5, "the quick brown fox jumps over the lazy dog again"),
    _row(6, "THE quick brown fox jumps over the lazy dog again", "de", "t"), _row(7, "long words of a text " * 4000), _row(8, "é漢字 😀  two blanks\x85 it's", "fr", None),
    _row(9, "12345 !!! ###"), _row(10, "x" * 5000),
]


@pytest.fixture(scope="module")
def sent(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="module")
def docs(sent):
    return read(sent, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def _operators(spark):
    labels = _labels(spark, [(5, 1, 0), (7, 0, 1), (None, 1, 1), (9, None, None)])
    return {
        "quality": lambda d: quality_model.score_quality(d, quality_model.fit(d, labels)),
        "packing": packing.pack,
        "join": ngram_join.jaccard_components,
        "language": language.identify,
        "mixing": mixing.mix,
        "sharding": sharding.shard,
        "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.fit(d, labels)),
        "fingerprints": fingerprints.edit_report,
        "rules": quality_rules.quality_rules,
        "keep_rules": quality_rules.keep_documents,
        "keep_language": lambda d: language.keep_identified(d, 0.3),
        "keep_near": near_duplicates.keep_one_of_each,
        "keep_mix": mixing.mixed_documents,
        "runs": lambda d: runs.periodic_runs(runs.with_periodic_tails(d)),
        "personal_data": lambda d: pii.personal_data(d, pii.fit(d)),
        "words": lambda d: variants.spelling_variants(variants.count_words(d, changed=variants.CHANGED)),
    }


@pytest.mark.parametrize("name", [
    "quality", "packing", "join", "language", "mixing", "sharding", "toxicity", "fingerprints", "rules", "keep_rules", "keep_language", "keep_near", "keep_mix",
    "runs", "personal_data", "words"])
def test_awkward_and_empty_tables(sent, name):
    op = _operators(sent)[name]
    table = sent.createDataFrame(AWKWARD, CLASHING)
    rows = op(table).collect()
    if name == "packing":
        assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 2  # the end id alone
    elif name == "words":
        assert {"words", "brown", "quick", "jumps", "again"} == {r["word"] for r in rows}
    elif not name.startswith("keep"):
        assert len(rows) == len(AWKWARD)
    else:
        assert rows == [] or rows[0].asDict().keys() == dict.fromkeys(table.columns).keys()
    if name == "join":
        comp = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
        assert comp[1] == (0, 1) and comp[2] == (0, 2) and comp[3] == (0, 3) and comp[4] == (1, 4) and comp[6] == (6, 5)
    if name == "keep_near":
        assert sorted(r["doc_id"] for r in rows if r["doc_id"]) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    if name == "language":
        assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (1, 2, 3, 9))
    assert op(sent.createDataFrame([], CLASHING)).collect() == []


def test_join_equals_brute_force(docs, texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}


def test_join_finds_links_in_a_large_near_copy_group(sent):
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    d = sent.createDataFrame(rows, "doc_id bigint, text string")
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(116)} for i, t in rows}
    comp = list(range(300))
    for _ in range(20):
        for a, b in itertools.combinations(range(300), 2):
            if comp[a] != comp[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    comp = [min(comp[a], comp[b]) if c in (comp[a], comp[b]) else c for c in comp]
        break
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(d).collect()}
    low = {c: min(i for i in range(300) if comp[i] == c) for c in set(comp)}
    assert got == {i: low[comp[i]] for i in range(300)}


def test_best_fit_equals_plain_search():
    rng = random.Random(1)
    for _ in range(100):
        sizes = sorted((rng.randint(1, 63) for _ in range(rng.randint(1, 80))), reverse=True)
        left = []
        for s in sizes:
            fits = [r for r in left if r >= s]
            if fits:
                left.remove(min(fits))
                left.append(min(fits) - s)
            else:
                left.append(64 - s)
        seq, off = packing.best_fit(sizes, 64)
        assert max(seq) + 1 == len(left)
        fill = collections.Counter()
        for q, o, s in sorted(zip(seq, off, sizes)):
            assert fill[q] == o
            fill[q] += s
        assert max(fill.values()) <= 64


def test_token_ids_equal_the_library():
    from tokenizers import Tokenizer

    from aerostage.llm.bpe import encode_texts

    path = packing.default_vocabulary()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rng = random.Random(3)
    alpha = list("ab eE' \n.,1é½ñ　漢😀\t'srevl!")
    values = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [r[1] for r in AWKWARD] + ["a\xa0b", "x<|endoftext|>y"]
    ids, bounds = encode_texts(pa.array(values, pa.string()), path)
    for i, v in enumerate(values):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(v or "", add_special_tokens=False).ids, v


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_vocabulary())
    placed = packing.pack(docs).cache()
    by_doc, by_seq = collections.defaultdict(dict), collections.defaultdict(list)
    for r in placed.collect():
        by_doc[r["doc_id"]][r["piece"]] = (r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist())
        by_seq[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for i, t in texts.items():
        want = library.encode(t, add_special_tokens=False).ids + [2]
        got = [x for _, (_, ids) in sorted(by_doc[i].items()) for x in ids]
        assert got == want
        assert len(by_doc[i]) == -(-len(want) // 1024)
    for parts in by_seq.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(placed).collect()}
    assert joined == {s: b"".join(x[2] for x in sorted(p)) for s, p in by_seq.items()}


def test_sharding_laws(docs, texts):
    for block in (16, 8192):  # with and without levels
        rows = sharding.shard(docs, block=block).collect()
        total, groups, slots, weight = collections.Counter(), collections.defaultdict(set), collections.defaultdict(list), collections.Counter()
        for r in rows:
            t = texts[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))
            total[r["shard"]] += r["size"]
            weight[t] += r["size"]
            groups[t].add(r["shard"])
            slots[r["shard"]].append(r["slot"])
        assert all(len(s) == 1 for s in groups.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        spread = max(total.values()) - min(total.values())
        assert set(total) == set(range(8)) and spread <= max(weight.values())
        assert block < 8192 or spread < 0.01 * min(total.values())


def test_fingerprints_of_edits(docs, texts):
    order = sorted(texts)
    anchors = fingerprints.find_anchors(docs)
    rows = {r["doc_id"]: r for r in fingerprints.edit_report(docs).collect()}
    for k, i in enumerate(order):
        a, b = texts[i], texts[order[(k + 1) % len(order)]]
        e = a[:len(a) - len(a) // 2] + b[:len(a) // 2]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(a), hashlib.sha256(e.encode()).hexdigest())
        x, y, z = (set(s.tolist()) for s in fingerprints.spots(pa.array([a, e, b]), anchors))
        like = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert r["near_edited"] == pytest.approx(like(x, y)) and r["near_next"] == pytest.approx(like(x, z))


def test_fingerprint_pairs_equal_brute_force(docs):
    prints = fingerprints.fingerprints(docs).cache()
    by = {}
    for r in prints.where("n_spots > 0").collect():
        by[r["fingerprint"]] = min(by.get(r["fingerprint"], 10**9), r["doc_id"])
    want = set()
    for (f, a), (g, b) in itertools.combinations(by.items(), 2):
        x, y = set(fingerprints.decode(f).tolist()), set(fingerprints.decode(g).tolist())
        if len(x & y) >= 0.75 * len(x | y):
            want.add((min(a, b), max(a, b)))
    assert {(r["a"], r["b"]) for r in fingerprints.near_pairs(prints).collect()} == want


def test_toxicity_neighbours_are_exact(sent):
    d = "/root/testdata/sf0.01"
    index = toxicity.fit(read(sent, d, "documents"), read(sent, d, "labels"))
    rng = np.random.default_rng(5)
    n = int(index.post_doc.max()) + 1
    full = np.zeros((n, len(index.terms)))
    term = np.repeat(np.repeat(np.arange(len(index.terms)), np.diff(index.cells)), np.diff(index.posts))
    full[index.post_doc, term] = index.post_weight
    for _ in range(50):
        t = np.unique(rng.integers(0, len(index.terms), 6))
        w = rng.random(len(t))
        w /= np.linalg.norm(w)
        exact = np.sort(full[:, t] @ w)[::-1][:toxicity.NEIGHBOURS]
        doc, cosine = index.nearest(t, w)
        assert np.allclose(cosine, exact[exact > 0][:len(cosine)]) and len(cosine) == min(toxicity.NEIGHBOURS, int((full[:, t] @ w > 0).sum()))


def test_models_on_held_out_rows(sent):
    d = "/root/testdata/sf0.01"
    found, labels = read(sent, d, "documents"), read(sent, d, "labels")
    r = quality_model.score_quality(found, quality_model.fit(found, labels)).join(labels, "doc_id").where("held_out")
    assert r.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95
    r = toxicity.score_toxicity(found, toxicity.fit(found, labels)).join(labels, "doc_id").where("held_out and toxic = 0")
    assert r.agg(F.avg("predicted")).first()[0] < 0.05
    r = language.identify(found).join(found.select("doc_id", "lang"), "doc_id").where("held_out")
    assert r.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_trees_walk_equals_node_by_node():
    rng = np.random.default_rng(2)
    x = rng.random((400, 4)).astype(np.float32)
    trees = quality_model.grow(x, ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float))
    for row, got in zip(x[:40], trees.score(x[:40])):
        total = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > c[k])
            total += leaf[k - len(f)]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_chat_quotes(sent):
    rows = [
        (1, 0, "a", "Hello there\nhow are you"), (1, 1, "b", "> Hello there\n> how are you\nfine"), (1, 2, "a", "On Monday b wrote:\n> > Hello there\n> fine\ngood"),
        (1, 3, "c", "> hello   THERE\nme too"), (1, 4, "c", "> nobody said this\nodd"), (None, 0, "a", None), (2, None, "a", "x"), (2, 1, "a", "> x\ny"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in chat.link_quotes(sent.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert len(got) == len(rows)
    shape = lambda c, t: (got[c, t]["parent_turn"], got[c, t]["root_turn"], got[c, t]["depth"], got[c, t]["position"], got[c, t]["text"])
    assert shape(1, 0) == (None, 0, 0, 0, "Hello there\nhow are you")
    assert shape(1, 1) == (0, 0, 1, 1, "fine")
    assert shape(1, 2) == (1, 0, 2, 2, "good") and got[1, 2]["quote_levels"] == 2
    assert shape(1, 3) == (0, 0, 1, 3, "me too")
    assert shape(1, 4) == (None, 4, 0, 0, "odd")
    assert shape(2, 1)[:3] == (None, 1, 0)  # a null turn is never a parent
    assert chat.link_quotes(sent.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []


def test_chat_long_thread(sent):
    rows = [(1, t, "a", f"> line {t - 1}\nline {t}" if t else "line 0") for t in range(41)] + [(2, 0, "a", "x"), (2, 1, "b", "> x\ny"), (3, 0, "a", "z")]
    got = {(r["conv_id"], r["turn"]): (r["root_turn"], r["depth"], r["position"]) for r in
           chat.link_quotes(sent.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {(1, t): (0, t, t) for t in range(41)} | {(2, 0): (0, 0, 0), (2, 1): (0, 1, 1), (3, 0): (0, 0, 0)}


def test_chat_restores_conversations(sent):
    conv = read(sent, SF, "conversations")
    got = {(r["conv_id"], r["turn"]): (r["text"], r["parent_turn"]) for r in chat.link_quotes(chat.as_mail(conv)).collect()}
    own, first = {}, {}
    for r in conv.orderBy("conv_id", "turn").collect():
        own[r["conv_id"], r["turn"]] = r["text"]
        for line in r["text"].split("\n"):
            first.setdefault((r["conv_id"], " ".join(line.lower().split())), r["turn"])
    for (c, t), text in own.items():
        votes = collections.Counter(first[c, " ".join(x.lower().split())] for x in own.get((c, t - 1), "").split("\n") if x.strip())
        assert got[c, t] == (text, max(votes, key=lambda o: (votes[o], o)) if votes else None)


def test_rule_order_changes_nothing(texts):
    values = pa.array(list(texts.values()))
    a = quality_rules.cascade(values, quality_rules.RULES)["kept"]
    b = quality_rules.cascade(values, quality_rules.RULES[::-1])["kept"]
    t = quality_rules.Texts(values)
    f = quality_rules.base_figures(t)
    plain = ~quality_rules.base_failed(f)
    for r in quality_rules.RULES:
        plain &= ~r.rejects(t, f)
    assert (a == b).all() and (a == plain).all() and 0 < a.sum() < len(a)


def test_mix_repeats_rows(docs):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    rows = collections.Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert rows == collections.Counter({i: n for i, n in plan.items() if n})


def test_mix_takes_no_row_more_often_than_the_cap(spark):
    """Sources at twice their size: their rows without words stay at two copies as well, as in the query's SQL."""
    import duckdb

    from aerostage.llm.oracle import MIXING

    rows = [(i, "", "a") for i in range(40)] + [(100 + i, "one two three", "a") for i in range(3)]
    rows += [(200 + i, "four five " * 30, "b") for i in range(20)] + [(300 + i, " ", "c") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((r["doc_id"], r["size"], r["copies"], r["taken"]) for r in mixing.mix(docs).collect())
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.sql(f"SELECT doc_id, size, copies, taken FROM ({MIXING})").fetchall())
    assert got == want and max(c for _, _, c, _ in got) == mixing.MAX_REPEAT == 2
    assert mixing.mixed_documents(docs).groupBy("doc_id").count().agg({"count": "max"}).first()[0] == 2


def test_false_hits_do_not_grow_with_languages(sent):
    """A filter sized by the largest language: the chance of a false hit stays below its bound with 3 and 120 languages."""
    from aerostage.llm import language

    rng = random.Random(1)
    for n in (3, 120):
        rows = []
        for k in range(n):
            own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(60)]
            rows += [(len(rows) + j, " ".join(rng.choices(own, k=60)), f"l{k}") for j in range(6)]
        m = language.fit(sent.createDataFrame(rows, "doc_id bigint, text string, lang string"))
        assert len(m.languages) == n and m.false_hits.max() <= (len(language.HASHES) / language.SLOTS) ** len(language.HASHES)


def test_one_training_row_for_each_id(sent):
    docs = sent.createDataFrame([(1, "b"), (1, "a")] * 50 + [(2, "c"), (3, None)], "doc_id bigint, text string")
    labels = _labels(sent, [(1, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 0)])
    got = sorted(map(tuple, quality_model.labelled_sample(docs, labels, "quality", 100, "doc_id", "text").collect()))
    held = {i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert got == [r for r in [(1, "a", 1), (2, "c", 1), (3, None, 0)] if r[0] not in held]
