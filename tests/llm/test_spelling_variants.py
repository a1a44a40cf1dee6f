"""op12: near words against all pairs, and the query against a plain version of its contract."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from aerostage.llm import variants
from aerostage.llm.common import ship
from aerostage.llm.variants import Dictionary, Words, count_words, crc_of_spans, near_words, op12_spelling_variants, spelling_variants


def one_edit(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1:]
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]


def near(words):
    known, letters = set(words), set("".join(words))
    return {w: {v for v in one_edit(w, letters) if v in known and v != w} for w in words}


def some_words(seed, n=500):
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        w = "".join(r.choice(["ab", "na", "é", "ti", "on", "s", "x", "ba"]) for _ in range(r.randrange(2, 7)))
        if len(w) >= 5:
            out.add(w)
            other = r.choice(sorted(one_edit(w, "abé")))
            if len(other) >= 5:
                out.add(other)
    return sorted(out)


@pytest.mark.parametrize("seed, often", [(1, 64), (2, 5), (3, 1)])
def test_near_words_equal_all_pairs(spark, monkeypatch, seed, often):
    monkeypatch.setattr(variants, "GRAM_WORDS", often)  # few words: long grams only with a low threshold
    ship(spark)
    words = some_words(seed)
    got = {(r["a"], r["b"]) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    want = {(min(w, v), max(w, v)) for w, vs in near(words).items() for v in vs}
    assert {(min(p), max(p)) for p in got} == want and len(got) == len(want) > 100


def test_affected_grams_bound_what_an_edit_changes():
    """Every single edit of a word leaves all but the bound of its grams in the edited word's decomposition."""
    r = random.Random(7)
    words = some_words(11, 150)
    sizes = range(variants.QMIN, variants.QMAX + 1)
    grams = Counter(w[i:i + q] for w in words for q in sizes for i in range(len(w) - q + 1))
    kept = [g for g in grams if len(g) == variants.QMIN or grams[g[:-1]] > 8]
    pack = lambda g: int.from_bytes(g.encode("latin-1"), "little")
    d = Dictionary(np.array([pack(g) for g in kept], np.uint64), np.array([grams[g] for g in kept]))
    assert max(map(len, kept)) == variants.QMAX
    split = lambda w: Counter(d.decompose(Words([w]))[2].tolist())
    for word in r.sample(words, 60):
        w = Words([word])
        at, size, number = d.decompose(w)
        bound = int(d.affected(w, at, size, number)[0])
        own = split(word)
        assert max(sum((own - split(v)).values()) for v in one_edit(word, "abnx") if v != word and len(v) > 1) <= bound


def test_checksums_of_spans():
    b = np.frombuffer(b"abc" + b"longer" * 30 + b"x", np.uint8)
    starts, ends = np.array([0, 3, 183, 1]), np.array([3, 183, 184, 1])
    before = np.array([zlib.crc32(b"7:"), 0, zlib.crc32(b"12:"), zlib.crc32(b"0:")], np.uint32)
    want = [zlib.crc32(b"7:abc"), zlib.crc32(b"longer" * 30), zlib.crc32(b"12:x"), zlib.crc32(b"0:")]
    assert crc_of_spans(b, starts, ends, before).tolist() == want


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    links = near(sorted(counts))
    form = {}
    for w, vs in links.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(links[w]), counts[form[w]] if w in form else None))
    return out


def test_query_equals_plain_version(spark, tmp_path):
    r = random.Random(3)
    words = some_words(4, 120) + ["Größe", "GROSSE", "ÀÉÎÕÜ", "ÿÿÿÿÿ", "abc×de"]
    weight = [1 / (k + 1) for k in range(len(words))]
    rows = [(i, r.choice([" ", ", ", "\n", "1"]).join(r.choices(words, weight, k=r.randrange(0, 120)))) for i in range(160)]
    rows += [(3, rows[3][1]), (None, "abandon abandon abandon abandom abandom abandom"), (900, None), (901, ""), (902, "Ā中文абв" * 4), (903, "a" * 300 + " " + "b" * 70)]
    rows += [(910 + k, "chainq " * 3 + "chainqu " * 8 + "chainqus " * 30) for k in range(3)]
    spark.createDataFrame([(*x, "q") for x in rows], "doc_id bigint, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    ship(spark)
    got = op12_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(x) for x in got.collect()]
    want = plain(rows)
    assert len(found) == len(want) and set(found) == want
    assert any(x[2] not in (x[0], x[1]) for x in want), "a chain of two forms"


def test_chains_of_forms_and_no_words(spark):
    ship(spark)
    chain = [("a" * 5 + "b" * k, 3 * 2**k) for k in range(12)]
    got = {r["word"]: r["root"] for r in spelling_variants(spark.createDataFrame(chain, "word string, n bigint")).collect()}
    assert set(got.values()) == {chain[-1][0]} and len(got) == 12
    assert spelling_variants(spark.createDataFrame([], "word string, n bigint")).collect() == []
    assert count_words(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
