"""op11: runs against a brute-force search, and the query against a plain version of its contract."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from aerostage.llm.bytetext import Texts
from aerostage.llm.common import ship
from aerostage.llm.runs import find_runs, op11_periodic_runs, periodic_runs

BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    for c in BLANKS[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(words):
    """Every maximal stretch of each period, whose smallest period it is."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smallest = next(d for d in range(1, q + 1) if all(words[k] == words[k + d] for k in range(i, i + length - d)))
            if smallest == q and length >= max(6, 4 * q):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def report(doc_id, text):
    words = split(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def some_texts(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < r.choice([3, 12, 60, 200]):
            unit = [r.choice("abc") for _ in range(r.choice([1, 1, 2, 3, 5, 8]))]
            words += unit * r.choice([1, 1, 2, 4, 5, 9]) + unit[:r.randrange(len(unit))]
        out.append(r.choice([" ", "\n", "  \t"]).join(words))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    texts = some_texts(seed, 60) + ["", " \n ", "a" * 5, "a " * 400, "a b " * 90 + "c " * 7]
    t = Texts(pa.array(texts))
    owner = t.words()[2]
    text, start, length, period = find_runs(t.word_hash(), owner, np.searchsorted(owner, np.arange(t.n + 1)))
    got = [[] for _ in texts]
    for k, *run in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[k].append(tuple(run))
    assert got == [brute(split(x)) for x in texts]


def test_long_texts_stay_fast():
    """A period of one word, of many words and a text of two words by chance, 200,000 words each."""
    r = random.Random(5)
    unit = [str(r.randrange(10**6)) for _ in range(700)]
    texts = ["x " * 200_000, " ".join(unit * 285), " ".join(r.choice("ab") for _ in range(200_000))]
    t = Texts(pa.array(texts))
    owner = t.words()[2]
    text, start, length, period = find_runs(t.word_hash(), owner, np.searchsorted(owner, np.arange(t.n + 1)))
    assert (text[0], start[0], length[0], period[0]) == (0, 0, 200_000, 1)
    assert (start[1], length[1], period[1]) == (0, 199_500, 700) and (text[2:] == 2).all()


def test_query_equals_plain_version(spark, tmp_path):
    texts = some_texts(9, 120)
    rows = [(i, x, "extra") for i, x in enumerate(texts)] + [(7, None, None), (8, "", "x"), (None, "a " * 30, "x"), (3, texts[3], "x"), (500, "é ü é " * 9, "x")]
    spark.createDataFrame(rows, "doc_id bigint, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    ship(spark)
    out = op11_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: (str(r[0]), r[6], r[7])
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = sorted((report(i, x) for i, x, _ in rows), key=key)
    assert got == want
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows if i is not None)


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
