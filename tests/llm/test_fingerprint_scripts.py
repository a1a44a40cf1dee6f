"""op9: anchors from the corpus, texts of other scripts and of none, short texts, ids of any type."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from aerostage.llm import fingerprints
from aerostage.llm.bytetext import Texts
from aerostage.llm.common import ship

SCRIPTS = {
    "latin": "abcdefghiklmnoprstuvz", "cyrillic": "абвгдежзиклмнопрстуфхцч", "polish": "aąbcćdeęłńoóśźżwyz", "greek": "αβγδεζηθικλμνξοπρστ",
    "arabic": "ابتثجحخدذرزسشصضطظع", "chinese": "的一是不了人我在有他这中大来上国", "korean": "가나다라마바사아자차카타파하", "code": "abcxyz(){}[];=+-_0123456789",
}


@pytest.fixture(scope="module")
def sent(spark):
    ship(spark)
    return spark


def prose(r, script, words):
    """Words of which a third are the script's ten commonest; Chinese without blanks."""
    letters = SCRIPTS[script]
    common = random.Random(script)
    common = ["".join(common.choices(letters, k=2)) for _ in range(10)]
    out = [r.choice(common) if r.random() < 0.33 else "".join(r.choices(letters, k=r.randrange(3, 8))) for _ in range(words)]
    return ("" if script == "chinese" else " ").join(out)


def one_word(r, script, text):
    """The text with one word replaced (of Chinese: two characters)."""
    if script == "chinese":
        at = r.randrange(len(text) // 3, len(text) // 2)
        return text[:at] + "新的" + text[at + 2:]
    words = text.split()
    words[r.randrange(len(words) // 3, len(words) // 2)] = "Qwxq"
    return " ".join(words)


@pytest.mark.parametrize("with_anchors", [True, False])
def test_near_copies_in_every_script_stay_alike(sent, with_anchors):
    r = random.Random(5)
    made = [(s, prose(r, s, 90)) for s in SCRIPTS for _ in range(40)]
    anchors = fingerprints.find_anchors(sent.createDataFrame([(i, t) for i, (_, t) in enumerate(made)], "doc_id bigint, text string"))
    assert len(anchors) > 40
    anchors = anchors if with_anchors else anchors[:0]
    for s, text in made[::3]:
        a, b, c = fingerprints.spots(pa.array([text, one_word(r, s, text), prose(r, s, 90)]), anchors)
        assert fingerprints.compared(a, b) > 0.7, (s, len(a))
        assert fingerprints.compared(a, c) < 0.3
        assert len(a) >= 10


def test_anchors_are_the_words_of_most_documents(sent):
    r = random.Random(2)
    texts = [prose(r, s, r.randrange(1, 60)) for s in ("latin", "cyrillic") for _ in range(120)] + [None, "", "?!", "один common"]
    got = set(fingerprints.find_anchors(sent.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)).tolist())
    counts, size = defaultdict(Counter), Counter()
    for t in texts:
        words = set((t or "").replace("?!", "").split())
        for script in {w[0] > "z" for w in words}:
            size[script] += 1
            counts[script].update(w for w in words if (w[0] > "z") == script)
    for script, n in counts.items():
        least = max(fingerprints.LEAST_DOCS, -(-size[script] // fingerprints.ANCHOR_SHARE))
        ranked = sorted(n.values(), reverse=True)[:fingerprints.ANCHORS]
        own = [w for w in n if int(Texts(pa.array([w])).word_hash()[0]) in got]
        assert sorted((n[w] for w in own), reverse=True) == [k for k in ranked if k >= least]


def test_short_and_odd_texts():
    none = np.zeros(0, np.uint64)
    a, b, c, d, e, f = fingerprints.spots(pa.array(["hello brave world", "hello brave worlds", "?!?", "", None, "x"]), none)
    assert fingerprints.compared(a, b) > 0.7 and len(c) and len(f) and not len(d) and not len(e)
    one, two = fingerprints.spots(pa.array(["same text here", "same text here"]), none)
    assert (one == two).all()


def test_tokens_equal_a_plain_split():
    texts = ["The “quick” Fox—1st", "中文 words，混合。テスト", "กขค abc", "", "Ünï ÇÖDE", "a" + "漢" * 3 + "b"]
    w = fingerprints.Tokens(pa.array(texts))
    raw = w.t.b.tobytes()
    got = [(int(t), raw[s:e].decode()) for t, s, e in zip(w.text, w.start, w.end)]
    want = []
    for i, text in enumerate(texts):
        word = ""
        for c in text.lower() + " ":
            alone = any(lo <= ord(c) <= hi for lo, hi in fingerprints.UNSPACED)
            sign = any(lo <= ord(c) <= hi for lo, hi in fingerprints.PUNCTUATION) or (c < "\x80" and not c.isalnum())
            if (alone or sign) and word:
                want.append((i, word))
                word = ""
            if alone:
                want.append((i, c))
            elif not sign:
                word += c
    assert got == want


def test_text_ids_follow_each_other(sent):
    r = random.Random(9)
    rows = [(f"id{r.randrange(10**6)}é"[: r.randrange(3, 9)], prose(r, "latin", 12)) for _ in range(150)] + [(None, "no id"), (None, "another")]
    out = fingerprints.edit_report(sent.createDataFrame(rows, "doc_id string, text string")).collect()
    order = sorted(rows, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    import hashlib

    want = Counter()
    for k, (i, a) in enumerate(order):
        b = order[(k + 1) % len(order)][1]
        want[i, hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest()] += 1
    assert Counter((x["doc_id"], x["edited_sha256"]) for x in out) == want
