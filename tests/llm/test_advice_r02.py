"""Cases of the second review: what each operator did less of than its whole job."""

import random

import numpy as np
import pytest

import corpus_pipeline
from aerostage.llm import chat, language, near_duplicates
from aerostage.llm.common import ship

DOCUMENT = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def sent(spark):
    ship(spark)
    return spark


def _languages(n, docs, words=80):
    """(text, lang) of ``n`` languages: 120 own words each and, as every fourth word, one of 40 that all share."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(2, 3)))
    shared = [word() for _ in range(40)]
    out = []
    for k in range(n):
        own = [word() for _ in range(120)]
        out += [(" ".join(rng.choice(shared if i % 4 == 0 else own) for i in range(words)), f"l{k:03}") for _ in range(docs)]
    return out


@pytest.mark.parametrize("n", [2, 20])
def test_language_stage_with_few_and_many_languages(sent, n):
    rng = random.Random(5)
    clean = _languages(n, 24)
    junk = ["".join(rng.choice("bcdfghjkmqwxzy   ") for _ in range(400)) for _ in range(20)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(clean)] + [(10_000 + i, t, None) for i, t in enumerate(junk)]
    docs = sent.createDataFrame(rows, DOCUMENT)
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language_id"](sent, docs, "").collect()}
    assert kept == set(range(len(clean)))


def test_near_duplicates_keep_one_row_of_each_group(sent):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda t: t + " end"
    rows = [
        (1, a, "s"), (2, near(a), "s"), (2, b, "s"),  # 2: a near copy of 1 and a text of its own
        (3, c, "s"), (3, d, "s"),  # one id, unrelated texts
        (None, e, "s"), (None, e, "s"), (None, near(e), "s"),  # a group without ids
        (None, near(d), "s"),  # a copy without an id of a text with one
        (4, None, "s"), (None, "", "s"), (5, text(), "s"), (5, None, "s"),
    ]
    rows[-1] = (5, rows[-2][1], "s")  # a repeated row
    docs = sent.createDataFrame(rows, DOCUMENT)
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in near_duplicates.keep_one_of_each(docs).collect()))
    left = [x for x in got if x[0] or x[1] not in (e, near(e))]
    assert left == sorted([(1, a), (2, b), (3, c), (3, d), (4, ""), (0, ""), (5, rows[-1][1])])
    assert len(got) - len(left) == 1


def test_language_of_the_rarest_of_150(sent):
    made = _languages(150, 14)
    rows = [(i, t, lang) for i, (t, lang) in enumerate(made)]
    rows += [(100_000 + i, t, lang) for i, (t, lang) in enumerate(made) if lang < "l100"]  # the last 50 are the rarer ones
    got = language.identify(sent.createDataFrame(rows, DOCUMENT)).where("not held_out").collect()
    want = {i: lang for i, _, lang in rows}
    right = np.mean([r["lang_pred"] == want[r["doc_id"]] for r in got])
    rare = np.mean([r["lang_pred"] == want[r["doc_id"]] for r in got if want[r["doc_id"]] >= "l100"])
    assert right > 0.99 and rare > 0.99


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрст", "αβγδεζηθικλμνξοπρσ", "ابتثجحخدذرزسشصضطظع", "가나다라마바사아자차카타파하", "abcdefghijklmnoprs"])
def test_rules_stage_keeps_texts_of_every_script_with_a_capital_word(sent, letters):
    rng = random.Random(9)
    text = " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(70))
    rows = [(1, f"{text} NATO USB", "x"), (2, text, "x"), (3, text.upper(), "x")]
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["quality_rules"](sent, sent.createDataFrame(rows, DOCUMENT), "").collect()}
    assert kept == ({1, 2} if text.upper() != text else {1, 2, 3})


MESSAGE = "conv_id bigint, turn bigint, role string, text string"


def _parents(spark, rows):
    return {(r["conv_id"], r["turn"]): r["parent_turn"] for r in chat.link_quotes(spark.createDataFrame(rows, MESSAGE)).collect()}


def test_chat_links_nested_repeated_and_rewrapped_quotes(sent):
    rows = [
        (1, 0, "a", "first words"), (1, 1, "b", "> first words\nsecond words"), (1, 2, "a", "> > first words\nonly the nested quote is left"),
        (2, 0, "a", "never quoted on level one"), (2, 1, "b", "other"), (2, 2, "c", "> > never quoted on level one\nyes"),
        (3, 0, "a", "ok"), (3, 1, "b", "> ok\nthanks"), (3, 2, "a", "ok"), (3, 3, "b", "> ok\nfine"), (3, 4, "a", "ok"),
        (4, 0, "a", "one long line that a mail\nprogram wraps anew. And more of it."), (4, 1, "b", "> one long line\n> that a mail program wraps\n> anew. And more of it.\nyes"),
        (4, 2, "c", "> one long line that\n> a mail program wraps anew.\nonly the first sentence"),
        (5, 10, "a", "far"), (5, 5_400, "b", "> far\nback"), (5, 5_401, "c", "far"), (5, 5_401, "c", "> far\nsame turn"), (5, 9_000, "c", "> far\nlate"),
    ]
    got = _parents(sent, rows)
    assert (got[1, 1], got[1, 2], got[2, 2]) == (0, 1, 0)
    assert (got[3, 1], got[3, 3], got[3, 4]) == (0, 2, None)
    assert (got[4, 1], got[4, 2]) == (0, 0)
    assert (got[5, 5_400], got[5, 5_401], got[5, 9_000]) == (10, 10, 5_401)


def test_mails_quote_across_ranges_of_turns(sent):
    turns = [0, 1, 999, 1000, 2500, 4000, 4001, 4002]
    rows = [(c, t, "a", f"text {c} {t}") for c in (1, None) for t in turns] + [(2, 0, "a", "x"), (2, 1, "b", "y")]
    got = {(r["conv_id"], r["turn"]): r["text"] for r in chat.as_mail(sent.createDataFrame(rows, MESSAGE)).collect()}
    for c in (1, None):
        for k, t in enumerate(turns):
            quotes = [f"> > text {c} {turns[k - 2]}"] * (k > 1) + [f"> text {c} {turns[k - 1]}"] * (k > 0)
            assert got[c, t] == "\n".join([*quotes, f"text {c} {t}"])
    assert got[2, 1] == "> x\ny" and len(got) == len(rows)
