"""Quality rules (10): a short-circuit cascade whose order comes from measured cost and selectivity.

The base figures of a document (words, word characters, symbols, repeated lines, words in repeated
3-word windows) are always computed. A document that passes the base rule goes through the cascade. On a
sample every rule runs on every document, which gives its seconds a byte and its share of rejections;
the rules then run in descending order of rejections per second, each only on what the earlier ones left.
A verdict is a conjunction, so the order changes the work and never the result.

The 'capitals' rule counts the letters of every script, so a text without capitals of its own may hold a few Latin ones.

Defined cases: a null or empty text has no words, fails the base rule and is not kept. A null id stays a
row of its own. Repeated rows are judged each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import sys
import time
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import SPACE, Texts, slices, strings

#: Documents in the sample that cost and selectivity are estimated on.
SAMPLE_DOCS = 2_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, np.int8)
_UPPER[65:91], _UPPER[97:123] = 1, -1
_BANG = np.zeros(256, bool)
_BANG[list(b"!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_FIRST = np.ones(256, bool)  # bytes that begin a code point
_FIRST[0x80:0xC0] = False
_IN_WORD = _FIRST & ~SPACE

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each \\n-split line that has a word."""
    cut = np.flatnonzero(t.b == 10)
    starts = np.concatenate([t.off[:-1], cut + 1])
    text = np.concatenate([np.arange(t.n), np.searchsorted(t.off, cut, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[last] = t.off[1:][text[last]]
    w = t.words()[0]
    full = np.searchsorted(w, ends, "left") > np.searchsorted(w, starts, "left")
    return starts[full], ends[full], text[full]


def repeats(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to an earlier one, found at least twice) for each item, by text and hash."""
    order = np.lexsort((h, text)) if len(text) and text[0] != text[-1] else np.argsort(h, kind="stable")
    k, owner = h[order], text[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (owner[1:] == owner[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    again, double = np.empty(len(k), bool), np.empty(len(k), bool)
    again[order], double[order] = same, twice
    return again, double


def base_figures(t: Texts) -> dict[str, np.ndarray]:
    starts, ends, text = t.words()
    ls, le, lt = lines(t)
    again, _ = repeats(lt, t.span_hash(ls, le))
    at, h = t.windows(3)
    _, double = repeats(text[at], h)
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[double] + k] = True
    count = lambda rows: np.bincount(rows, minlength=t.n).astype(np.int64)
    return {
        "n_words": count(text), "word_chars": t.per_text(_IN_WORD[t.b]), "n_symbols": t.per_text(_SYMBOL[t.b]),
        "n_dup_lines": count(lt[again]), "n_repeat_words": count(text[covered]), "n_lines": count(lt),
    }


def base_failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


@dataclass(frozen=True)
class Rule:
    """``rejects(texts, base figures)``: True for each text that breaks the rule."""

    name: str
    rejects: Callable[[Texts, dict[str, np.ndarray]], np.ndarray]


def _top_word(t: Texts, f: dict) -> np.ndarray:
    text, h = t.words()[2], t.word_hash()
    if not len(text):
        return np.zeros(t.n, bool)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])])
    top = np.zeros(t.n, np.int64)
    np.maximum.at(top, text[first], np.diff(np.r_[first, len(h)]))
    return 100 * top > 30 * f["n_words"]


def _few_letters(t: Texts, f: dict) -> np.ndarray:
    s, e, text = t.words()
    total = np.r_[0, np.cumsum(_LETTER[t.b])]
    lettered = np.bincount(text[total[e] > total[s]], minlength=t.n)
    return 10 * lettered < 7 * f["n_words"]


@cache
def _case() -> np.ndarray:
    """By code point: 1 for a capital letter, -1 for any other letter (also of a script without case), 0 for the rest."""
    kinds = {"Lu": 1, "Lt": 1, "Ll": -1, "Lm": -1, "Lo": -1}
    return np.fromiter((kinds.get(unicodedata.category(chr(c)), 0) for c in range(sys.maxunicode + 1)), np.int8, sys.maxunicode + 1)


def _mostly_capitals(t: Texts, f: dict) -> np.ndarray:
    """Capitals are over half of all letters, in every script."""
    sign = _UPPER[t.b]
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        at = np.flatnonzero((t.b >= low) & (t.b < high))
        code = t.b[at].astype(np.int32) & (0x7F >> size)
        for k in range(1, size):
            code = (code << 6) | (t.b[at + k] & 0x3F)
        sign[at] = _case()[code]
    return t.per_text(sign) > 0


RULES = [
    Rule("symbols", lambda t, f: 10 * f["n_symbols"] > 3 * f["n_words"]),
    Rule("word_length", lambda t, f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 15 * f["n_words"])),
    Rule("repeated_lines", lambda t, f: 100 * f["n_dup_lines"] > 30 * f["n_lines"]),
    Rule("capitals", _mostly_capitals),
    Rule("exclamations", lambda t, f: 10 * t.per_text(_BANG[t.b]) > 3 * f["n_words"]),
    Rule("few_letters", _few_letters),
    Rule("top_word", _top_word),
]


def cascade(texts: pa.Array, rules: list[Rule]) -> dict[str, np.ndarray]:
    """Base figures and ``kept`` of one slice of texts; the texts still in play are compacted whenever
    fewer than half of them are left, so a later rule reads only those."""
    t = Texts(texts)
    f = base_figures(t)
    failed = base_failed(f)
    out = f | {"base_failed": failed}
    kept, row, alive = np.zeros(t.n, bool), np.arange(t.n), ~failed
    for rule in rules:
        left = int(alive.sum())
        if not left:
            break
        if 2 * left < len(row):
            row, f = row[alive], {k: v[alive] for k, v in f.items()}
            t, alive = Texts(texts.take(pa.array(row))), np.ones(left, bool)
        alive &= ~rule.rejects(t, f)
    kept[row[alive]] = True
    return out | {"kept": kept}


def rule_order(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS, rules: list[Rule] = RULES) -> list[Rule]:
    """Rules by rejections per second on about ``sample`` documents chosen by a hash of the text; the
    driver gets one row for each rule."""
    by_name = {r.name: r for r in rules}
    total = docs.count()
    if not total:
        return list(rules)
    share = min(1.0, sample / total)

    def measure(batches):
        for batch in batches:
            texts = strings(batch, "text")
            for lo, hi in slices(texts):
                t = Texts(texts.slice(lo, hi - lo))
                f = base_figures(t)
                fresh = ~base_failed(f)
                rows = []
                for r in by_name.values():
                    t._hash = None  # each rule pays for what it alone needs
                    began = time.perf_counter()
                    bad = r.rejects(t, f)
                    rows.append((r.name, float(fresh.sum()), float((bad & fresh).sum()), time.perf_counter() - began))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["rule", "docs", "rejected", "seconds"])

    chosen = docs.select(F.col(text).cast("string").alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit(max(1, int(share * (1 << 20)))))
    seen = (chosen.mapInArrow(measure, "rule string, docs double, rejected double, seconds double")
            .groupBy("rule").agg(F.sum("docs").alias("docs"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect())
    gain = {r["rule"]: (r["rejected"] / max(r["docs"], 1)) / max(r["seconds"], 1e-9) for r in seen}
    return sorted(rules, key=lambda r: (-gain.get(r.name, 0.0), r.name))


SCHEMA = ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean"


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``doc_id``, the base figures, ``base_failed`` and ``kept`` for every row; other columns are not read."""
    order = rule_order(docs, text, rules=rules)
    names = BASE + ["base_failed", "kept"]

    def run(batches):
        for batch in batches:
            texts, ids = strings(batch, "text"), batch.column(0)
            for lo, hi in slices(texts):
                got = cascade(texts.slice(lo, hi - lo), order)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *(pa.array(got[c]) for c in names)], ["doc_id", *names])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def keep_documents(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns unchanged."""
    order = rule_order(docs, text, rules=rules)

    def run(batches):
        for batch in batches:
            texts = strings(batch, text)
            for lo, hi in slices(texts):
                kept = cascade(texts.slice(lo, hi - lo), order)["kept"]
                if kept.any():
                    yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    from aerostage.llm.common import read

    return quality_rules(read(spark, sf_dir, "documents"))
