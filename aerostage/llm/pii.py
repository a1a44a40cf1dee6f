"""Personal data (13): patterns, and a character-level bidirectional LSTM with a CRF that adds what they miss.

Base spans (email, ip, card, phone) come from fixed patterns over whole texts. They label the training data: windows
around the base spans of a sample of SAMPLE_ROWS documents (by a hash of id and text), SPANS of each kind at most, beside
BACKGROUND windows without any. Spans are shown to the model as found and in other spellings (``respell``: "(at)",
"[.]", dotted or slashed groups, no plus sign, other digits and names), which no pattern finds and the model is to add.

The model reads classes of code points, so it works on any text. Each of two directions keeps SIZE cells; both give
scores of nine tags (outside, first and further character of each kind), and CRF transitions score their order. It
is trained in numpy on the driver by backpropagation and the CRF's forward-backward sums.

Whole texts are cut into windows of WINDOW code points that overlap by OVERLAP, and each is decoded by Viterbi. Where
no tag can outweigh its transitions the best path is surely all outside, and the decoding is skipped. The spans
of all windows of a text are reconciled together: overlapping ones of one kind are united, of different
kinds the surer one stays. An added span must be surer than anything in the held-out background windows, hold
data of its kind when its separators are read as such (``holds``), and touch no base span.

``holds`` is asked first where it is cheap: ``places`` finds the stretches that every span it accepts must touch, and
windows whose spans could neither be added nor meet one that could are not scored. The added spans are those of
scoring every window; a text full of numbers is scored whole.

Defined cases: null and empty texts have no spans. A row without an id is treated like any other. Repeated rows are
reported each. Other columns are not read. Without labelled spans of a kind nothing of that kind is added. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.bytetext import Texts, slices, strings
from aerostage.llm.common import read, saved

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training data: documents, spans of each kind, background windows.
SAMPLE_ROWS, SPANS, BACKGROUND = 20_000, 400, 3_000
SIZE, TRAINED, BATCH, EPOCHS = 10, 96, 64, 4
WINDOW, OVERLAP, BLOCK = 512, 64, 768
CONTEXT = 40

# ---- the patterns --------------------------------------------------------------------------------
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind and start. Each scan is linear in the text: an address is
    searched from its at sign, and number patterns from the first digit of a number."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((0, start, found.end()))
        # characters up to here belong to a match, or can't be in a local part again
        done = found.end() if found else at + 1
        at = text.find("@", done)
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:  # of 16 to 19 digits with a separator between any two
            digits = _NOT_DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return out


_AT = re.compile(r"\s*[\[({<]?\s*(?:@|\bat\b)\s*[\])}>]?\s*", re.I)
_DOT = re.compile(r"\s*[\[({<]?\s*(?:\.|\bdot\b)\s*[\])}>]?\s*", re.I)


def holds(kind: int, span: str) -> bool:
    """Whether a span holds data of its kind when its separators are read as such."""
    if kind == 0:
        return bool(_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", span, 1))))
    if kind == 1:
        parts = _DOT.sub(".", span).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    digits = _NOT_DIGITS.sub("", span)
    if any(c.isalpha() for c in span) or re.search(r"[^0-9]{4}", span):
        return False
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


# what any span that ``holds`` accepts has in it: each pattern allows at least what its kind needs
_DOTS = r"[\s\[({<]*(?:\.|\b[Dd][Oo][Tt]\b)[\s\])}>]*"
_PLACES = (
    re.compile(rf"(?:@|\b[Aa][Tt]\b)[\s\])}}>]*(?:[A-Za-z0-9-]{{65}}|[A-Za-z0-9-]{{1,64}}{_DOTS}[A-Za-z0-9-])"),
    re.compile(rf"[0-9](?:{_DOTS}[0-9]{{1,3}}){{3}}"),
    re.compile(r"[0-9](?:[^0-9A-Za-z]{0,3}[0-9]){7,}"),  # cards and phone numbers: eight digits without a letter between
)


def places(text: str) -> list[tuple[int, int]]:
    """(start, end) stretches of a text such that every span that ``holds`` data of any kind shares a character with one."""
    return [m.span() for pattern in _PLACES for m in pattern.finditer(text)]


def respell(kind: int, span: str, rng: np.random.Generator) -> str:
    """Another spelling of a base span, with other digits."""
    pick = lambda *options: options[rng.integers(len(options))]
    span = re.sub("[0-9]", lambda m: str(rng.integers(10)), span)
    if kind == 0:
        if rng.integers(2):  # other names
            span = re.sub("[A-Za-z]+", lambda m: "".join(map(chr, rng.integers(97, 123, rng.integers(2, 10)))), span)
        local, domain = span.split("@", 1)
        dot = pick(".", ".", " dot ", "(dot)", "[dot]", " [dot] ", "[.]")
        local = local.replace(".", pick(".", dot))
        return local + pick("@", " @ ", " at ", "(at)", "[at]", " (at) ", " [at] ", " AT ", "{at}") + domain.replace(".", dot)
    if kind == 1:
        return span.replace(".", pick(".", "[.]", "(.)", " . ", " dot ", "[dot]"))
    digits = _NOT_DIGITS.sub("", span)
    if kind == 2:
        gap = pick("", " ", "-", ".", "/", "_", " - ")
        return gap.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    gap = pick(" ", "-", ".", "/", "")
    head = pick("+", "00", "", "(+", "+")
    groups = [digits[:-10] or digits[:2], digits[-10:-7], digits[-7:-4], digits[-4:]]
    return head + (")" if head == "(+" else "").join([groups[0], ""]) + gap + gap.join(g for g in groups[1:] if g)


# ---- code points as classes ----------------------------------------------------------------------
PAD, BLANK, DIGIT, LETTER, OTHER = 0, 1, 2, 3, 4
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 5 + 26 + len(_PUNCTUATION)
_CLASS = np.full(256, LETTER, np.uint8)  # bytes from 0xC0 start a code point beyond ASCII, taken as a letter
_CLASS[:128] = OTHER
_CLASS[[32, 9, 10, 11, 12, 13]] = BLANK
_CLASS[48:58] = DIGIT
for _k in range(26):
    _CLASS[65 + _k] = _CLASS[97 + _k] = 5 + _k
for _k, _c in enumerate(_PUNCTUATION):
    _CLASS[ord(_c)] = 31 + _k


def classes(text: str) -> np.ndarray:
    b = np.frombuffer(text.encode(), np.uint8)
    return _CLASS[b[(b & 0xC0) != 0x80]]


# ---- the model -----------------------------------------------------------------------------------
TAGS = 1 + 2 * len(KINDS)


def _logistic(z: np.ndarray) -> None:
    """1 / (1 + exp(z)) in place."""
    np.exp(z, out=z)
    z += 1
    np.reciprocal(z, out=z)


@dataclass
class Tagger:
    """``table`` (2, CLASSES, 4 SIZE): what a class adds to the gates of each direction; ``back`` (2, SIZE, 4 SIZE):
    what the cells add; ``out`` (2, SIZE, TAGS), ``bias``: tag scores; ``step`` (TAGS, TAGS), ``first``: transitions."""

    table: np.ndarray
    back: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    step: np.ndarray
    first: np.ndarray
    least: float = 0.0
    kinds: tuple[int, ...] = ()

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.back, self.out, self.bias, self.step, self.first]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (steps, TAGS, rows) of windows given as classes (steps, rows)."""
        steps, rows = x.shape
        e = np.empty((steps, TAGS, rows), np.float32)
        e[:] = self.bias[:, None]
        # rows lie side by side, so each gate is one block; a gate (tanh(z) + 1) / 2 is 1 / (1 + exp(-2 z))
        z, y, c = np.empty((4 * SIZE, rows), np.float32), np.empty((4 * SIZE, rows), np.float32), np.empty((SIZE, rows), np.float32)
        into, forget, show, new = (z[k * SIZE:(k + 1) * SIZE] for k in range(4))
        h, add = np.empty((SIZE, rows), np.float32), np.empty((TAGS, rows), np.float32)
        for way, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
            table, back = (np.ascontiguousarray(p[way].T * -2, np.float32) for p in (self.table, self.back))
            out = np.ascontiguousarray(self.out[way].T, np.float32)
            h[:] = c[:] = 0
            with np.errstate(over="ignore"):  # an infinite power is a closed gate
                for k in order:
                    np.take(table, x[k], 1, out=z, mode="clip")
                    z += np.matmul(back, h, out=y)
                    _logistic(z)
                    c *= forget
                    new += new  # back to a tanh: 2 / (1 + exp(-2 z)) - 1
                    new -= 1
                    new *= into
                    c += new
                    _logistic(np.multiply(c, -2, out=h))
                    h += h
                    h -= 1
                    h *= show
                    e[k] += np.matmul(out, h, out=add)
        return e

    def may_leave(self, e: np.ndarray) -> np.ndarray:
        """Rows whose best path may have a tag: with the best transitions into, between and out of tags, no less than
        what any real path gains over staying outside."""
        stay = self.step[0, 0]
        into = max(self.step[0, 1:].max() - stay, self.first[1:].max() - self.first[0])
        along, leave = self.step[1:, 1:].max() - stay, max(self.step[1:, 0].max() - stay, 0.0)
        gain = e[:, 1:].max(1) - e[:, 0]
        run = gain[0] + into
        most = run.copy()
        for k in range(1, len(gain)):
            run = np.maximum(run + along, into) + gain[k]
            np.maximum(most, run, out=most)
        return most + leave + 1e-3 >= 0

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Best tags (steps, rows) by Viterbi; rows whose best path is surely all outside are not worked out."""
        steps, _, rows = e.shape
        tags = np.zeros((steps, rows), np.int8)
        open_ = np.flatnonzero(self.may_leave(e))
        if len(open_):
            e = e[:, :, open_]
            best = e[0] + self.first[:, None]
            come = np.empty((steps, TAGS, len(open_)), np.int8)
            for k in range(1, steps):
                ways = best[:, None, :] + self.step[:, :, None]
                come[k] = ways.argmax(0)
                best = ways.max(0) + e[k]
            at = best.argmax(0)
            for k in range(steps - 1, -1, -1):
                tags[k, open_] = at
                at = come[k][at, np.arange(len(open_))] if k else at
        return tags

    def spans(self, x: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(row, kind, start, end, sureness) of the spans in windows of classes (steps, rows)."""
        e = self.emissions(x)
        tags = self.decode(e)
        out = []
        for row in np.flatnonzero(tags.any(0)).tolist():
            own = tags[:, row].astype(int)
            kind = (own - 1) // 2
            inside = own > 0
            starts = np.flatnonzero(inside & np.r_[True, (kind[1:] != kind[:-1]) | (own[1:] % 2 == 1) | ~inside[:-1]])
            for s in starts.tolist():
                t = s + 1
                while t < len(own) and own[t] and kind[t] == kind[s] and own[t] % 2 == 0:
                    t += 1
                margin = e[np.arange(s, t), own[s:t], row] - e[s:t, 0, row]
                out.append((row, int(kind[s]), s, t, float(margin.mean())))
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradient of the mean negative log likelihood of tags ``y`` (steps, rows) for each of ``parts``."""
        steps, rows = x.shape
        e = np.empty((steps, rows, TAGS))
        e[:] = self.bias
        tape = []
        xs = np.stack([x, x[::-1]], 1)  # (steps, 2, rows): the second direction reads backwards
        h, c = np.zeros((2, rows, SIZE)), np.zeros((2, rows, SIZE))
        hs, cs = np.zeros((steps + 1, 2, rows, SIZE)), np.zeros((steps + 1, 2, rows, SIZE))
        zs = np.empty((steps, 2, rows, 4 * SIZE))
        for k in range(steps):
            z = np.stack([self.table[0][xs[k, 0]], self.table[1][xs[k, 1]]]) + h @ self.back
            np.tanh(z, out=z)
            g = (z[:, :, :3 * SIZE] + 1) / 2
            c = g[:, :, SIZE:2 * SIZE] * c + g[:, :, :SIZE] * z[:, :, 3 * SIZE:]
            t = np.tanh(c)
            h = g[:, :, 2 * SIZE:] * t
            zs[k], hs[k + 1], cs[k + 1] = z, h, c
            tape.append((g, t))
        e += hs[1:, 0] @ self.out[0]
        e += (hs[1:, 1] @ self.out[1])[::-1]
        # the CRF, with sums scaled to one at every step
        p = np.exp(e - e.max(2, keepdims=True))
        move, begin = np.exp(self.step), np.exp(self.first)
        a, b, scale = np.empty_like(p), np.ones_like(p), np.empty((steps, rows, 1))
        for k in range(steps):
            a[k] = (a[k - 1] @ move if k else begin) * p[k]
            scale[k] = a[k].sum(1, keepdims=True)
            a[k] /= scale[k]
        for k in range(steps - 1, 0, -1):
            b[k - 1] = (b[k] * p[k] / scale[k]) @ move.T
        share = a * b
        hot = np.eye(TAGS)
        de = (share - hot[y]) / rows
        pairs = (a[:-1].reshape(-1, TAGS).T @ (b[1:] * p[1:] / scale[1:]).reshape(-1, TAGS)) * move
        seen = np.zeros((TAGS, TAGS))
        np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
        d_step, d_first, d_bias = (pairs - seen) / rows, (share[0] - hot[y[0]]).sum(0) / rows, de.sum((0, 1))
        both = np.stack([de, de[::-1]], 1)  # (steps, 2, rows, TAGS)
        d_out = np.einsum("kwrs,kwrt->wst", hs[1:], both)
        d_h_out = np.einsum("kwrt,wst->kwrs", both, self.out)
        dh, dc = np.zeros((2, rows, SIZE)), np.zeros((2, rows, SIZE))
        dzs = np.empty_like(zs)
        for k in range(steps - 1, -1, -1):
            z, (g, t) = zs[k], tape[k]
            dh = dh + d_h_out[k]
            dc = dc + dh * g[:, :, 2 * SIZE:] * (1 - t * t)
            dz = dzs[k]
            dz[:, :, :SIZE] = dc * z[:, :, 3 * SIZE:] / 2
            dz[:, :, SIZE:2 * SIZE] = dc * cs[k] / 2
            dz[:, :, 2 * SIZE:3 * SIZE] = dh * t / 2
            dz[:, :, 3 * SIZE:] = dc * g[:, :, :SIZE]
            dz *= 1 - z * z
            dc = dc * g[:, :, SIZE:2 * SIZE]
            dh = dz @ self.back.transpose(0, 2, 1)
        d_back = np.einsum("kwrs,kwrg->wsg", hs[:-1], dzs)
        d_table = np.zeros(self.table.shape)
        for way in (0, 1):
            one = np.zeros((CLASSES, steps * rows))
            one[xs[:, way].ravel(), np.arange(steps * rows)] = 1
            d_table[way] = one @ dzs[:, way].reshape(-1, 4 * SIZE)
        return [d_table, d_back, d_out, d_bias, d_step, d_first]


def new_tagger(rng: np.random.Generator) -> Tagger:
    t = Tagger(rng.normal(0, 0.3, (2, CLASSES, 4 * SIZE)), rng.normal(0, 0.2, (2, SIZE, 4 * SIZE)), rng.normal(0, 0.3, (2, SIZE, TAGS)),
               np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS))
    t.table[:, :, SIZE:2 * SIZE] += 0.5  # cells keep what they hold at first
    t.bias[0] = 2.0
    return t


def train(examples: list[tuple[str, int, str, str]], background: list[str], seed: int = 13) -> Tagger | None:
    """A tagger from (before, kind, span, after) examples and windows without any span; None without examples."""
    if not examples:
        return None
    rng = np.random.default_rng(seed)
    tagger = new_tagger(rng)
    held, learned = background[::5], [classes(w) for i, w in enumerate(background) if i % 5]
    parts = tagger.parts()
    m, v, count = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0

    def row(before: str, kind: int, span: str, after: str) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.zeros(TRAINED, np.int64), np.zeros(TRAINED, np.int64)
        own = classes(span)[:TRAINED]
        room = TRAINED - len(own)
        head = classes(before)
        head = head[len(head) - min(len(head), int(rng.integers(0, room + 1))):]
        whole = np.concatenate([head, own, classes(after)])[:TRAINED]
        x[:len(whole)] = whole
        y[len(head):len(head) + len(own)] = 2 + 2 * kind
        y[len(head)] = 1 + 2 * kind
        return x, y

    # every kind is shown as often as the others, as found and respelled in turn
    by_kind = [[ex for ex in examples if ex[1] == k] for k in range(len(KINDS))]
    by_kind = [own for own in by_kind if own]
    for epoch in range(EPOCHS):
        rows = []
        for own in by_kind:
            for j in range(2 * SPANS):
                before, kind, span, after = own[(j // 2) % len(own)]
                rows.append(row(before, kind, span if j % 4 == 0 else respell(kind, span, rng), after))
        for x in learned:
            at = int(rng.integers(0, max(1, len(x) - TRAINED // 2)))
            part = x[at:at + TRAINED]
            rows.append((np.r_[part, np.zeros(TRAINED - len(part), np.int64)].astype(np.int64), np.zeros(TRAINED, np.int64)))
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            own = [rows[i] for i in order[at:at + BATCH]]
            x, y = np.stack([r[0] for r in own], 1), np.stack([r[1] for r in own], 1)
            grads = tagger.gradient(x, y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            rate = 0.02 * (1 - (epoch + at / len(rows)) / EPOCHS) + 0.001
            count += 1
            for p, g, mm, vv in zip(parts, grads, m, v):
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                p -= rate * (mm / (1 - 0.9**count)) / (np.sqrt(vv / (1 - 0.99**count)) + 1e-8)
    tagger = Tagger(*(p.astype(np.float32) for p in parts), kinds=tuple(own[0][1] for own in by_kind))
    # spans in windows without any are errors: added ones must be surer than those that would be taken
    for at in range(0, len(held), BLOCK):
        x = np.zeros((WINDOW, len(held[at:at + BLOCK])), np.uint8)
        for k, w in enumerate(held[at:at + BLOCK]):
            own = classes(w)[:WINDOW]
            x[:len(own), k] = own
        wrong = [sure for k, kind, s, e, sure in tagger.spans(x) if holds(kind, held[at + k][s:e])]
        tagger.least = max([tagger.least, *wrong])
    return tagger


# ---- Spark ---------------------------------------------------------------------------------------

def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def training_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[list[tuple[str, int, str, str]], list[str]]:
    """Examples and background windows of about SAMPLE_ROWS documents, chosen by hash; bounded by the parameters."""
    rows = _rows(docs, doc_id, text)
    n = rows.count()
    share = int(min(1.0, SAMPLE_ROWS / max(n, 1)) * (1 << 20))
    key = F.xxhash64("doc_id", "text")
    sample = rows.where(F.pmod(key, F.lit(1 << 20)) < share).select(key.alias("key"), "text").where("text is not null")

    def run(batches):
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), strings(batch, "text").to_pylist()):
                found = base_spans(text)
                for kind, s, e in found:
                    if e - s <= TRAINED // 2:
                        out.append((kind, (key * 31 + s) & 0x7FFFFFFF, text[max(0, s - CONTEXT):s], text[s:e], text[e:e + CONTEXT]))
                # a window by chance, and one around a number or at sign that is no base span
                taken = sorted((s, e) for _, s, e in found)
                odd = [m.start() for m in re.finditer("[0-9@]+", text)]
                places = [key % max(1, len(text))] + ([odd[key % len(odd)]] if odd else [])
                for nth, at in enumerate(places):
                    lo = max(0, at - WINDOW // 2)
                    if text and not any(s < lo + WINDOW and e > lo for s, e in taken):
                        out.append((len(KINDS) + nth, (key * 31 + at) & 0x7FFFFFFF, "", text[lo:lo + WINDOW], ""))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                                                  *(pa.array([r[k] for r in out], pa.string()) for k in (2, 3, 4))], ["kind", "key", "before", "span", "after"])

    made = sample.mapInArrow(run, "kind int, key bigint, before string, span string, after string")
    limits = {k: SPANS for k in range(len(KINDS))} | {len(KINDS): BACKGROUND * 2 // 3, len(KINDS) + 1: BACKGROUND // 3}
    picked = saved(made.groupBy("kind", "before", "span", "after").agg(F.min("key").alias("key")), "windows")  # copies once
    got = []
    for kind, most in limits.items():  # the smallest hashes of each kind
        got += picked.where(F.col("kind") == kind).orderBy("key", "before", "span", "after").limit(most).collect()
    examples = [(r["before"], r["kind"], r["span"], r["after"]) for r in got if r["kind"] < len(KINDS)]
    return examples, [r["span"] for r in got if r["kind"] >= len(KINDS)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Tagger | None:
    return train(*training_windows(docs, doc_id, text))


def reconcile(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, sureness) of one text's windows as disjoint spans."""
    united: list[tuple[int, int, int, float]] = []
    for kind, s, e, sure in sorted(found):
        if united and united[-1][0] == kind and s < united[-1][2]:
            _, s0, e0, sure0 = united[-1]
            united[-1] = (kind, s0, max(e, e0), max(sure, sure0))
        else:
            united.append((kind, s, e, sure))
    kept: list[tuple[int, int, int, float]] = []
    last = -1
    for span in sorted(united, key=lambda r: (r[1], r[2], r[0])):
        if span[1] >= last:
            kept.append(span)
            last = span[2]
        elif span[3] > kept[-1][3]:
            kept[-1] = span
            last = span[2]
    return kept


def model_spans(tagger: Tagger, texts: pa.Array, touching: list[list[tuple[int, int]]] | None = None) -> list[list[tuple[int, int, int, float]]]:
    """Reconciled (kind, start, end, sureness) of each text, in code points. With ``touching``, stretches of each text, at least
    those spans that touch one: windows on a stretch are scored, and any next to a scored one that has a span in their
    overlap (and ever more behind these, so that the rounds stay few). No span of the windows left meets one of those
    scored, so reconciling these alone gives the same."""
    t = Texts(texts)
    point = (t.b & 0xC0) != 0x80
    x = _CLASS[t.b[point]]
    off = np.r_[0, np.cumsum(point)][t.off]
    size = np.diff(off)
    step = WINDOW - OVERLAP
    many = np.where(size > 0, np.maximum(1, -(-(size - OVERLAP) // step)), 0)
    first = np.cumsum(many) - many
    owner = np.repeat(np.arange(t.n), many)
    start = (np.arange(len(owner)) - np.repeat(first, many)) * step
    out: list[list] = [[] for _ in range(t.n)]
    reach = np.arange(WINDOW)[:, None]
    due = np.full(len(owner), touching is None)
    for i, own in enumerate(touching or ()):
        for s, e in own:
            due[first[i] + max(0, (s - WINDOW) // step + 1):first[i] + min(int(many[i]), (e - 1) // step + 1)] = True
    seen, more = due.copy(), 1
    while due.any():
        now, due = np.flatnonzero(due), np.zeros(len(owner), bool)
        for lo in range(0, len(now), BLOCK):
            nth = now[lo:lo + BLOCK]
            own, at = owner[nth], start[nth]
            place = at + reach
            inside = place < size[own]
            w = np.where(inside, x[np.where(inside, off[own] + place, 0)], PAD)
            for row, kind, s, e, sure in tagger.spans(w):
                end = min(int(at[row]) + e, int(size[own[row]]))  # a path may run on behind the text's end
                if int(at[row]) + s < end:
                    out[own[row]].append((kind, int(at[row]) + s, end, sure))
                    head, tail = first[own[row]], first[own[row]] + many[own[row]]
                    if s < OVERLAP and not seen[max(head, nth[row] - 1)]:
                        due[max(head, nth[row] - more):nth[row]] = True
                    if end > at[row] + step and not seen[min(tail - 1, nth[row] + 1)]:
                        due[nth[row] + 1:min(tail, nth[row] + 1 + more)] = True
        due &= ~seen
        seen |= due
        more *= 2
    return [reconcile(found) for found in out]


def all_spans(tagger: Tagger | None, texts: pa.Array) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, added spans) of each text, each by kind and start."""
    out = []
    rows = texts.to_pylist()
    model = model_spans(tagger, texts, [places(text) for text in rows]) if tagger is not None else [[]] * len(rows)
    for text, found in zip(rows, model):
        base = base_spans(text)
        added = []
        for kind, s, e, sure in found:
            if kind not in tagger.kinds or sure <= tagger.least:
                continue
            while s < e and text[s].isspace():
                s += 1
            while s < e and text[e - 1].isspace():
                e -= 1
            if holds(kind, text[s:e]) and not any(s < e0 and e > s0 for _, s0, e0 in base):
                added.append((kind, s, e))
        out.append((base, sorted(added)))
    return out


def personal_data(docs: DataFrame, tagger: Tagger | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, added; by kind as in KINDS, then start; code points) of every row."""
    rows = _rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # a few thousand numbers
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(strings(batch, "text"), "")
            for lo, hi in slices(texts):
                out = []
                for base, added in all_spans(shared.value, texts.slice(lo, hi - lo)):
                    own = sorted([(*s, False) for s in base] + [(*s, True) for s in added])
                    out.append([{"kind": KINDS[k], "start": s, "end": e, "added": new} for k, s, e, new in own])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(out, pa.list_(struct))], ["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint,added:boolean>>")


def op13_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = personal_data(docs, fit(docs))
    named = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: ~s["added"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: (s["kind"] == kind) & ~s["added"])).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(named(base).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
