"""Byte-level BPE ids for a slice of texts at once, equal to the given tokenizers file.

A slice is cut into the tokenizer's own pre-tokens by byte classes (letters, numbers, other signs; a single
blank goes with what follows). Equal pre-tokens are encoded once: those of one length form a matrix and the
lowest-ranked adjacent pair of every row is merged at each step, with pair ranks from one hash table. What
the byte classes can't decide - blanks in a row or at a text's end, apostrophes, characters of three bytes
and more, very long pre-tokens - is given to the tokenizers library itself, as a whole text or word.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa

from aerostage.llm.bytetext import SPACE, U64, Texts

#: Pre-tokens above this many bytes are encoded by the library.
MATRIX_BYTES = 32
#: Bounds of the memory of pre-tokens in each worker: slots (as a power of 2) and ids.
CACHE_BITS, CACHE_IDS = 20, 1 << 23
LETTER, NUMBER, OTHER, BLANK, WHOLE = 1, 2, 3, 4, 5
NONE = np.int32(2**31 - 1)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each single-byte character, and of each code point under 0x800."""
    def kind(c: int) -> int:
        k = unicodedata.category(chr(c))[0]
        return LETTER if k == "L" else NUMBER if k == "N" else OTHER

    two = np.array([kind(c) for c in range(0x800)], np.uint8)
    one = np.full(256, OTHER, np.uint8)
    one[:128] = two[:128]
    one[SPACE] = BLANK
    return one, two


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        as_char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_id = np.array([vocab[as_char[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        self.keys = (a << 32) | b
        self.merged = np.array([vocab[x + y] for x, y in pairs], np.int32)  # by rank
        self.bits = 20
        self.table = np.full(1 << self.bits, -1, np.int32)
        for rank, slot in enumerate(self._slot(self.keys).tolist()):
            while self.table[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.table[slot] = rank
        self.one, self.two = _classes()
        self._forget()

    def _forget(self) -> None:
        """Direct-mapped memory of pre-tokens met in earlier slices: hash, length and place of their ids."""
        self.seen = np.zeros(1 << CACHE_BITS, np.uint64)
        self.seen_size = np.zeros(1 << CACHE_BITS, np.int16)
        self.seen_place = np.zeros(1 << CACHE_BITS, np.int64)
        self.flat = np.zeros(CACHE_IDS, np.int32)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, NONE where they don't merge."""
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        rank = self.table[slot]
        out = np.full(key.shape, NONE, np.int32)
        todo = np.flatnonzero(rank >= 0)
        rank, key, slot = rank[todo], key[todo], slot[todo]
        while len(todo):
            hit = self.keys[rank] == key
            out[todo[hit]] = rank[hit]
            slot = (slot[~hit] + 1) & ((1 << self.bits) - 1)
            todo, key = todo[~hit], key[~hit]
            rank = self.table[slot]
            more = rank >= 0
            todo, key, slot, rank = todo[more], key[more], slot[more], rank[more]
        return out

    def matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of byte ids (n, width): (ids padded to the width, length of each row)."""
        n, width = ids.shape
        out, size = ids.copy(), np.full(n, width, np.int64)
        if width < 2:
            return out, size
        row, cur = np.arange(n), ids
        rank = self.ranks(cur[:, :-1].ravel(), cur[:, 1:].ravel()).reshape(n, width - 1)
        while True:
            at = rank.argmin(1)
            best = rank[np.arange(len(row)), at]
            live = best < NONE
            if not live.all():
                stop = ~live
                out[row[stop], :cur.shape[1]] = cur[stop]
                size[row[stop]] = cur.shape[1]
                row, cur, rank, at, best = row[live], cur[live], rank[live], at[live], best[live]
            if not len(row):
                return out, size
            w = cur.shape[1]
            every = np.arange(len(row))
            if w == 2:
                out[row, 0], size[row] = self.merged[best], 1
                return out, size
            later = np.arange(w - 1)[None, :] > at[:, None]
            cur = np.where(later, cur[:, 1:], cur[:, :-1])
            cur[every, at] = self.merged[best]
            rank = np.where(later[:, : w - 2], rank[:, 1:], rank[:, :-1])
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.ranks(cur[has, at[has] - 1], cur[has, at[has]])
            has = np.flatnonzero(at < w - 2)
            rank[has, at[has]] = self.ranks(cur[has, at[has]], cur[has, at[has] + 1])

    def _library(self, values: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch(values, add_special_tokens=False)]

    def _odd_texts(self, t: Texts) -> np.ndarray:
        """Texts with blanks in a row or at the end, or blanks beyond ASCII: encoded whole by the library."""
        b, n = t.b, len(t.b)
        odd = np.zeros(t.n, bool)
        blank = SPACE[b]
        last = np.zeros(n + 1, bool)
        last[t.off[1:]] = True  # index after a text's end
        bad = blank.copy()
        bad[:-1] &= blank[1:] | last[1:n]
        where = [np.flatnonzero(bad)]
        for lead in (0xC2, 0xE1, 0xE2, 0xE3):
            at = np.flatnonzero(b == lead)
            at = at[at < n - 1]
            x, y = b[at + 1], b[np.minimum(at + 2, n - 1)]
            where.append(at[{0xC2: lambda: (x == 0x85) | (x == 0xA0), 0xE1: lambda: (x == 0x9A) & (y == 0x80),
                             0xE2: lambda: ((x == 0x80) & ((y <= 0x8A) | (y == 0xA8) | (y == 0xA9) | (y == 0xAF))) | ((x == 0x81) & (y == 0x9F)),
                             0xE3: lambda: (x == 0x80) & (y == 0x80)}[lead]()])
        odd[np.searchsorted(t.off, np.concatenate(where), "right") - 1] = True
        return odd

    def _units(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and class of the pre-tokens of all texts, in order."""
        b, n = t.b, len(t.b)
        cls = self.one[b]
        two = np.flatnonzero((b >= 0xC2) & (b < 0xE0))
        two = two[two < n - 1]
        kind = self.two[((b[two] & 0x1F).astype(np.int64) << 6) | (b[two + 1] & 0x3F)]
        cls[two], cls[two + 1] = kind, kind
        starts, ends, _ = t.words()
        apart = np.r_[0, np.cumsum((b == 39) | (b >= 0xE0))]
        special = np.flatnonzero(apart[ends] > apart[starts])
        if len(special):
            step = np.zeros(n + 1, np.int8)
            step[starts[special]] += 1
            np.add.at(step, ends[special], -1)
            cls[np.cumsum(step[:-1], dtype=np.int8) > 0] = WHOLE
        cut = np.ones(n, bool)
        cut[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == BLANK)
        first = t.off[:-1]
        cut[first[first < n]] = True
        before = np.flatnonzero(b == 32)  # a single blank goes with what follows
        before = before[before < n - 1]
        inside = np.ones(n + 1, bool)
        inside[t.off[1:]] = False
        before = before[inside[before + 1] & (cls[before + 1] != BLANK)]
        cut[before + 1] = False
        starts = np.flatnonzero(cut)
        ends = np.r_[starts[1:], n]
        return starts, ends, cls[ends - 1]

    def _fresh(self, t: Texts, us: np.ndarray, ue: np.ndarray, uc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of each) of the pre-tokens at these spans."""
        width, n = ue - us, np.zeros(len(us), np.int64)
        chunks: list[tuple[np.ndarray, np.ndarray]] = []
        easy = (uc != WHOLE) & (width <= MATRIX_BYTES)
        for w in np.unique(width[easy]):
            mine = np.flatnonzero(easy & (width == w))
            ids, n[mine] = self.matrix(self.byte_id[t.b[us[mine][:, None] + np.arange(w)]])
            chunks.append((mine, ids))
        rest = np.flatnonzero(~easy)
        raw = t.b.tobytes() if len(rest) else b""
        own = self._library([raw[us[k]:ue[k]].decode("utf-8", "replace") for k in rest])
        n[rest] = [len(x) for x in own]
        begin = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        for mine, ids in chunks:
            at = np.arange(ids.shape[1])[None, :]
            inside = at < n[mine][:, None]
            out[(begin[mine][:, None] + at)[inside]] = ids[inside]
        for k, x in zip(rest, own):
            out[begin[k]:begin[k] + len(x)] = x
        return out, n

    def encode(self, t: Texts, values) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds of each text); ``values(i)`` gives text i as a string."""
        if not len(t.b):
            return np.zeros(0, np.int32), np.zeros(t.n + 1, np.int64)
        odd = self._odd_texts(t)
        starts, ends, cls = self._units(t)
        text = np.searchsorted(t.off, starts, "right") - 1
        fine = ~odd[text]
        starts, ends, cls, text = starts[fine], ends[fine], cls[fine], text[fine]
        known, first, unit = np.unique(t.span_hash(starts, ends), return_index=True, return_inverse=True)
        slot = (known >> U64(64 - CACHE_BITS)).astype(np.int64)
        new = np.flatnonzero(self.seen[slot] != known)
        size, place = self.seen_size[slot].astype(np.int64), self.seen_place[slot]
        ids, n = self._fresh(t, starts[first[new]], ends[first[new]], cls[first[new]])
        size[new], place[new] = n, self.used + np.cumsum(n) - n
        if self.used + len(ids) <= CACHE_IDS:
            self.flat[self.used:self.used + len(ids)] = ids
            flat = self.flat
            keep = n < 2**15
            self.seen[slot[new[keep]]] = known[new[keep]]  # of two for one slot the last stays, in all three
            self.seen_size[slot[new[keep]]], self.seen_place[slot[new[keep]]] = n[keep], place[new[keep]]
            self.used += len(ids)
        else:
            flat = np.concatenate([self.flat[:self.used], ids])
            self._forget()
        whole = np.flatnonzero(odd)
        length = np.zeros(t.n, np.int64)
        own = self._library([values(int(i)) for i in whole])
        np.add.at(length, text, size[unit])
        length[whole] = [len(x) for x in own]
        bounds = np.r_[0, np.cumsum(length)]
        out = np.empty(bounds[-1], np.int32)
        n = size[unit]
        if len(n):
            begin = np.cumsum(n) - n
            source = np.repeat(place[unit] - begin, n) + np.arange(int(n.sum()))
            got = flat[source]
            if len(whole):
                per = np.zeros(t.n, np.int64)
                np.add.at(per, text, n)
                out[np.repeat(bounds[:-1] - (np.cumsum(per) - per), per) + np.arange(len(got))] = got
            else:
                out = got
        for i, x in zip(whole, own):
            out[bounds[i]:bounds[i + 1]] = x
        return out, bounds


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    return encoder(path).encode(Texts(texts), lambda i: texts[i].as_py() or "")
