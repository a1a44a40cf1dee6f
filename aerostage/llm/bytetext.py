"""Vectorised views of a batch of texts: bytes, words, lines and their hashes as numpy arrays.

A batch is an Arrow string array; its value buffer is used as it is, so no Python string is made per row.
``slices`` cuts a batch into runs of whole texts of about ``limit`` bytes, which bounds every temporary
array by the longest single text. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 20

#: Blank bytes: 0x20 and 0x09-0x0D (fixed by the operators' definition of a word).
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if _POW["n"] < n:
        size = max(n, SLICE_BYTES + 4096)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            out = np.ones(size, np.uint64)
            done = 1
            while done < size:  # doubling: out[done:2*done] = out[:done] * base**done
                step = U64(pow(base, done, 1 << 64))
                take = min(done, size - done)
                out[done:done + take] = out[:take] * step
                done += take
            _POW[key] = out
        _POW["n"] = size
    return _POW["up"], _POW["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, end) runs of rows of about ``limit`` bytes; one row at least."""
    n = len(texts)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < n:
        before = total[at - 1] if at else 0
        end = int(np.searchsorted(total, before + limit, "right"))
        end = min(n, max(at + 1, end), at + 60_000)
        yield at, end
        at = end


class Texts:
    """One slice of texts: ``b`` bytes, ``off`` text bounds (len + 1), ``n`` texts."""

    def __init__(self, texts: pa.Array, table: np.ndarray | None = None):
        if pa.types.is_large_string(texts.type) or texts.null_count:
            texts = pc.fill_null(texts, "").cast(pa.string())
        self.n = len(texts)
        _, offsets, data = texts.buffers()
        off = np.frombuffer(offsets, np.int32, self.n + 1, texts.offset * 4).astype(np.int64) if self.n else np.zeros(1, np.int64)
        lo, hi = (int(off[0]), int(off[-1])) if self.n else (0, 0)
        self.b = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
        self.off = off - lo
        if table is not None:  # bytes replaced one for one, e.g. other signs by blanks
            self.b = table[self.b]
        self._prefix: np.ndarray | None = None
        self._words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self._hash: np.ndarray | None = None

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array in each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each run of non-blank bytes, in order."""
        if self._words is None:
            w = ~SPACE[self.b]
            before = np.zeros(len(w), bool)
            before[1:] = w[:-1]
            edges = self.off[1:-1]
            edges = edges[edges < len(w)]
            before[edges] = False
            starts = np.flatnonzero(w & ~before)
            after = np.zeros(len(w), bool)
            after[:-1] = w[1:]
            after[edges[edges > 0] - 1] = False
            ends = np.flatnonzero(w & ~after) + 1
            text = np.searchsorted(self.off, starts, "right") - 1
            self._words = starts, ends, text
        return self._words

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte span; equal bytes give equal hashes wherever they stand."""
        if self._prefix is None:
            up, _ = _powers(len(self.b) + 1)
            c = np.zeros(len(self.b) + 1, np.uint64)
            np.cumsum(_BYTE[self.b] * up[: len(self.b)], out=c[1:])
            self._prefix = c
        _, down = _powers(len(self.b) + 1)
        c = self._prefix
        return mix((c[ends] - c[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def word_hash(self) -> np.ndarray:
        if self._hash is None:
            s, e, _ = self.words()
            self._hash = self.span_hash(s, e)
        return self._hash

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.words()[2], minlength=self.n) if self.n else np.zeros(0, np.int64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of every run of ``size`` words inside one text."""
        h, text = self.word_hash(), self.words()[2]
        m = len(h) - size + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        acc = np.zeros(m, np.uint64)
        for k in range(size):
            acc = acc * U64(0xD6E8FEB86659FD93) + h[k:k + m]
        at = np.flatnonzero(text[:m] == text[size - 1:])
        return at, mix(acc[at] + U64(size))


def strings(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.string()) if not pa.types.is_string(col.type) else col


def text_slices(batches, name: str = "text", table: np.ndarray | None = None, limit: int = SLICE_BYTES):
    """(batch rows, Texts) over a stream of record batches."""
    for batch in batches:
        texts = strings(batch, name)
        for lo, hi in slices(texts, limit):
            yield batch.slice(lo, hi - lo), Texts(texts.slice(lo, hi - lo), table)
