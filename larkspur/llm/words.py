"""Vectorised word hashes of Arrow text columns.

A byte table decides which bytes are word bytes and how they compare; words
are maximal runs of word bytes inside one text.  Each word gets a 64-bit hash:
a polynomial over per-byte random values, then a mixing step.  All arithmetic
is modulo 2**64 on numpy arrays; a text of any length is worked through in
windows of ``WINDOW`` bytes (cut between words), so memory stays bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
WINDOW = 1 << 20
_PRIME = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
SPACE_BYTES = (0x20, *range(0x09, 0x0E))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64: a bijection that spreads every input bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_values(fold_case: bool = True) -> np.ndarray:
    """A random 64-bit value for each byte; A-Z share those of a-z when folding."""
    v = mix(np.arange(1, 257, dtype=U) * U(_PRIME))
    if fold_case:
        v[0x41:0x5B] = v[0x61:0x7B]
    return v


def non_space() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]``."""
    t = np.ones(256, bool)
    t[list(SPACE_BYTES)] = False
    return t


def alphanumeric() -> np.ndarray:
    """Word bytes of ``[A-Za-z0-9]`` and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = t[0x80:] = True
    return t


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p = np.full(n, _PRIME, U)
    p[0] = 1
    q = np.full(n, pow(_PRIME, -1, 1 << 64), U)
    q[0] = 1
    return np.multiply.accumulate(p), np.multiply.accumulate(q)


class Hasher:
    """Word hashes for one byte table; keeps its power tables between batches."""

    def __init__(self, is_word: np.ndarray, values: np.ndarray):
        self.is_word, self.values = is_word, values
        self.p, self.q = powers(WINDOW + 1)

    def _window(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        a, z = int(starts[0]), int(ends[-1])
        if z - a + 1 > len(self.p):
            self.p, self.q = powers(z - a + 1)
        s = np.zeros(z - a + 1, U)
        np.cumsum(self.values[buf[a:z]] * self.p[: z - a], out=s[1:])
        i, j = starts - a, ends - a
        return mix((s[j] - s[i]) * self.q[i] + (ends - starts).astype(U))

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text index, start, end) of every word; starts and ends are bytes from the text's start."""
        buf, offsets = text_bytes(texts)
        if not len(buf):
            e = np.zeros(0, np.int64)
            return np.zeros(0, U), e, e, e
        w = np.empty(len(buf) + 1, bool)
        w[:-1], w[-1] = self.is_word[buf], False
        first = np.zeros(len(buf) + 1, bool)          # a text starts here
        first[offsets] = True
        begins = w.copy()
        begins[1:] &= ~w[:-1] | first[1:]
        stops = ~w
        stops |= first                                # a word ends before this byte
        stops[1:] &= w[:-1]
        stops[0] = False
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        out = np.empty(len(starts), U)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + WINDOW, side="right")))
            out[i:j] = self._window(buf, starts[i:j], ends[i:j])
            i = j
        return out, doc, starts - offsets[doc], ends - offsets[doc]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each starts (one more entry: the end). A null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, off, data = texts.buffers()
    o = np.frombuffer(off, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]: o[-1]], o - o[0]


def runs(values: np.ndarray, n: int) -> np.ndarray:
    """Bounds (n + 1) of each text's rows in an ascending text-index array."""
    return np.searchsorted(values, np.arange(n + 1))


def shingle_sets(hasher: Hasher, texts: pa.Array, k: int):
    """Each text's set of ``k``-word shingle hashes, ascending.

    A text of 1 to k-1 words has its whole sequence as its one shingle; a text without
    words, or a null, has the empty set.  Yields one array per text.
    """
    factors = mix(np.arange(11, 11 + k, dtype=U)) | U(1)
    h, doc, _, _ = hasher.words(texts)
    bounds = runs(doc, len(texts))
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        n = z - a
        if n == 0:
            yield h[:0]
            continue
        m = min(k, n)
        s = np.full(n - m + 1, m, U)
        for i in range(m):
            s += h[a + i: z - m + 1 + i] * factors[i]
        yield np.unique(mix(s))
