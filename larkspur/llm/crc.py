"""CRC-32 of every n-gram of a batch of texts from running CRCs.

Texts are brought to a normal form (A-Z in lower case, one space between words) and scanned once; what is
kept is the running CRC at each word's end.  CRC-32 without its initial and final inversion is linear
over GF(2): crc(A + B) = shift(crc(A), len(B)) ^ crc(B), where shift feeds zero bytes.  The CRC of any
run of words is therefore its end's running CRC with the shifted one of its start cancelled; the
bytes of a run are not read again, however many runs a word is part of.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The reversed polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
SPACE = 32
CHUNK = 256                  # bytes scanned one after the other; chunks run side by side
SEGMENT = 1 << 20            # bytes whose running CRCs are held at a time


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


BYTE = _byte_table()


def _apply(table: np.ndarray, crc: np.ndarray, row: np.ndarray | int = 0) -> np.ndarray:
    """Operators ``table[row]``, each a lookup per byte of the CRC."""
    at = (np.asarray(row, np.int64) << 10)
    flat = table.reshape(-1)
    return (flat[at + (crc & 255)] ^ flat[at + 256 + ((crc >> 8) & 255)]
            ^ flat[at + 512 + ((crc >> 16) & 255)] ^ flat[at + 768 + (crc >> 24)])


class Shift:
    """Feeds n zero bytes to CRCs: one lookup table of 256 operators per base-256 digit of n."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            t = np.empty((256, 4, 256), np.uint32)
            t[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
            for n in range(1, 256):
                t[n] = self._unit(len(self.levels), t[n - 1])
            self.levels.append(t)
        return self.levels[k]

    def _unit(self, k: int, crc: np.ndarray) -> np.ndarray:
        """256**k zero bytes: one byte, or 255 and one units of the level below."""
        if k == 0:
            return BYTE[crc & 255] ^ (crc >> 8)
        below = self.levels[k - 1]
        return _apply(below, _apply(below, crc, 255), 1)

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        crc, n, k = _apply(self.level(0), crc, n & 255), n >> 8, 1
        while (far := np.flatnonzero(n & 255)).size or n.any():
            crc[far] = _apply(self.level(k), crc[far], n[far] & 255)
            n, k = n >> 8, k + 1
        return crc


SHIFT = Shift()


def prefix_crcs(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Linear CRC of ``data[:e]`` for each e of the ascending ``ends``."""
    out, carry, done = np.zeros(len(ends), np.uint32), np.uint32(0), 0
    for at in range(0, len(data), SEGMENT):
        part = data[at: at + SEGMENT]
        upto = int(np.searchsorted(ends, at + len(part), side="right"))
        rows = -(-len(part) // CHUNK)
        grid = np.zeros(rows * CHUNK, np.uint8)
        grid[:len(part)] = part
        columns = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        crcs, c = np.empty((CHUNK, rows), np.uint32), np.zeros(rows, np.uint32)
        for k in range(CHUNK):                             # all chunks advance by one byte
            c = BYTE[(c ^ columns[k]) & 255] ^ (c >> 8)
            crcs[k] = c
        into = np.append(carry, crcs[-1])                  # running CRC before each chunk, by doubling
        step = 1
        while step < len(into):
            into[step:] = into[step:] ^ SHIFT(into[:-step], np.full(len(into) - step, step * CHUNK))
            step *= 2
        here = ends[done:upto] - at - 1
        row, k = here >> 8, here & 255
        out[done:upto] = SHIFT(into[row], k + 1) ^ crcs[k, row]
        carry, done = into[-1], upto                       # only the last segment can end inside a chunk
    return out


class Words:
    """The normal form of a batch of texts and the running CRC at each word's end."""

    def __init__(self, texts: pa.Array, lower: np.ndarray, separator: np.ndarray):
        # A separator after every text: words end inside it and none runs on into the next text.
        big = pa.large_string()
        ended = pc.binary_join_element_wise(pc.fill_null(texts.cast(big), ""), pa.scalar("", big), pa.scalar(" ", big))
        ended = ended.combine_chunks() if isinstance(ended, pa.ChunkedArray) else ended
        cuts = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset: ended.offset + len(ended) + 1]
        raw = (np.frombuffer(ended.buffers()[2], np.uint8)[cuts[0]: cuts[-1]] if len(ended) else np.zeros(0, np.uint8))
        cuts = cuts - cuts[0] if len(cuts) else np.zeros(1, np.int64)
        word = ~separator[raw]
        after = np.zeros(len(raw), bool)
        after[1:] = word[:-1] & ~word[1:]
        stops = np.flatnonzero(after)                      # first byte behind each word
        self.per_text = np.diff(np.searchsorted(stops, cuts))
        text = np.where(word, lower[raw], np.uint8(SPACE))[word | after]
        self.ends = np.flatnonzero(text == SPACE)
        self.starts = np.append(0, self.ends[:-1] + 1)[:len(self.ends)]
        self.text_of = np.repeat(np.arange(len(self.per_text)), self.per_text)
        self.at_end = prefix_crcs(text, self.ends)
        passed = BYTE[(self.at_end ^ np.uint32(SPACE)) & 255] ^ (self.at_end >> 8)
        self.at_start = np.append(np.uint32(0), passed[:-1])[:len(self.ends)]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, CRC-32) of every run of n words inside one text."""
        if len(self.ends) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        last = slice(n - 1, None)
        first = np.flatnonzero(self.text_of[last] == self.text_of[: len(self.text_of) - n + 1])
        end = first + n - 1
        return first, SHIFT(self.at_start[first] ^ ONES, self.ends[end] - self.starts[first]) ^ self.at_end[end] ^ ONES
