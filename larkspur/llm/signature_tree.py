"""Signature trees over document bitmaps, and their dual traversal.

A document's bitmap has one bit per leading hash bits of its tokens; its width is a power
of two, a few times the set's size, so a wide map folds exactly to a narrower one (OR of
neighbouring bits).  A tree node holds the OR of its documents' bitmaps, their size range,
label range, and ``spare``: the most tokens any of them has beyond its set bits.  For
documents a, b below nodes A, B the overlap is at most ``min(spare) + |A.bits & B.bits|``;
a node pair is pruned when that, or the size ranges, cannot reach the threshold, or when
all documents below both already carry one and the same label.
"""

from __future__ import annotations

import numpy as np

FANOUT = 4
BITS_PER_TOKEN = 4
LEAST_BITS = 256
PAIR_BYTES = 8 << 20     # bitmap bytes of node pairs compared at once


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The packed bitmap (uint8) of a set of 64-bit hashes."""
    bits = max(LEAST_BITS, 1 << int(BITS_PER_TOKEN * len(tokens) - 1).bit_length())
    on = np.zeros(bits, np.uint8)
    on[(tokens >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)] = 1
    return np.packbits(on)


def fold(maps: np.ndarray, width: int) -> np.ndarray:
    """Packed bitmaps (rows) folded to ``width`` bytes."""
    while maps.shape[1] > width:
        on = np.unpackbits(maps, axis=1)
        maps = np.packbits(on[:, 0::2] | on[:, 1::2], axis=1)
    return maps


def needed(na, nb, num: int, den: int):
    """The least overlap of sets of these sizes with Jaccard similarity >= num / den."""
    return -(-num * (na + nb) // (num + den))


def may_link(na, nb, bits_a: np.ndarray, bits_b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the bitmaps (64-bit words, row by row) leave room for a link."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(axis=1, dtype=np.int64)
    return np.minimum(na - only_a, nb - only_b) >= needed(na, nb, num, den)


class Tree:
    """Levels of nodes over documents of one bitmap width; level 0 holds the documents."""

    def __init__(self, sizes: np.ndarray, labels: np.ndarray, maps: np.ndarray, rows: np.ndarray):
        order = np.lexsort(tuple(maps.T[::-1][-8:]))     # neighbours share their smallest hashes
        bits = np.ascontiguousarray(maps[order]).view(np.uint64)
        n, lab = sizes[order], labels[order]
        self.rows = rows[order]
        spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, n, n, lab, lab, spare)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, l0, l1, s = self.levels[-1]
            at = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.minimum.reduceat(l0, at),
                                np.maximum.reduceat(l1, at), np.maximum.reduceat(s, at)))

    def level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]


def _test(a, b, i: np.ndarray, j: np.ndarray, leaf: bool, num: int, den: int) -> np.ndarray:
    """Which node pairs (i of level a, j of level b) may hold a link."""
    (ba, la, ha, l0a, l1a, sa), (bb, lb, hb, l0b, l1b, sb) = a, b
    ok = ~((l0a[i] == l1a[i]) & (l0b[j] == l1b[j]) & (l0a[i] == l0b[j]))
    ok &= (den * ha[i] >= num * lb[j]) & (den * hb[j] >= num * la[i])
    i, j, at = i[ok], j[ok], np.flatnonzero(ok)
    step = max(1, PAIR_BYTES // (8 * ba.shape[1]))
    for k in range(0, len(i), step):
        p, q = i[k: k + step], j[k: k + step]
        if leaf:
            good = may_link(ha[p], hb[q], ba[p], bb[q], num, den)
        else:
            room = np.minimum(sa[p], sb[q]) + np.bitwise_count(ba[p] & bb[q]).sum(axis=1, dtype=np.int64)
            good = np.minimum(room, np.minimum(ha[p], hb[q])) >= needed(la[p], lb[q], num, den)
        ok[at[k: k + step]] = good
    return ok


def dual_traversal(x: Tree, y: Tree, num: int, den: int):
    """Yields (rows of x, rows of y) arrays of document pairs that may link; x is y: each pair once."""
    top = max(len(x.levels), len(y.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        k, i, j = stack.pop()
        ok = _test(x.level(k), y.level(k), i, j, k == 0, num, den)
        i, j = i[ok], j[ok]
        if k == 0:
            if x is y:
                i, j = i[i != j], j[i != j]
            if len(i):
                yield x.rows[i], y.rows[j]
            continue
        if not len(i):
            continue
        wide = 1 << 14                                   # node pairs expanded at once
        for c in range(0, len(i), wide):
            p, q = _children(x, k, i[c: c + wide], y, j[c: c + wide])
            if x is y:
                p, q = p[p <= q], q[p <= q]
            stack.append((k - 1, p, q))


def _children(x: Tree, k: int, i: np.ndarray, y: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The child pairs, at level k - 1, of node pairs at level k."""
    def below(t: Tree, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if k >= len(t.levels):                           # a shorter tree: its root stays
            return v[:, None], np.ones((len(v), 1), bool)
        c = v[:, None] * FANOUT + np.arange(FANOUT)
        return c, c < len(t.levels[k - 1][1])
    (ci, oi), (cj, oj) = below(x, i), below(y, j)
    shape = (len(i), ci.shape[1], cj.shape[1])
    both = oi[:, :, None] & oj[:, None, :]
    return (np.broadcast_to(ci[:, :, None], shape)[both], np.broadcast_to(cj[:, None, :], shape)[both])


def trees(sizes: np.ndarray, labels: np.ndarray, maps: list[bytes], rows: np.ndarray) -> dict[int, tuple]:
    """Documents grouped by bitmap width (bytes): (sizes, labels, stacked maps, rows)."""
    widths = np.array([len(m) for m in maps])
    out = {}
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[int(w)] = (sizes[at], labels[at], np.frombuffer(b"".join(maps[k] for k in at), np.uint8).reshape(len(at), w),
                       rows[at])
    return out


def candidates(left: dict[int, tuple], right: dict[int, tuple] | None, num: int, den: int):
    """Row pairs that may link: within ``left``, or across ``left`` and ``right``.

    Linked sizes differ by less than a factor of two, so only equal and neighbouring widths meet;
    the wider side folds.
    """
    other = left if right is None else right
    for w, a in left.items():
        mine = Tree(*a)
        for v in (w, 2 * w) if right is None else (w // 2, w, 2 * w):
            if v not in other:
                continue
            if right is None and v == w:
                yield from dual_traversal(mine, mine, num, den)
                continue
            s, lab, m, r = other[v]
            if v == w:
                yield from dual_traversal(mine, Tree(s, lab, m, r), num, den)
            elif v > w:
                yield from dual_traversal(mine, Tree(s, lab, fold(m, w), r), num, den)
            else:
                yield from dual_traversal(Tree(a[0], a[1], fold(a[2], v), a[3]), Tree(s, lab, m, r), num, den)
