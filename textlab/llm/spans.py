"""Words of UTF-8 byte buffers as NumPy spans with 64-bit hashes.

All functions work on the concatenated texts of a chunk: ``u8`` are the bytes,
``offs`` the row offsets (length rows + 1, starting at 0).
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Weight of a byte by its place in the word, repeating after 65,536 bytes.
_PLACE = _rng.integers(1, 2**63, (2, 1 << 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Bytes of words that end at white space: all but [\x20\x09-\x0D].
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words that end at white space and ASCII punctuation.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = True
for _a, _b in ("09", "AZ", "az"):
    ALNUM[ord(_a):ord(_b) + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the published SplitMix64 constants)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(u8: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes within rows."""
    if not len(u8):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = inside[u8]
    st = np.empty_like(w)
    st[0] = w[0]
    np.logical_and(w[1:], ~w[:-1], out=st[1:])
    cut = offs[(offs > 0) & (offs < len(u8))]
    st[cut] = w[cut]
    en = np.empty_like(w)
    en[-1] = w[-1]
    np.logical_and(w[:-1], ~w[1:], out=en[:-1])
    en[cut - 1] = w[cut - 1]
    return np.flatnonzero(st), np.flatnonzero(en) + 1


#: Bytes hashed at a time, so that temporary arrays stay in the cache.
_BLOCK = 1 << 15


def span_hash(u8: np.ndarray, starts: np.ndarray, ends: np.ndarray, *which: int) -> tuple[np.ndarray, ...] | np.ndarray:
    """64-bit hash of every (non-empty, disjoint, ascending) span, under each
    hash function of ``which`` (the first by default)."""
    which = which or (0,)
    lens = (ends - starts).astype(np.int32)
    out = [np.empty(len(starts), np.uint64) for _ in which]
    total = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=total[1:])
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + _BLOCK, "right")) - 1)
        n = lens[lo:hi]
        heads = (total[lo:hi] - total[lo]).astype(np.int32)
        place = np.arange(int(total[hi] - total[lo]), dtype=np.int32)
        gap = (starts[lo:hi] - starts[lo]).astype(np.int32) - heads
        byte = u8[starts[lo]:ends[hi - 1]]
        if gap[-1]:
            byte = byte[place + np.repeat(gap, n)]
        place -= np.repeat(heads, n)
        place &= 0xFFFF
        for k, f in enumerate(which):
            v = _BYTE[f].take(byte)
            v *= _PLACE[f].take(place)
            out[k][lo:hi] = np.add.reduceat(v, heads)
        lo = hi
    out = [mix(x + lens.astype(np.uint64)) for x in out]
    return out[0] if len(which) == 1 else tuple(out)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Ordered hash of every k consecutive items (length len(h) - k + 1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = h[:n].copy()
    for j in range(1, k):
        s = mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return s


class UnitStore:
    """Token ids of text units, kept by a 64-bit hash and checked by a second.

    ``encode_new(u8, starts, ends)`` gives (flat ids, counts) of units that are
    not kept yet. The store empties when it holds more than ``most`` units, so
    its memory is bounded; ids never depend on what is kept.
    """

    def __init__(self, encode_new, most: int = 1_200_000):
        self.encode_new, self.most = encode_new, most
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.check = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def ids(self, u8: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids of all units in order, ids of each unit)."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        h, c = span_hash(u8, starts, ends, 0, 1)
        uniq, first, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.key) + len(uniq) > self.most:
            self.clear()
        pos = np.searchsorted(self.key, uniq)
        hit = np.zeros(len(uniq), bool)
        inner = pos < len(self.key)
        hit[inner] = self.key[pos[inner]] == uniq[inner]
        if (c != c[first][inv]).any() or (self.check[pos[hit]] != c[first][hit]).any():
            flat, n = self.encode_new(u8, starts, ends)  # two units share a hash: keep nothing
            return np.asarray(flat, np.int32), np.asarray(n, np.int64)
        new = ~hit
        if new.any():
            order = np.argsort(first[new], kind="stable")
            where = first[new][order]
            flat, n = self.encode_new(u8, starts[where], ends[where])
            n = np.asarray(n, np.int64)
            at = len(self.flat) + np.cumsum(n) - n
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            self.flat = np.concatenate([self.flat, np.asarray(flat, np.int32)])
            put = pos[new]
            self.key = np.insert(self.key, put, uniq[new])
            self.check = np.insert(self.check, put, c[first][new])
            self.at = np.insert(self.at, put, at[back])
            self.n = np.insert(self.n, put, n[back])
            pos = np.searchsorted(self.key, uniq)
        from textlab.llm.shared import ragged
        at, n = self.at[pos][inv], self.n[pos][inv]
        return self.flat[ragged(at, n)], n
