"""Vectorised 64-bit hashes of words and word shingles (numpy, inside tasks).

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z
lower-cased, which on UTF-8 is the same as doing it on characters. A word's
hash is a polynomial over random 64-bit byte values, finished with a
64-bit mixer; a shingle combines the hashes of its words.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U = np.uint64
CHUNK = 1 << 17  # bytes hashed at once
_R, _C = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93  # odd multipliers (fixed values)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit multiply-xorshift hash (fixed values)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_R)) | U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_SPACE] = 0
_POW = _powers(_R, CHUNK + 1)
_INV = _powers(pow(_R, -1, 1 << 64), CHUNK + 1)


def _hash_chunk(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start of each word) of one chunk that cuts no word."""
    n = len(a)
    pow_, inv = (_POW, _INV) if n <= CHUNK else (_powers(_R, n), _powers(pow(_R, -1, 1 << 64), n))
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~_SPACE[a]
    d = np.diff(inside)
    s, e = np.flatnonzero(d == 1), np.flatnonzero(d == -1)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE[a] * pow_[:n], out=total[1:])
    h = (total[e] - total[s]) * inv[s]
    return mix(h + (e - s).astype(U) * U(_C)), s


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of a whole text, in order."""
    a = np.frombuffer(data, np.uint8)
    n = len(a)
    if n <= CHUNK:
        return _hash_chunk(a)
    hs, ss, at = [], [], 0
    while at < n:
        end = min(n, at + CHUNK)
        if end < n:  # end just after a space; a longer word is taken whole
            cut = np.flatnonzero(_SPACE[a[at:end]])
            while not len(cut) and end < n:
                nxt = min(n, end + CHUNK)
                cut = np.flatnonzero(_SPACE[a[end:nxt]]) + (end - at)
                end = nxt
            if len(cut):
                end = at + int(cut[-1]) + 1
        h, s = _hash_chunk(a[at:end])
        hs.append(h)
        ss.append(s + at)
        at = end
    return np.concatenate(hs), np.concatenate(ss)


_INSIDE = (~_SPACE).astype(np.uint8).tobytes()
_LOWER = bytes(range(256)).lower()
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U)  # the first n bytes of eight
LONG = 1 << 12


def block_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``words`` gives under other hashes: words are read by eight bytes, not byte by byte, those beyond LONG by a digest."""
    inside = np.zeros(len(data) + 2, np.uint8)
    inside[1:-1] = np.frombuffer(data.translate(_INSIDE), np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    s, n = edges[::2], edges[1::2] - edges[::2]
    text = data.translate(_LOWER) + bytes(8)
    eight = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    h = (eight[s] & _FIRST[np.minimum(n, 8)]) * U(_R) + n.astype(U) * U(_C)
    at, rest = 8, np.flatnonzero((n > 8) & (n <= LONG))
    while len(rest):
        x = h[rest]
        h[rest] = (x ^ (x >> U(29))) * U(_C) + (eight[s[rest] + at] & _FIRST[np.minimum(n[rest] - at, 8)]) * U(_R)
        at += 8
        rest = rest[n[rest] > at]
    for i in np.flatnonzero(n > LONG):
        h[i] = int.from_bytes(blake2b(text[s[i]:s[i] + n[i]], digest_size=8).digest(), "little")
    return mix(h), s


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word shingles, in order; the whole sequence when shorter; none without words."""
    n = len(h)
    if n == 0:
        return h
    w = min(n, k)
    out = np.zeros(n - w + 1, U)
    for j in range(w):
        out = out * U(_C) + h[j:n - w + 1 + j]
    return mix(out + U(w * _R & 0xFFFFFFFFFFFFFFFF))


def set_hash(s: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """Two 64-bit hashes of a set of hashes (any order)."""
    x = mix(s ^ U(_R + seed))
    y = mix(x + U(_C))
    return int(x.sum(dtype=U)), int(y.sum(dtype=U))


def fmix_sum(s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``set_hash`` of every run of ``s``; ``first``: where the runs start."""
    x = mix(s ^ U(_R))
    return np.add.reduceat(x, first), np.add.reduceat(mix(x + U(_C)), first)


SPARSE = 6


class Frequent:
    """Bounded summary of the commonest 64-bit keys of a task (Misra-Gries, batched).

    Keeps at most ``size`` counters; a key with more than rows/size
    occurrences is kept, its count low by rows/size at most. Of every full buffer only keys
    that share a bucket (one of 2^20) with SPARSE - 1 others or more are counted, so a key with fewer than SPARSE occurrences in a
    buffer may be missed there.
    """

    def __init__(self, size: int, buffer: int = 1 << 20):
        self.size, self.buffer = size, buffer
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n >= self.buffer:
            self.flush()

    def flush(self) -> None:
        if not self.n:
            return
        keys = np.concatenate(self.waiting)
        self.waiting, self.n = [], 0
        if len(keys) >= self.buffer:  # keys in sparse buckets are rare: no need to sort them
            bucket = (keys >> U(44)).astype(np.int64)
            keys = keys[np.bincount(bucket, minlength=1 << 20)[bucket] >= SPARSE]
        k, c = np.unique(keys, return_counts=True)
        if len(self.keys):
            k, inverse = np.unique(np.concatenate([self.keys, k]), return_inverse=True)
            c = np.bincount(inverse, np.concatenate([self.counts, c])).astype(np.int64)
        if len(k) > self.size:
            cut = np.partition(c, len(c) - self.size - 1)[len(c) - self.size - 1]
            keep = c > cut
            k, c = k[keep], c[keep] - cut
        self.keys, self.counts = k, c
