"""Suffix sorting by induction, with queues that go to disk.

The suffixes of a string fall into L (larger than the next suffix) and S (smaller); an S suffix after
an L suffix is a seed. Sorted seeds induce all L suffixes in one ascending
scan and these all S suffixes in one descending scan: whoever comes out of the
queue puts its left neighbour into the queue of that neighbour's symbol. As the scan goes in
order, a queue per symbol that is first in, first out is a priority queue on
(symbol, rank). Seeds are sorted by inducing from their unsorted order, naming
equal seed substrings alike and recursing on the string of names.

Over bytes the queues hold arrays and are worked through a queue at a time;
beyond ``memory`` bytes their arrays are kept in an unnamed temporary file of the task. Strings of names
have many symbols with few suffixes each and use plain lists.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 128 << 20


class DiskQueues:
    """A first-in, first-out queue of int32 arrays per symbol; beyond ``memory`` bytes they are kept on disk."""

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.queues: list[list] = [[] for _ in range(symbols)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbol: int, values: np.ndarray) -> None:
        if self.held + values.nbytes > self.memory:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            self.queues[symbol].append((self.file.tell(), len(values)))
            self.file.write(values.tobytes())
        else:
            self.held += values.nbytes
            self.queues[symbol].append(values)

    def pop(self, symbol: int) -> np.ndarray | None:
        """All that is in a symbol's queue, in order."""
        parts, self.queues[symbol] = self.queues[symbol], []
        if not parts:
            return None
        out = []
        for x in parts:
            if isinstance(x, tuple):
                self.file.seek(x[0])
                x = np.frombuffer(self.file.read(4 * x[1]), np.int32)
            else:
                self.held -= x.nbytes
            out.append(x)
        return out[0] if len(out) == 1 else np.concatenate(out)


def types(t: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last symbol is the unique smallest."""
    d = np.sign(np.diff(t.astype(np.int64)))
    n = len(t)
    at = np.where(d != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]  # the next position where neighbours differ
    out = np.ones(n, bool)
    out[:-1] = np.append(d, 1)[nxt] > 0
    return out


def _induced_bytes(t: np.ndarray, s: np.ndarray, seeds: np.ndarray, symbols: int, memory: int) -> np.ndarray:
    """All suffixes in order from seeds in order (arrays, a queue at a time)."""
    first = t[seeds]
    bounds = np.searchsorted(first, np.arange(symbols + 1))

    def put(queues, batch, wanted):
        p = batch[batch > 0] - 1
        p = p[s[p] == wanted]
        if not len(p):
            return
        c = t[p].astype(np.uint16)
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        cuts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(c)), strict=True):
            queues.push(int(c[a]), p[a:b])

    large, found = DiskQueues(symbols, memory), DiskQueues(symbols, memory)
    for c in range(symbols):
        while (batch := large.pop(c)) is not None:
            found.push(c, batch)
            put(large, batch, False)
        put(large, seeds[bounds[c]:bounds[c + 1]], False)
    small, out = DiskQueues(symbols, memory), []
    small.push(int(t[-1]), np.array([len(t) - 1], np.int32))
    for c in range(symbols - 1, -1, -1):
        mine = []
        while (batch := small.pop(c)) is not None:
            mine.append(batch)
            put(small, batch, True)
        ascending = found.pop(c)
        if mine:
            out.append(np.concatenate(mine))
        if ascending is not None:
            put(small, ascending[::-1], True)
            out.append(ascending[::-1])
    return np.concatenate(out)[::-1]


def _induced_names(t: list[int], s: list[bool], seeds: list[int], symbols: int) -> list[int]:
    """The same for many symbols: plain lists."""
    start: list[list[int]] = [[] for _ in range(symbols)]
    for i in seeds:
        start[t[i]].append(i)
    large: list[list[int]] = [[] for _ in range(symbols)]
    for c in range(symbols):
        for group in (large[c], start[c]):
            for i in group:  # grows while it is read
                p = i - 1
                if i and not s[p]:
                    large[t[p]].append(p)
    small: list[list[int]] = [[] for _ in range(symbols)]
    small[t[-1]].append(len(t) - 1)
    for c in range(symbols - 1, -1, -1):
        for group in (small[c], large[c][::-1]):
            for i in group:
                p = i - 1
                if i and s[p]:
                    small[t[p]].append(p)
    out: list[int] = []
    for c in range(symbols):
        out += large[c]
        out += small[c][::-1]
    return out


def suffix_array(t: np.ndarray, symbols: int, memory: int = MEMORY) -> np.ndarray:
    """Suffixes of ``t`` in order. The last symbol must be the unique smallest one."""
    n = len(t)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    s = types(t)
    seeds = np.flatnonzero(s[1:] & ~s[:-1]).astype(np.int32) + 1

    def induced(order):
        if symbols <= 512:
            return _induced_bytes(t, s, order, symbols, memory)
        return np.array(_induced_names(t.tolist(), s.tolist(), order.tolist(), symbols), np.int32)

    rough = induced(seeds[np.argsort(t[seeds], kind="stable")])
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    ordered = rough[is_seed[rough]]
    # name the seed substrings: from a seed to the next one, both included
    number = np.empty(n, np.int32)
    number[seeds] = np.arange(len(seeds))
    ends = np.append(seeds[1:], n - 1)[number[ordered]]
    length = ends - ordered + 1
    differs = np.ones(len(ordered), bool)
    same = np.flatnonzero(length[1:] == length[:-1])
    for k in range(int(length.max()) if len(length) else 0):
        same = same[length[same] > k]
        if not len(same):
            break
        equal = t[ordered[same] + k] == t[ordered[same + 1] + k]
        done = same[equal & (length[same] == k + 1)]
        differs[done + 1] = False
        same = same[equal]
    names = np.cumsum(differs) - 1
    reduced = np.empty(len(seeds), np.int32)
    reduced[number[ordered]] = names
    if len(names) and names[-1] + 1 < len(seeds):
        seeds = seeds[suffix_array(reduced, int(names[-1]) + 1, memory)]
    else:
        seeds = ordered
    return induced(seeds)
