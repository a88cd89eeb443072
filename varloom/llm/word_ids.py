"""Token ids of a lower-casing word-level BPE tokenizer file, by cached words.

The tokenizer's pre-tokens never merge with each other, so a text's ids are its pre-tokens' ids in order. Texts are
laid end to end in blocks of a bounded size; pre-tokens are found, hashed and looked up for a whole block at
once with numpy. Characters below U+0180 (where lower-casing is the library's and NFC changes nothing) follow the
tokenizer's split rule here; a run between white space that holds any other character or an
added token's ``<|`` goes to the library as it is. Each worker keeps the ids of the words and runs it
has met, under two independent 64-bit hashes.

A text of any length is cut at white space into parts of about ``CHUNK`` characters, so memory is
bounded by the longest run without white space.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from varloom.llm.hashing import mix

CACHE = 1 << 19   # words a worker keeps
LONGEST = 64      # UTF-16 units of a kept word
CHUNK = 1 << 18   # characters laid end to end
PLAIN = 0x180     # characters from here on are left to the library
U = np.uint64

SPACE, LETTER, NUMBER, OTHER = range(4)
# Letters, numbers and white space below U+0180 as the tokenizer's split rule sees them (fixed values).
_LETTERS = [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F)]
_NUMBERS = [(0x30, 0x39), (0xB2, 0xB3), (0xB9, 0xB9), (0xBC, 0xBE)]
_SPACES = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0)]
_DOTTED_I = 0x130  # its lower case has two characters
_SHORT, _LONG = "stmd", ("re", "ve", "ll")  # endings split off with their apostrophe (fixed values)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(1 << 16, OTHER, np.uint8)
    for value, ranges in ((LETTER, _LETTERS), (NUMBER, _NUMBERS), (SPACE, _SPACES)):
        for first, last in ranges:
            kind[first:last + 1] = value
    low = np.arange(1 << 16, dtype=np.uint16)
    for c in range(PLAIN):
        if c != _DOTTED_I:
            low[c] = ord(chr(c).lower())
    return kind, low


_KIND, _LOW = _tables()
_FOREIGN = np.arange(1 << 16) >= PLAIN
_FOREIGN[_DOTTED_I] = True
_BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two hashes (fixed values)
_VALUES = [mix(np.arange(1, (1 << 16) + 1, dtype=U) * U(b)) | U(1) for b in _BASES]


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def token_bounds(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased units, start, end, left to the library) of the pre-tokens and runs of a block (UTF-16 units)."""
    n = len(units)
    kind, low = _KIND[units], _LOW[units]
    foreign = _FOREIGN[units]
    mark = np.flatnonzero((units[:-1] == ord("<")) & (units[1:] == ord("|")))
    foreign[mark] = True

    first = np.ones(n, bool)  # a pre-token begins here: another kind than before, or a number
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    after = np.zeros(n + 3, np.uint16)
    after[:n] = low
    quote = np.flatnonzero((units == ord("'")) & first)
    size = np.zeros(len(quote), np.int64)
    for pair in _LONG:
        size[(after[quote + 1] == ord(pair[0])) & (after[quote + 2] == ord(pair[1]))] = 3
    for c in _SHORT:
        size[after[quote + 1] == ord(c)] = 2
    quote, size = quote[size > 0], size[size > 0]
    first[quote + 1] = False
    ends = quote + size
    first[ends[ends < n]] = True
    # what follows a split-off ending is a pre-token of its own, and an apostrophe there begins one in any case

    if foreign.any():
        inside = kind != SPACE
        run = np.cumsum(np.concatenate([[True], inside[1:] & ~inside[:-1]]) if inside[0] else inside & ~np.concatenate([[False], inside[:-1]]))
        hit = np.zeros(run[-1] + 1, bool)
        hit[run[foreign & inside]] = True
        foreign = hit[run] & inside
        first &= ~foreign
        first |= foreign & np.concatenate([[True], ~inside[:-1]])
        low = np.where(foreign, units, low)
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    keep = kind[start] != SPACE
    return low, start[keep], end[keep], foreign[start[keep]]


class WordIds:
    """The ids of words by their hashes: open addressing over arrays, words in the order they came."""

    def __init__(self, path: str, cache: int = CACHE):
        self.tk = tokenizer(path)
        suffix = self.tk.model.end_of_word_suffix or "</w>"
        self.closes = np.zeros(self.tk.get_vocab_size(), bool)  # ids that end a pre-token
        for token, i in self.tk.get_vocab().items():
            self.closes[i] = token.endswith(suffix)
        self.cache = cache
        self.slots = np.full(4 * cache, -1, np.int32)
        self.keys = np.zeros((2, cache), U)
        self.at = np.zeros(cache + 1, np.int64)  # word -> its first id; ends where the next begins
        self.pool = np.zeros(4 * cache, np.uint32)
        self.n = 0

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each word, -1 where it is not kept."""
        size = U(len(self.slots) - 1)
        place = a & size
        out = self.slots[place.astype(np.int64)]
        wrong = np.flatnonzero((out >= 0) & ((self.keys[0][out] != a) | (self.keys[1][out] != b)))
        while len(wrong):
            place[wrong] = (place[wrong] + U(1)) & size
            got = self.slots[place[wrong].astype(np.int64)]
            out[wrong] = got
            wrong = wrong[(got >= 0) & ((self.keys[0][got] != a[wrong]) | (self.keys[1][got] != b[wrong]))]
        return out

    def _enter(self, numbers: np.ndarray) -> None:
        size = U(len(self.slots) - 1)
        place = self.keys[0][numbers] & size
        while len(numbers):
            free = self.slots[place.astype(np.int64)] < 0
            self.slots[place[free].astype(np.int64)] = numbers[free]  # of several for one place the last stays
            left = self.slots[place.astype(np.int64)] != numbers
            numbers, place = numbers[left], (place[left] + U(1)) & size

    def keep(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Add words that are not kept yet; beyond the bound the older half, where the common words are, stays."""
        if self.n + len(a) > self.cache:
            self.n = min(self.n, self.cache // 2)
            self.slots[:] = -1
            self._enter(np.arange(self.n, dtype=np.int32))
            room = self.cache - self.n
            a, b, lengths = a[:room], b[:room], lengths[:room]
            ids = ids[:int(lengths.sum())]
        first, used = self.n, int(self.at[self.n])
        if used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:used], np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[used:used + len(ids)] = ids
        self.n += len(a)
        self.keys[0][first:self.n], self.keys[1][first:self.n] = a, b
        self.at[first + 1:self.n + 1] = used + np.cumsum(lengths)
        self._enter(np.arange(first, self.n, dtype=np.int32))

    def library(self, words: list[str], foreign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words from the library itself: plain words in one call, the others one by one."""
        lengths = np.zeros(len(words), np.int64)
        parts: list = [None] * len(words)
        plain = np.flatnonzero(~foreign)
        if len(plain):
            ids = np.array(self.tk.encode(" ".join([words[i] for i in plain]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(plain):
                raise ValueError("the tokenizer's words do not end with its end-of-word pieces")
            for i, part in zip(plain, np.split(ids, ends[:-1]), strict=True):
                parts[i] = part
        for i in np.flatnonzero(foreign):
            parts[i] = np.array(self.tk.encode(words[i], add_special_tokens=False).ids, np.uint32)
        lengths[:] = [len(p) for p in parts]
        return lengths, np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def block(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start of each pre-token or run, its number of ids) of a block."""
        low, start, end, foreign = token_bounds(units)
        keys = []
        for base, values in zip(_BASES, _VALUES, strict=True):
            power, inverse = _powers(base, 1 << max(len(units) - 1, CHUNK).bit_length())
            total = np.zeros(len(units) + 1, U)
            np.cumsum(values[low] * power[:len(units)], out=total[1:])
            h = (total[end] - total[start]) * inverse[start]
            keys.append(mix(h + ((end - start) * 2 + foreign).astype(U) * U(base)))
        a, b = keys
        number = self.find(a, b)
        missing = np.flatnonzero(number < 0)
        if not len(missing):
            lengths = self.at[number + 1] - self.at[number]
            return _gather(self.pool, self.at[number], lengths), start, lengths
        _, one, same = np.unique(a[missing], return_index=True, return_inverse=True)
        one = missing[one]
        text = low.tobytes()
        words = [text[2 * s:2 * e].decode("utf-16-le", "surrogatepass") for s, e in zip(start[one].tolist(), end[one].tolist(), strict=True)]
        new_lengths, new_ids = self.library(words, foreign[one])
        new_at = np.cumsum(new_lengths) - new_lengths
        known = number >= 0
        lengths = np.zeros(len(number), np.int64)
        at = np.zeros(len(number), np.int64)
        lengths[known] = self.at[number[known] + 1] - self.at[number[known]]
        at[known] = self.at[number[known]]
        used = int(self.at[self.n])
        lengths[missing], at[missing] = new_lengths[same], used + new_at[same]
        ids = _gather(np.concatenate([self.pool[:used], new_ids]), at, lengths)
        short = np.flatnonzero(end[one] - start[one] <= LONGEST)
        self.keep(a[one][short], b[one][short], new_lengths[short], _gather(new_ids, new_at[short], new_lengths[short]))
        return ids, start, lengths


def _gather(pool: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[at : at + length]`` end to end."""
    total = int(lengths.sum())
    step = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return pool[np.repeat(at, lengths) + step]


@lru_cache(maxsize=2)
def worker_ids(path: str) -> WordIds:
    """This worker's cache."""
    return WordIds(path)


def _cut(texts: list[str]) -> Iterator[tuple[int, str]]:
    """(row, part): parts of about CHUNK characters that end before a space."""
    for row, text in enumerate(texts):
        at, n = 0, len(text)
        while True:
            end = at + CHUNK
            if end < n:
                space = text.find(" ", end)
                end = n if space < 0 else space
            yield row, text[at:end]
            at = end
            if at >= n:
                break


def id_parts(texts: list[str], path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids): the ids of every text in order, one or more parts each; a part has about CHUNK characters."""
    words = worker_ids(path)
    waiting: list[tuple[int, str]] = []
    size = 0
    for row, part in _cut(texts):
        waiting.append((row, part))
        size += len(part) + 1
        if size >= CHUNK:
            yield from _block(words, waiting)
            waiting, size = [], 0
    yield from _block(words, waiting)


def _block(words: WordIds, parts: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray]]:
    if not parts:
        return
    raw = [p.encode("utf-16-le", "surrogatepass") for _, p in parts]
    sizes = np.array([len(r) // 2 + 1 for r in raw])  # with the space that follows
    ids, start, lengths = words.block(np.frombuffer(b" \0".join(raw) + b" \0", np.uint16))
    upto = np.concatenate([[0], np.cumsum(lengths)])
    cut = upto[np.searchsorted(start, np.cumsum(sizes))]
    before = 0
    for (row, _), after in zip(parts, cut.tolist(), strict=True):
        yield row, ids[before:after]
        before = after


def id_bytes(text: str, path: str) -> Iterator[bytes]:
    """The ids of a whole text as little-endian unsigned 32-bit integers, in parts of a bounded size."""
    for _, ids in id_parts([text], path):
        yield ids.astype("<u4", copy=False).tobytes()
