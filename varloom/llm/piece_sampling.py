"""SentencePiece encoding with sampled segmentations, and lossless decoding.

Every segmentation of a text into the model's pieces is a path through the piece
lattice; a path's weight is the product of its pieces' weights. Forward
filtering sums the weights of all paths that reach each place, backward
sampling then draws a path from the end, each step in proportion to the filtered
weight. Draws come from a counter-based generator seeded by the row key
and the place of the pre-token, so a row's segmentation is the same in any
partitioning, task or retry.

Pieces never cross pre-tokens (see ``pretokens``), so the lattice falls into one per pre-token. The filtered
lattices of distinct pre-tokens are built for a whole block at once and kept per worker (bounded); the draws
of all pre-tokens of a block are made together, a step per piece. A lattice's pieces are found by growing all substrings
together, a character a step; those that begin no piece are dropped at once.

The weight of a piece is ``(rank + 1) ** -alpha`` with its rank in the model (a merge
model has ranks, not probabilities). A character that the model does not know is written as the
byte pieces of its UTF-8 form; so is the mark U+2581 of the text itself, which keeps decoding lossless.

Edge cases: a null text counts as empty (no pieces); texts of any length are done in bounded parts;
equal rows get equal results; a null doc_id
is a key of its own (that of the smallest long); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import id_text
from varloom.llm.hashing import U, mix

CACHE = 250_000     # pre-tokens whose lattice a worker keeps
BLOCK = 1 << 20     # characters drawn at once
UNKNOWN = 0x110000  # units from here on are bytes of unknown characters
_R = 0x9E3779B97F4A7C55
_STEM, _HEAD = U(44), U(46)  # the bits of a hash beyond these number its bucket


class Vocabulary:
    """Pieces by the hash of their characters, their weights, and the bytes of every id."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_ids = np.zeros(256, np.int64)
        self.out: list[bytes] = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
                self.out[i] = bytes([int(names[i][3:5], 16)])
        for i in plain:
            self.out[i] = names[i].replace("▁", " ").encode()
        self.longest = max(len(names[i]) for i in plain)
        self.chars = np.unique(np.array([ord(c) for i in plain for c in names[i]], np.int64))
        rank = {i: r for r, i in enumerate(plain)}
        # pieces by the hashes of their characters: sorted, with the first of every bucket; ids and log weights, then those of bytes
        stems = np.zeros(1 << 64 - int(_STEM), bool)
        hashes, ids = [], []
        for length in range(1, self.longest + 1):
            long = [i for i in plain if len(names[i]) >= length]
            h = self.hash([np.array([ord(names[i][j]) for i in long], np.int64) for j in range(length)])
            stems[h >> _STEM] = True
            same = np.array([len(names[i]) == length for i in long])
            hashes.append(h[same])
            ids.append(np.array(long, np.int64)[same])
        self.stems = stems  # buckets of what pieces begin with
        h, ids = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(h)
        self.known = np.append(h[order], U(2**64 - 1))
        self.head = np.searchsorted(h[order] >> _HEAD, np.arange(1 << 64 - int(_HEAD), dtype=U))
        self.fullest = int(np.bincount(h >> _HEAD).max())
        self.ids = np.concatenate([ids[order], self.byte_ids]).astype(np.int32)
        self.weight = np.concatenate([-alpha * np.log([rank[i] + 1.0 for i in ids[order]]), np.zeros(256)])

    @staticmethod
    def hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), U)
        for c in columns:
            h = mix(h * U(31) + c.astype(U) + U(1))
        return h

    def find(self, unit: np.ndarray, left: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, places in ``ids`` and ``weight``) of all pieces in the units; ``left``: units up to a pre-token's end."""
        out = []
        at, h = np.arange(len(unit)), np.zeros(len(unit), U)
        for length in range(1, self.longest + 1):
            h = mix(h * U(31) + unit[at + (length - 1)].astype(U) + U(1))
            on = np.flatnonzero(self.stems[h >> _STEM])
            at, h = at[on], h[on]
            k = self.head[h >> _HEAD]
            for _ in range(self.fullest - 1):
                k += self.known[k] < h
            hit = np.flatnonzero(self.known[k] == h)
            out.append((length, at[hit], k[hit]))
            on = np.flatnonzero(left[at] > length)
            at, h = at[on], h[on]
            if not len(at):
                break
        raw = np.flatnonzero(unit >= UNKNOWN)
        out.append((1, raw, unit[raw] - UNKNOWN + len(self.known) - 1))
        return out

    def units(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(units of all pre-tokens one after the other, units of each): characters, or a unit per byte of unknown ones.

        A pre-token begins with a mark and its spaces are marks; a mark of the text itself is an unknown character.
        """
        mark = ord("▁")
        chars = np.frombuffer("".join(" " + w for w in words).encode("utf-32-le"), "<u4").astype(np.int32)
        begin = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        other = ~self.letters[chars]
        chars[chars == 32] = mark
        counts = np.ones(len(chars), np.int32)
        if not other.any():
            return chars, np.add.reduceat(counts, begin)
        raw = [chr(c).encode() for c in chars[other].tolist()]
        counts[other] = [len(x) for x in raw]
        unit = np.repeat(chars, counts)
        unit[np.repeat(other, counts)] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + UNKNOWN
        return unit, np.add.reduceat(counts, begin)

    @property
    def letters(self) -> np.ndarray:
        """Which code points are characters of the model; a space stands for the mark, the mark itself is none."""
        if not hasattr(self, "_letters"):
            self._letters = np.zeros(UNKNOWN, bool)
            self._letters[self.chars] = True
            self._letters[ord("▁")] = False
            self._letters[32] = True
        return self._letters


@lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float) -> Vocabulary:
    return Vocabulary(path, alpha)


class Column:
    """An array that grows at its end."""

    def __init__(self, values: np.ndarray):
        self.kept, self.n = values, len(values)

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.kept):
            self.kept = np.concatenate([self.kept[:self.n], np.empty(max(self.n, len(values)), self.kept.dtype)])
        self.kept[self.n:self.n + len(values)] = values
        self.n += len(values)


class Lattices:
    """Filtered lattices of pre-tokens, as arrays over all their nodes.

    Node ``first[w] + t`` stands for the place after ``t`` units of pre-token ``w``. Its arcs
    ``arc_first[node] : arc_first[node + 1]`` hold the pieces that end there: how far back they begin, their id
    and the cumulated probability of being drawn, longest first.
    """

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.first, self.size = Column(np.zeros(0, np.int64)), Column(np.zeros(0, np.int64))
        self.arc_first = Column(np.zeros(1, np.int64))
        self.back, self.ids, self.share = Column(np.zeros(0, np.uint8)), Column(np.zeros(0, np.int32)), Column(np.zeros(0, np.float32))

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of every pre-token; lattices of new ones are built."""
        start = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        fresh = list(itertools.islice(reversed(self.number), len(self.number) - start))
        if fresh:
            self._build(fresh[::-1])
        return out

    def trim(self) -> None:
        """Forget the latest pre-tokens beyond CACHE; common ones are met early and stay."""
        if len(self.number) > CACHE:
            for _ in range(len(self.number) - CACHE):
                self.number.popitem()
            self.number.default_factory = itertools.count(CACHE).__next__
            nodes = int(self.first.kept[CACHE])
            arcs = int(self.arc_first.kept[nodes])
            self.first.n = self.size.n = CACHE
            self.arc_first.n = nodes + 1
            self.back.n = self.ids.n = self.share.n = arcs

    def _build(self, words: list[str]) -> None:
        voc = self.voc
        unit, size = voc.units(words)
        size = size.astype(np.int64)
        n, begin = len(unit), np.cumsum(size) - size  # of units
        inside = np.arange(n) - np.repeat(begin, size)
        # nodes place by place over all new pre-tokens: those of one place, and their arcs, lie together
        place = inside.astype(np.min_scalar_type(int(size.max())))
        node = np.empty(n, np.int64)  # after each unit
        node[np.argsort(place, kind="stable")] = np.arange(n)
        before = np.append(n, node[:-1])  # before each unit; n: the beginning of a pre-token
        before[begin] = n
        found = voc.find(unit, np.repeat(size, size) - inside)
        ends = [node[at + (length - 1)] for length, at, _ in found]
        counts = np.zeros(n, np.int64)
        for end in ends:
            counts[end] += 1
        heads = np.cumsum(counts) - counts
        arcs = int(counts.sum())
        back, piece, source = np.empty(arcs, np.uint8), np.empty(arcs, np.int64), np.empty(arcs, np.int64)
        free = heads.copy()
        for (length, at, k), end in zip(found[::-1], ends[::-1], strict=True):  # the longest piece first: it is the likeliest as a rule
            slot = free[end]
            free[end] += 1
            back[slot], piece[slot], source[slot] = length, k, before[at]

        # forward filtering, place by place; log sums per node
        total = np.full(n + 1, -np.inf)
        total[n] = 0.0
        arc = voc.weight[piece]
        live = np.flatnonzero(counts)  # nodes that a piece ends at
        a = first = 0
        for last in np.searchsorted(live, np.cumsum(np.bincount(place))).tolist():
            if last == first:
                continue
            mine = live[first:last]
            b = int(free[mine[-1]])
            value = arc[a:b]
            value += total[source[a:b]]
            top = np.maximum.reduceat(value, heads[mine] - a)
            total[mine] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts[mine])), heads[mine] - a))
            a, first = b, last
        share = np.exp(arc - np.repeat(total[:n], counts))
        for k in range(1, int(counts.max(initial=0))):  # summed within each node, so that shares do not depend on the block
            at = heads[counts > k] + k
            share[at] += share[at - 1]
        share[free - 1] = 2.0  # the last arc takes what rounding leaves

        # back to pre-token after pre-token
        counts = counts[node]
        ends = np.cumsum(counts)
        order = np.arange(arcs) + np.repeat(heads[node] - ends + counts, counts)
        self.first.add(begin + (self.arc_first.n - 1))
        self.size.add(size)
        self.arc_first.add(ends + self.ids.n)
        self.back.add(back[order])
        self.ids.add(voc.ids[piece[order]])
        self.share.add(share[order])

    def sample(self, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens in order, pieces per pre-token): backward draws, one step per piece."""
        base, arc_first = self.first.kept[words] - 1, self.arc_first.kept
        back, piece, share = self.back.kept, self.ids.kept, self.share.kept
        place = self.size.kept[words]
        active = np.arange(len(words))
        count = np.zeros(len(words), np.int64)
        steps = []
        step = 0
        while len(active):
            r = (mix(seeds[active] + U(step * _R & 0xFFFFFFFFFFFFFFFF)) >> U(40)).astype(np.float32) * np.float32(2.0**-24)
            arc = arc_first[base[active] + place[active]]
            wait = np.flatnonzero(share[arc] <= r)
            while len(wait):
                arc[wait] += 1
                wait = wait[share[arc[wait]] <= r[wait]]
            steps.append((active, piece[arc]))
            count[active] += 1
            left = place[active] - back[arc]
            place[active] = left
            active = active[left > 0]
            step += 1
        end = np.cumsum(count)
        out = np.empty(int(end[-1]) if len(end) else 0, np.int32)
        for k, (who, ids) in enumerate(steps):
            out[end[who] - 1 - k] = ids
        return out, count


@lru_cache(maxsize=2)
def worker_lattices(path: str, alpha: float) -> Lattices:
    """This worker's lattices, kept from task to task."""
    return Lattices(vocabulary(path, alpha))


def decode(ids, voc: Vocabulary) -> bytes:
    """The text of ids: pieces joined, marks as spaces, without the space that encoding puts in front."""
    return b"".join(map(voc.out.__getitem__, ids))[1:]


def _words(text: str) -> list[str]:
    """Pre-tokens of a text in which only spaces count as marks."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    out, at = [], 0
    padded = " " + text
    n = len(padded)
    while at < n:
        end = at
        while end < n and padded[end] == " ":
            end += 1
        nxt = padded.find(" ", end)
        nxt = n if nxt < 0 else nxt
        out.append(padded[at + 1:nxt])
        at = nxt
    return out


def _parts(text: str):
    """(place of the first pre-token, characters, pre-tokens) of a text of any length, cut before a word."""
    at, n, first = 0, len(text), 0
    while n - at > BLOCK:
        cut = text.find(" ", at + BLOCK)
        while 0 <= cut and (text[cut - 1] == " " or cut + 1 >= n or text[cut + 1] == " "):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        words = _words(text[at:cut])
        yield first, cut - at, words
        first += len(words)
        at = cut + 1
    yield first, n - at, _words(text[at:])


def row_seeds(keys: pa.Array, seed: int) -> np.ndarray:
    return mix(keys.fill_null(-1 << 63).to_numpy(zero_copy_only=False).astype(np.int64).view(U) + U(seed * _R & 0xFFFFFFFFFFFFFFFF))


def sample_pieces(docs: DataFrame, model: str, seed: int = 0, alpha: float = 1.0, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (unsigned, of little-endian 32-bit ids), lossless, and the ids.

    ``model``: path of a SentencePiece model with the identity normaliser and byte pieces.
    ``lossless``: the ids decode to the text, byte for byte.
    """
    docs = id_text(docs)
    names = ["doc_id", "n_pieces", "ids_crc32", "lossless"] + ["ids"] * keep_ids
    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + ", ids array<int>" * keep_ids

    def scan(batches):
        lattices = worker_lattices(model, alpha)
        voc = lattices.voc

        def blocks(texts):
            """Parts of one long text, or of many short ones, of about BLOCK characters: (row, place of the first pre-token, pre-tokens)."""
            block, size = [], 0
            for row, text in enumerate(texts):
                for at, chars, words in _parts(text.as_py()):
                    if words:
                        block.append((row, at, words))
                    size += chars
                    if size > BLOCK:
                        yield block
                        block, size = [], 0
            yield block

        for batch in batches:
            n = len(batch)
            count, crc, parts = np.zeros(n, np.int64), [0] * n, [np.zeros(0, np.int32)]
            same = [True] * n
            texts = batch.column(1)
            seeds = row_seeds(batch.column(0), seed)
            done = [0] * n  # bytes of the text that the ids so far gave back
            for block in blocks(texts):
                if not block:
                    continue
                words = [w for *_, ws in block for w in ws]
                draws = np.concatenate([seeds[row] + np.arange(at, at + len(ws), dtype=U) * U(0xD6E8FEB86659FD93) for row, at, ws in block])
                ids, per = lattices.sample(lattices.numbers(words), mix(draws))
                lattices.trim()
                ends = np.cumsum(per)
                a = k = 0
                for row, at, ws in block:
                    k += len(ws)
                    mine = ids[a:ends[k - 1]]
                    a = ends[k - 1]
                    count[row] += len(mine)
                    crc[row] = zlib.crc32(mine.astype("<i4", copy=False), crc[row])
                    back = b"".join(map(voc.out.__getitem__, mine.tolist()))
                    if not at:  # the space that encoding puts in front
                        same[row] &= back[:1] == b" "
                        back = back[1:]
                    same[row] &= memoryview(texts[row].as_buffer())[done[row]:done[row] + len(back)].tobytes() == back
                    done[row] += len(back)
                if keep_ids:
                    parts.append(ids)
            for row in range(n):
                same[row] &= done[row] == texts[row].as_buffer().size
            columns = [batch.column(0), pa.array(count), pa.array(crc, pa.int64()), pa.array(same)]
            if keep_ids:
                offsets = pa.array(np.append(0, np.cumsum(count)), pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts))))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(scan, schema)
