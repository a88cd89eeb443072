"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and shares over a whole text (characters, words, lines). The
model is a sum of lookup tables, one per feature and one per chosen pair of
features, over quantile bins; tables are learned by cyclic boosting of shallow
trees on the bins (logistic loss), first one feature at a time, then pairs picked by the gain of one tree on the
residual gradients. Scoring bins the features and adds table entries, vectorised.

The model is fitted on a bounded sample of labelled rows (``max_rows``, the smallest
by a hash of the id); features are computed for those rows only. Scoring covers every row.

Edge cases: a null text counts as empty; the empty text has features of
zero and a score like any other; without usable labels every score is 0.5; several labels of one id
count as several rows; null labels are ignored; repeated rows give a row each; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import id_text
from varloom.llm.hashing import words

MAX_ROWS = 50_000
FEATURES = [
    "log_bytes", "log_words", "mean_word", "upper", "digit", "space", "punct", "bang", "symbol", "bar", "non_ascii",
    "distinct_words", "repeats", "top_word", "words_per_line", "distinct_lines", "short_lines", "sentence_ends", "capital_words",
]
_LETTERS = np.zeros((8, 256), bool)  # rows: upper, digit, space, punctuation, bang, symbol, bar, beyond ASCII
_LETTERS[0, 65:91] = True
_LETTERS[1, 48:58] = True
_LETTERS[2, [32, 9, 10, 11, 12, 13]] = True
_LETTERS[3, [ord(c) for c in ".,;:?'\"()-"]] = True
_LETTERS[4, ord("!")] = True
_LETTERS[5, [ord(c) for c in "#$%&*@^~<>{}[]\\/_+="]] = True
_LETTERS[6, ord("|")] = True
_LETTERS[7, 128:] = True


def features(data: bytes) -> np.ndarray:
    """The features of one whole text."""
    out = np.zeros(len(FEATURES))
    a = np.frombuffer(data, np.uint8)
    n = len(a)
    if not n:
        return out
    counts = np.bincount(a, minlength=256)
    h, at = words(data)
    w = len(h)
    lines = data.split(b"\n")
    out[0], out[1] = np.log1p(n), np.log1p(w)
    out[3:11] = _LETTERS @ counts / n
    if w:
        _, times = np.unique(h, return_counts=True)
        out[2] = (n - counts[_LETTERS[2]].sum()) / w
        out[11] = len(times) / w
        out[12] = np.count_nonzero(h[1:] == h[:-1]) / w
        out[13] = times.max() / w
        out[18] = np.count_nonzero(_LETTERS[0][a[at]]) / w
    out[14] = np.log1p(w / len(lines))
    out[15] = len(set(lines)) / len(lines)
    out[16] = sum(len(x) < 20 for x in lines) / len(lines)
    out[17] = sum(x.endswith((b".", b"!", b"?")) for x in lines) / len(lines)
    return out


@dataclass
class Model:
    """Bin edges per feature, a table per feature and per pair, and the intercept."""

    edges: list[np.ndarray]
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        f = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            f += t[b[:, j]]
        for i, j, to_i, to_j, t in self.pairs:
            f += t[to_i[b[:, i]], to_j[b[:, j]]]
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float = 1.0) -> np.ndarray:
    """Leaf value per bin of a small regression tree on one binned feature (best-first)."""
    cuts, parts = [], [(0, len(g))]
    value = lambda s, e: g[s:e].sum() / (h[s:e].sum() + ridge)
    while len(parts) < leaves:
        best = (1e-6, None, None)
        for s, e in parts:
            if e - s < 2:
                continue
            gl, hl = np.cumsum(g[s:e])[:-1], np.cumsum(h[s:e])[:-1]
            gt, ht = g[s:e].sum(), h[s:e].sum()
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (s, e), s + k + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
        cuts.append(best[2])
    out = np.zeros(len(g))
    for s, e in parts:
        out[s:e] = value(s, e)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """A depth-two tree on two binned features: the best cut of one, then of the other in each half."""
    best, gain_best = np.zeros_like(g), 0.0
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for c in range(1, len(gg)):
            out, gain = np.zeros_like(gg), -whole
            for rows in (slice(0, c), slice(c, None)):
                gr, hr = gg[rows].sum(0), hh[rows].sum(0)
                leaf = _tree(gr, hr, 2, ridge)
                out[rows] = leaf
                gain += (2 * leaf * gr - leaf**2 * (hr + 0)).sum()
            if gain > gain_best:
                best, gain_best = (out.T if flip else out), gain
    return best, gain_best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, rate: float = 0.15, leaves: int = 3,
        n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 20) -> Model:
    """Cyclic boosting of one-feature trees, then of trees on the pairs with the largest gain."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    model = Model([np.unique(np.quantile(x[:, j], q)) if len(x) else np.zeros(0) for j in range(len(FEATURES))])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(y) == 0:
        return model
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(p0 / (1 - p0)))
    b = model.bins(x)
    f = np.full(len(y), model.base)

    def gradients():
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            g, h = gradients()
            step = rate * _tree(np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table)), leaves)
            table += step
            f += step[b[:, j]]

    coarse = [np.minimum(np.arange(len(t)) * pair_bins // max(len(t), 1), pair_bins - 1) for t in model.tables]
    g, h = gradients()

    def grid(i, j, g, h):
        cell = coarse[i][b[:, i]] * pair_bins + coarse[j][b[:, j]]
        n = pair_bins * pair_bins
        return cell, np.bincount(cell, g, n).reshape(pair_bins, -1), np.bincount(cell, h, n).reshape(pair_bins, -1)

    gains = []
    for i in range(len(FEATURES)):
        for j in range(i):
            _, gg, hh = grid(i, j, g, h)
            gains.append((_pair_tree(gg, hh)[1], i, j))
    chosen = [(i, j, np.zeros((pair_bins, pair_bins))) for gain, i, j in sorted(gains, reverse=True)[:n_pairs] if gain > 1e-3]
    for _ in range(pair_rounds):
        for i, j, table in chosen:
            g, h = gradients()
            cell, gg, hh = grid(i, j, g, h)
            step = rate * _pair_tree(gg, hh)[0]
            table += step
            f += step.ravel()[cell]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for i, j, t in chosen]
    return model


def _feature_rows(columns: list[str]):
    """mapInArrow function: keeps ``columns``, turns the text (last column) into its features."""

    def scan(batches):
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(len(columns))]).reshape(-1, len(FEATURES))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(j) for j in range(len(columns))] + [lists], [*columns, "x"])

    return scan


def held_out(doc_id):
    """Rows whose label is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Model of ``labels.quality`` from at most ``max_rows`` labelled rows that are not held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows))
    rows = (id_text(docs).join(known, "doc_id").select("quality", F.col("text").cast("binary").alias("text"))
            .mapInArrow(_feature_rows(["quality"]), "quality int, x array<double>").toArrow())
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows["quality"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y)) if len(y) else []  # the same model however rows were dealt
    return fit(x[order], y[order])


def scores(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and the score of the text (column ``text``, null as empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd
        x = np.array([features(t) for t in text]).reshape(-1, len(FEATURES))
        return pd.Series(shared.value.score(x))

    return docs.select(*columns, score(F.coalesce("text", F.lit("")).cast("binary")).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    return (scores(id_text(docs), model, ["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
