"""Quality by a generalised additive model with pairwise interactions.

A text becomes a few numbers about its characters, words and lines. Each has a
lookup table over quantile bins, learned by cyclic boosting: round after round,
every feature in turn gets a shallow tree on what the model still gets wrong,
and the tree's leaf values are added to its table. Then the pairs of features
with the largest remaining gain get tables of their own in the same way. A
score is the logistic of one bin addition per table, whole batches at a time.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, a
parameter); only its features reach the driver. Scores use nothing but the
text. Null and empty texts have features too (zeros) and a score. Without
labelled rows the score is 0.5 everywhere; with one label only, it is that
label's smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.labelled import sample, share
from riskloom.llm.words import WordHasher, encoded

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE, RIDGE = 0.15, 1.0
THRESHOLD = 0.3
FEATURES = (
    "chars words word_length word_spread upper digit sentence symbol high marked_words distinct_words "
    "top_word stutter distinct_pairs distinct_triples entropy lines line_length distinct_lines pipes "
    "exclamations"
).split()


def _classes() -> np.ndarray:
    """Byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence marks, 6 symbols, 7 non-ASCII."""
    kinds = np.zeros(256, np.int64)
    for kind, chars in (
        (1, b"abcdefghijklmnopqrstuvwxyz"),
        (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (3, b"0123456789"),
        (4, b" \t\n\r\x0b\x0c"),
        (5, b".,;:?'\"()-"),
        (6, b"!#$%&*+/<=>@[\\]^_`{|}~"),
    ):
        kinds[list(chars)] = kind
    kinds[128:] = 7
    return kinds


def text_features(hasher: WordHasher, classes: np.ndarray, text: str | None) -> list[float]:
    data = encoded(text)
    starts, ends, words = hasher.words(data)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, np.uint8)
    bytes_ = np.bincount(raw, minlength=256)
    kinds = np.bincount(classes, weights=bytes_, minlength=8)
    seen = kinds.sum() - kinds[4]
    letters = max(1.0, kinds[1] + kinds[2])
    lengths = ends - starts
    _, repeats = np.unique(words, return_counts=True)
    share = bytes_[bytes_ > 0] / len(raw)
    lines = data.split(b"\n")
    sums = hasher.sums(words)
    distinct = [
        len(np.unique(g)) / len(g) if len(g) else 1.0
        for g in (hasher.grams(sums, 2), hasher.grams(sums, 3))
    ]
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        kinds[2] / letters,
        kinds[3] / seen,
        kinds[5] / seen,
        kinds[6] / seen,
        kinds[7] / seen,
        float((classes[raw[ends - 1]] == 6).mean()),
        len(repeats) / n,
        float(repeats.max() / n),
        float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0,
        *distinct,
        float(-(share * np.log(share)).sum()),
        float(np.log1p(len(lines))),
        float(np.log1p(len(raw) / len(lines))),
        len(set(lines)) / len(lines),
        bytes_[124] / n,
        bytes_[33] / n,
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def features_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Features of whole texts."""
    hasher, classes = WordHasher(), _classes()
    for batch in texts:
        yield pd.Series([text_features(hasher, classes, t) for t in batch])


@dataclass
class AdditiveModel:
    """Intercept, cuts and table per feature, and coarse cuts and table per pair."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, i], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def column(self, text: str | Column) -> Column:
        """Score of a text column."""
        model = self

        @F.pandas_udf(T.DoubleType())
        def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            hasher, classes = WordHasher(), _classes()
            for batch in texts:
                rows = [text_features(hasher, classes, t) for t in batch]
                yield pd.Series(model.score(np.array(rows)) if rows else np.zeros(0))

        return scored(text)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value per bin of a tree of at most three leaves on ordered bins."""
    edges = [0, len(g)]
    sums = lambda a, b: (g[a:b].sum(), h[a:b].sum())
    for _ in range(2):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            if b - a < 2:
                continue
            total, weight = sums(a, b)
            left, below = g[a:b].cumsum()[:-1], h[a:b].cumsum()[:-1]
            gain = (
                left**2 / (below + RIDGE)
                + (total - left) ** 2 / (weight - below + RIDGE)
                - total**2 / (weight + RIDGE)
            )
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], a + at + 1)
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    value = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        total, weight = sums(a, b)
        value[a:b] = total / (weight + RIDGE)
    return value


def _square(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Value per cell and gain of the best tree that splits both axes once."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total, weight = gs[-1, -1], hs[-1, -1]
    a, b = gs[:-1, :-1], hs[:-1, :-1]
    up, upw = gs[:-1, -1:], hs[:-1, -1:]
    left, leftw = gs[-1:, :-1], hs[-1:, :-1]
    quarters = [
        (a, b),
        (up - a, upw - b),
        (left - a, leftw - b),
        (total - up - left + a, weight - upw - leftw + b),
    ]
    gain = sum(x**2 / (w + RIDGE) for x, w in quarters)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = np.empty_like(g)
    parts = (slice(None, i + 1), slice(i + 1, None)), (slice(None, j + 1), slice(j + 1, None))
    for (x, w), (p, q) in zip(quarters, ((0, 0), (0, 1), (1, 0), (1, 1))):
        value[parts[0][p], parts[1][q]] = x[i, j] / (w[i, j] + RIDGE)
    return value, float(gain[i, j] - total**2 / (weight + RIDGE))


def fit(x: np.ndarray, y: np.ndarray, ones: float | None = None) -> AdditiveModel:
    """Fits the tables by cyclic boosting of the logistic loss.

    ``ones`` is their share among all that the rows stand for, by default among the rows.
    Rows are weighed to it, so scores mean the same however the rows were drawn.
    """
    ones = (y.sum() + 1) / (len(y) + 2) if ones is None else ones
    model = AdditiveModel(float(np.log(ones / (1 - ones))))
    if len(np.unique(y)) < 2:
        return model
    weight = np.where(y == 1, ones / y.mean(), (1 - ones) / (1 - y.mean()))
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(c, levels)) for c in x.T]
    model.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for c in x.T]
    bins = [np.searchsorted(c, v, side="right") for c, v in zip(model.cuts, x.T)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for at, table in zip(bins, model.tables):
            g, h = slopes()
            step = RATE * _tree(
                np.bincount(at, g, len(table)), np.bincount(at, h, len(table))
            )
            table += step
            total += step[at]
    cells = [np.searchsorted(c, v, side="right") for c, v in zip(model.coarse, x.T)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        at = cells[i] * shape[1] + cells[j]
        g, h = slopes()
        size = shape[0] * shape[1]
        return at, np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape)

    splittable = [i for i, c in enumerate(model.coarse) if len(c)]
    gains = []
    for i in splittable:
        for j in splittable:
            if i < j:
                gains.append((-_square(*grid(i, j)[1:])[1], i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains)[:PAIRS]]
    model.pair_tables = [
        np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs
    ]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            at, g, h = grid(i, j)
            step = RATE * _square(g, h)[0]
            table += step
            total += step.ravel()[at]
    return model


def train(
    docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", rows: int = SAMPLE_ROWS
) -> AdditiveModel:
    """Model fitted on ``rows`` labelled documents at most, of those where ``keep``.

    Half the bound goes to either label; rows are weighed back to the share that labels
    have among all that are kept, so the bound does not move the scores.
    """
    chosen = sample(labels, label, keep, {0: rows // 2, 1: rows // 2})
    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("turn", "doc_id", "label", features_of("text").alias("x"))
        .toPandas()
        .sort_values(["turn", "doc_id"])
    )
    if not len(found):
        return AdditiveModel()
    x, y = np.array(found["x"].tolist(), float), found["label"].to_numpy(float)
    return fit(x, y, share(labels, label, keep))
