"""Quality classifier: a generalised additive model with pairwise interactions.

Each whole text gives a short vector of measures. Cyclic boosting visits one measure
after another, fits a shallow tree (depth two) to the current residuals over the
measure's bins and adds it to that measure's lookup table; then the pairs with most
left to explain get two-dimensional tables in the same way. A score is the logistic
of a sum of table look-ups, vectorised over a batch.

Training reads a bounded sample of labelled rows (`max_rows`, spread by a hash of the
id, the share taken from the exact count of labels); only their measures, a few
hundred bytes each, reach the driver. All texts are scored, row by row within Arrow
batches, so lost work is simply redone and nothing is shuffled.

Defined results: null and empty texts have zero measures and get the model's score
for those; without any label every score is 0.5; labels other than 0 and 1 and null
labels or ids are not learnt; a document labelled twice counts twice; extra columns
are untouched, because scoring is a column expression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SEPARATORS, fold
from .quality_rules import SYMBOLS, duplicate_lines, repeated_words

DIGITS = b"0123456789"
UPPER = bytes(range(65, 91))
STOPS = b".,;:"
HIGH = bytes(range(128, 256))
MEASURES = (
    "log_words", "word_length", "symbols", "upper", "exclaims", "bars", "dup_lines", "repeats",
    "top_word", "distinct", "compress", "digits", "stops", "line_words", "non_ascii", "same_as_last",
)


@dataclass(frozen=True)
class Settings:
    """max_rows bounds the labelled sample."""

    max_rows: int = 8000
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 200
    pair_rounds: int = 60
    pairs: int = 8
    rate: float = 0.1
    ridge: float = 2.0
    seed: int = 11


def measures(text: str | None, compressor) -> list[float]:
    """The measures of one text, in the order of MEASURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(MEASURES)
    chars = len(raw.translate(None, WORD_SEPARATORS))
    count = Counter(words)
    without = lambda drop: size - len(raw.translate(None, drop))
    lines = raw.count(b"\n") + 1
    return [
        np.log1p(n),
        chars / n,
        without(SYMBOLS) / n,
        without(UPPER) / chars,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        duplicate_lines(raw) / lines,
        repeated_words(words) / n,
        max(count.values()) / n,
        len(count) / n,
        np.log(size / len(compressor.compress(raw))) - 0.08 * np.log1p(n),
        without(DIGITS) / chars,
        without(STOPS) / n,
        n / lines,
        without(HIGH) / chars,
        sum(map(bytes.__eq__, words, words[1:])) / n,
    ]


def shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """Leaf value for each ordered bin: the best splits of gradient and curvature sums."""
    value = lambda a, b: g[a:b].sum() / (h[a:b].sum() + ridge)
    out = np.zeros(len(g))

    def grow(a: int, b: int, left: int) -> None:
        if left and b - a > 1:
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            rest_g, rest_h = cg[-1] - cg[:-1], ch[-1] - ch[:-1]
            gain = cg[:-1] ** 2 / (ch[:-1] + ridge) + rest_g**2 / (rest_h + ridge)
            best = int(gain.argmax())
            if gain[best] > cg[-1] ** 2 / (ch[-1] + ridge) + 1e-9:
                grow(a, a + best + 1, left - 1)
                grow(a + best + 1, b, left - 1)
                return
        out[a:b] = value(a, b)

    grow(0, len(g), depth)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a pair's bins into four quadrants: its gain, and the cell values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (cg, ch):
        low = c[:-1, :-1]
        parts.append((low, c[:-1, -1:] - low, c[-1:, :-1] - low, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + low))
    gain = sum(a * a / (np.maximum(b, 0) + ridge) for a, b in zip(*parts, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = [a[i, j] / (max(b[i, j], 0) + ridge) for a, b in zip(*parts, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), out


class Additive:
    """Look-up tables for measures and for pairs of measures."""

    def __init__(self, settings: Settings = Settings()):
        self.settings = settings
        self.base = 0.0
        self.edges: list[np.ndarray] = []
        self.coarse: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def _bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        s = self.settings
        if not len(y):
            return self
        share = np.clip(y.mean(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        cuts = lambda col, n: np.unique(np.quantile(col, np.linspace(0, 1, n + 1)[1:-1]))
        self.edges = [cuts(x[:, k], s.bins) for k in range(x.shape[1])]
        self.coarse = [cuts(x[:, k], s.pair_bins) for k in range(x.shape[1])]
        at, at2 = self._bins(x, self.edges), self._bins(x, self.coarse)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        logit = np.full(len(y), self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-logit))
            return y - p, p * (1 - p)

        for _ in range(s.rounds):
            for k, b in enumerate(at):
                g, h = slopes()
                n = len(self.tables[k])
                step = s.rate * shallow_tree(np.bincount(b, g, n), np.bincount(b, h, n), s.ridge)
                self.tables[k] += step
                logit += step[b]
        width = [len(e) + 1 for e in self.coarse]

        def sums(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cell, shape = at2[i] * width[j] + at2[j], (width[i], width[j])
            return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)

        g, h = slopes()
        found = [(quadrants(*sums(i, j, g, h), s.ridge)[0], i, j) for i in range(len(width)) for j in range(i) if width[i] > 1 and width[j] > 1]
        for _, i, j in sorted(found, reverse=True)[: s.pairs]:
            self.pairs.append((i, j, np.zeros((width[i], width[j]))))
        for _ in range(s.pair_rounds):
            for i, j, grid in self.pairs:
                step = s.rate * quadrants(*sums(i, j, *slopes()), s.ridge)[1]
                grid += step
                logit += step[at2[i], at2[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of measures."""
        if not self.tables:
            return np.full(len(x), 0.5)
        logit = np.full(len(x), self.base)
        for t, b in zip(self.tables, self._bins(x, self.edges), strict=True):
            logit += t[b]
        at2 = self._bins(x, self.coarse)
        for i, j, grid in self.pairs:
            logit += grid[at2[i], at2[j]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def measures_of(text: Column | str) -> Column:
    """The measures of a text column, array<double>."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        compressor = zstandard.ZstdCompressor(level=3)
        return pd.Series([np.array(measures(t, compressor)) for t in texts], dtype=object)

    return measured(F.col(text) if isinstance(text, str) else text)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", settings: Settings = Settings(), learn: Column | None = None) -> Additive:
    """A model from labelled documents; `learn` is a condition on the id column `id`."""
    s = settings
    known = labels.select(F.col(id_col).alias("id"), F.col(label).alias("y")).where("y in (0, 1) and id is not null")
    known = known.where(learn) if learn is not None else known
    n = known.count()
    chance = F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = chance < min(1.0, s.max_rows / max(n, 1))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("id is not null").where(taken)
    rows = known.where(taken).join(texts, "id").select("id", "y", measures_of("text").alias("x")).limit(2 * s.max_rows).collect()
    rows.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(MEASURES))
    return Additive(s).fit(x, np.array([r["y"] for r in rows], np.float64))


def predict(model: Additive, text: Column | str) -> Column:
    """The score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        compressor = zstandard.ZstdCompressor(level=3)
        x = np.array([measures(t, compressor) for t in texts]).reshape(len(texts), len(MEASURES))
        return pd.Series(model.score(x))

    return score(F.col(text) if isinstance(text, str) else text)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """id, held_out, score, predicted; rows with crc32(id) mod 5 = 0 are held out of training."""
    model = train(docs, labels, text, id_col, "quality", settings, fold("id", 5) != 0)
    scored = docs.select(F.col(id_col), (fold(id_col, 5) == 0).alias("held_out"), predict(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
