"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and so has each of a few pairs of features. Boosting visits the features
in turn, round after round, and adds to the visited table a small tree fitted to what the others leave over; a score is
a sum of table entries. Features are shares and rates, read from the whole text.

Missing and empty texts have all features 0 and get the score learnt for such texts. Rows without a label are no
training rows; with fewer than two kinds of labels every score is the mean label (0.5 without any). Repeated rows are
scored alike. Only the text is an input of a score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Labelled documents the model is fitted on, those with the least hash of their id.
SAMPLE = 12_000
BINS, ROUNDS, RATE, LEAVES, PAIRS, PAIR_ROUNDS = 32, 60, 0.1, 3, 6, 30
THRESHOLD = 0.3

FEATURES = [
    "log_chars", "log_words", "word_length", "upper", "digit", "punctuation", "symbol", "other_bytes",
    "stops", "commas", "bars", "exclaims", "lines", "short_lines", "repeated_lines", "distinct_words",
    "top_word", "doubled_words", "words_with_symbols", "capital_words", "common_short_words",
]

_SYMBOL = frozenset(b"#$%&*+/<=>@\\^_`{}~[]|!")


def _counts_table() -> np.ndarray:
    kinds = np.zeros((256, 4), np.int64)
    for b in range(256):
        c = chr(b)
        kinds[b] = (65 <= b <= 90, 48 <= b <= 57, b < 128 and not c.isalnum() and not c.isspace(), b in _SYMBOL)
    return kinds


_KINDS = _counts_table()


def features(text: str | None) -> np.ndarray:
    out = np.zeros(len(FEATURES), np.float32)
    if not text:
        return out
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = int(raw.sum())
    upper, digit, punctuation, symbol = (raw @ _KINDS) / size
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    lines = text.split("\n")
    doubled = sum(map(str.__eq__, words, words[1:]))
    marked = sum(c for w, c in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:?'\")")
    capital = sum(c for w, c in seen.items() if len(w) > 1 and w.isupper())
    short = sum(c for w, c in seen.items() if len(w) < 4)
    out[:] = (
        np.log1p(len(text)), np.log1p(len(words)), len(text) / n, upper, digit, punctuation, symbol, raw[128:].sum() / size,
        raw[46] / n, raw[44] / n, raw[124] / n, raw[33] / n, len(lines) / n, sum(len(x) < 20 for x in lines) / len(lines),
        1 - len(set(lines)) / len(lines), len(seen) / n, (seen.most_common(1)[0][1] if seen else 0) / n, doubled / n,
        marked / n, capital / n, short / n,
    )
    return out


@dataclass
class Model:
    """edges: inner bin bounds by feature; tables: (features, logits by bin or by pair of bins)."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[tuple[tuple[int, ...], np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.bins(x), np.full(len(x), self.intercept)
        for on, values in self.tables:
            total += values[tuple(bins[:, j] for j in on)]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """A tree of at most LEAVES leaves over ordered bins: values of the best cuts, found greedily."""
    gain = lambda g, h: g * g / (h + 1.0)
    parts = [(0, len(grad))]
    while len(parts) < LEAVES:
        best = (1e-6, None, None)
        for i, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
            gains = gain(g[:-1], h[:-1]) + gain(g[-1] - g[:-1], h[-1] - h[:-1]) - gain(g[-1], h[-1])
            if gains.max() > best[0]:
                best = (gains.max(), i, a + int(gains.argmax()) + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1.0)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut through each of two features: the four quadrants' values and the gain."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    low = g[:-1, :-1], h[:-1, :-1]
    left = g[:-1, -1:] - low[0], h[:-1, -1:] - low[1]
    down = g[-1:, :-1] - low[0], h[-1:, :-1] - low[1]
    high = g[-1, -1] - low[0] - left[0] - down[0], h[-1, -1] - low[1] - left[1] - down[1]
    parts = (low, left, down, high)
    gains = sum(a * a / (b + 1.0) for a, b in parts)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    value = [float(a[i, j] / (b[i, j] + 1.0)) for a, b in parts]
    out = np.empty(grad.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return out, float(gains.max())


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one-feature trees, then of the pairs that explain most of what is left."""
    if len(y) == 0 or y.min() == y.max():
        mean = (y.sum() + 0.5) / (len(y) + 1)
        return Model([np.empty(0)] * x.shape[1], float(np.log(mean / (1 - mean))), [])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    mean = y.mean()
    model = Model(edges, float(np.log(mean / (1 - mean))), [])
    bins, sizes = model.bins(x), [len(e) + 1 for e in edges]
    logit = np.full(len(y), model.intercept)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    single = [np.zeros(s) for s in sizes]
    for _ in range(ROUNDS):
        for j, s in enumerate(sizes):
            grad, hess = rest()
            step = RATE * _tree(np.bincount(bins[:, j], grad, s), np.bincount(bins[:, j], hess, s))
            single[j] += step
            logit += step[bins[:, j]]
    model.tables += [((j,), t) for j, t in enumerate(single)]

    def pair_tree(a: int, b: int) -> tuple[np.ndarray, float]:
        grad, hess = rest()
        flat, shape = bins[:, a] * sizes[b] + bins[:, b], (sizes[a], sizes[b])
        n = sizes[a] * sizes[b]
        return _pair_tree(np.bincount(flat, grad, n).reshape(shape), np.bincount(flat, hess, n).reshape(shape))

    usable = [j for j, s in enumerate(sizes) if s > 1]
    strength = {(a, b): pair_tree(a, b)[1] for i, a in enumerate(usable) for b in usable[i + 1 :]}
    chosen = sorted(strength, key=strength.get, reverse=True)[:PAIRS]
    double = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for pair in chosen:
            step = RATE * pair_tree(*pair)[0]
            double[pair] += step
            logit += step[bins[:, pair[0]], bins[:, pair[1]]]
    model.tables += list(double.items())
    return model


def training_rows(docs: DataFrame, labels: DataFrame, label: str, use: Column, sample: int) -> DataFrame:
    """text and label of at most `sample` labelled documents: the bound on what the driver receives.

    labels are cut down first, so the join sends a table of at most `sample` rows to the scan of the texts.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & use)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", use: Column | None = None) -> Model:
    """Fit on a bounded sample: features are made where the texts are, the driver gets at most SAMPLE rows of numbers."""
    rows = training_rows(docs, labels, label, F.lit(True) if use is None else use, SAMPLE)

    def measure(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "x": [features(t) for t in frame["text"]]})

    # An id that many rows share brings them all to the join, so the rows of numbers are bounded as well.
    measured = rows.mapInPandas(measure, "doc_id long, label int, x array<float>")
    bounded = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(SAMPLE)
    got = bounded.toPandas().sort_values(["doc_id", "label"], kind="stable")
    x = np.array(got["x"].tolist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, got["label"].to_numpy(np.float64))


def score_column(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack([features(t) for t in texts])) if len(texts) else np.empty(0))

    return score(text)


def fold(of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a missing id counts as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of, F.lit(0))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted; the model never sees a label of the held-out fold."""
    model = train(docs, labels, "quality", fold(folds) != held)
    return docs.select(
        "doc_id", (fold(folds) == held).alias("held_out"), score_column(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score reaches the threshold, unchanged."""
    return docs.filter(score_column(model, F.col("text")) >= THRESHOLD)
