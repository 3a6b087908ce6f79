"""Toxicity: a support vector machine over gapped subsequences of characters, with Nystroem landmarks.

Two strings are alike as far as they share subsequences of three characters, each gap counting LAMBDA; a span has at
most SPAN characters. So an insult with other characters put in still shares most subsequences with itself. Landmarks
are words of the labelled sentences; the machine is trained in the space they span. Since the kernel is a product of
feature vectors, the trained machine folds into one weight per subsequence: a text is scored by adding weights over
every window of its characters, and its margin is that of its worst window.

Missing and empty texts have no window and get the score learnt for the lowest margin. Texts shorter than a window are
one window. Without both kinds of labels every score is the mean label (0 without any). Repeated rows are scored alike.
Only the text is an input of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored
from tallyhouse.llm.quality_gam import fold

LAMBDA, SPAN = 0.6, 5
#: Subsequences that begin in so many neighbouring characters make a window.
WINDOW = 7
#: Labelled documents the model is fitted on, by label: those with the least hash of their id.
TOXIC_SAMPLE, CLEAN_SAMPLE = 3_000, 6_000
#: Words taken from them: those that tell toxic from clean best, and others.
TELLING, OTHERS, LANDMARKS = 400, 4_000, 256
THRESHOLD = 0.7
_GAPS = [(i, j, LAMBDA ** (j - 2)) for j in range(2, SPAN) for i in range(1, j)]
_SENTENCE = re.compile(r"[.!?\n]+")


def _symbol_table() -> np.ndarray:
    out = np.zeros(128, np.int32)
    for i in range(26):
        out[65 + i] = out[97 + i] = 1 + i
    for i in range(10):
        out[48 + i] = 27 + i
    return out


_SYMBOLS = _symbol_table()


def symbols(text: str | None) -> np.ndarray:
    """Letters and digits as numbers below 64, case folded; any run of other characters is one 0, also at both ends."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros(len(codes) + 2, np.int32)
    out[1:-1] = np.where(codes < 128, _SYMBOLS[np.minimum(codes, 127)], 37 + codes.astype(np.int64) % 27)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def subsequences(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number and weight of each gapped subsequence."""
    starts, numbers, weights = [], [], []
    for i, j, w in _GAPS:
        n = len(s) - j
        if n > 0:
            starts.append(np.arange(n))
            numbers.append(s[:n] << 12 | s[i : i + n] << 6 | s[j : j + n])
            weights.append(np.full(n, w, np.float32))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.float32)
    return np.concatenate(starts), np.concatenate(numbers), np.concatenate(weights)


@dataclass
class Model:
    """weights: one per subsequence, in units of the margin; slopes and base: what is found in a text to log-odds."""

    weights: np.ndarray
    bias: float
    slopes: tuple[float, ...] = (0.0, 0.0, 0.0)
    base: float = 0.0

    def margins(self, s: np.ndarray) -> np.ndarray:
        """One margin for each window of a text's symbols."""
        n = len(s)
        if n < 3:
            return np.full(1, self.bias)
        sums = np.zeros(n + 1)
        for i, j, w in _GAPS:
            if n > j:
                sums[1 : n - j + 1] += w * self.weights[s[: n - j] << 12 | s[i : n - j + i] << 6 | s[j:]]
        np.cumsum(sums, out=sums)
        w = min(WINDOW, n - 2)
        return sums[w : n - 1] - sums[: n - 1 - w] + self.bias

    def measures(self, text: str | None) -> list[float]:
        """The worst window's margin, how many windows are beyond the middle, the length; the last two as logarithms."""
        s = symbols(text)
        margins = self.margins(s)
        return [float(margins.max()), float(np.log1p(np.count_nonzero(margins > 0))), float(np.log1p(len(s)))]

    def scores(self, texts) -> np.ndarray:
        x = np.array([self.measures(t) for t in texts], np.float64).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.slopes) + self.base, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Squared hinge loss, Newton steps on the rows inside the margin; the last coefficient is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    v, old = np.zeros(x.shape[1]), None
    reg = ridge * np.eye(x.shape[1])
    reg[-1, -1] = 1e-6
    for _ in range(40):
        inside = y * (x @ v) < 1
        if old is not None and np.array_equal(inside, old):
            break
        rows, w = x[inside], weight[inside]
        v, old = np.linalg.solve(reg + (rows * w[:, None]).T @ rows, (rows * w[:, None]).T @ y[inside]), inside
    return v


def fit(landmarks: list[str], strings: list[str], y: np.ndarray, weight: np.ndarray) -> Model:
    """landmarks span the space; strings with labels -1 and 1 and weights are what the machine is trained on."""
    vocabulary: dict[int, int] = {}
    rows, columns, values = [], [], []
    for r, z in enumerate(landmarks):
        _, numbers, weights = subsequences(symbols(z))
        for u, w in zip(numbers.tolist(), weights.tolist(), strict=True):
            rows.append(r)
            columns.append(vocabulary.setdefault(u, len(vocabulary)))
            values.append(w)
    z = np.zeros((len(landmarks), len(vocabulary)), np.float32)
    np.add.at(z, (rows, columns), values)
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-6)
    roots, axes = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = roots > 1e-4
    whiten = axes[:, good] / np.sqrt(roots[good])
    place = np.full(1 << 18, -1, np.int32)
    place[list(vocabulary)] = list(vocabulary.values())
    into = (z.T @ whiten).astype(np.float32)  # subsequence to Nystroem coordinates
    x = np.zeros((len(strings), into.shape[1]), np.float32)
    for r, text in enumerate(strings):
        _, numbers, weights = subsequences(symbols(text))
        known = place[numbers]
        x[r] = weights[known >= 0] @ into[known[known >= 0]]
    v = _svm(x.astype(np.float64), y, weight)
    weights = np.zeros(1 << 18, np.float32)
    weights[list(vocabulary)] = into @ v[:-1]
    return Model(weights, float(v[-1]))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a little ridge; targets drawn in from 0 and 1 as Platt does."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    p1, p0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (p1 + 1) / (p1 + 2), 1 / (p0 + 2))
    v = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(len(v)), x.T @ (t - p) - 1e-3 * v)
        v += step
        if np.abs(step).max() < 1e-8:
            break
    return v


def _sample(docs: DataFrame, labels: DataFrame, use: Column) -> DataFrame:
    """doc_id, text, label of a bounded number of labelled texts; fully equal rows count once.

    Labels are cut down first, so the join sends a bounded table to the scan of the texts. An id that many rows share
    brings them all to that join, so its texts' hashes are cut down again, and only texts chosen by both are stored.
    """
    sizes = ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE))

    def cut(rows: DataFrame, *order: str) -> DataFrame:
        by = [F.xxhash64("doc_id"), "doc_id", *order]
        parts = [rows.filter(F.col("label") == k).orderBy(*by).limit(n) for k, n in sizes]
        return parts[0].unionByName(parts[1])

    ready = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & use)
    texts = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    met = stored(texts.join(F.broadcast(cut(ready)), "doc_id").select("doc_id", "hash", "label").distinct(), "labelled_ids")
    chosen = cut(met, "hash")
    found = texts.join(F.broadcast(chosen), ["doc_id", "hash"])
    return stored(found.groupBy("doc_id", "hash", "label").agg(F.first("text").alias("text")).select("doc_id", "text", "label"), "labelled")


def _words(rows: DataFrame) -> DataFrame:
    """Words of the labelled sentences, with the number of toxic and of clean documents that have them."""

    def split(frames):
        for frame in frames:
            out = []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                found = {w for s in _SENTENCE.split((text or "").lower()) for w in re.findall(r"[^\W_]+", s)}
                out += [(w[:24], label) for w in found if len(w) > 2]
            yield pd.DataFrame(out, columns=["word", "label"])

    return (
        rows.mapInPandas(split, "word string, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )


def train(docs: DataFrame, labels: DataFrame, use: Column | None = None) -> Model:
    """Words first, then the windows of sentences that the first machine finds worst; the driver gets bounded tables."""
    rows = _sample(docs, labels, F.lit(True) if use is None else use)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        p = min(max(toxic / max(1, toxic + clean), 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << 18, np.float32), 0.0, base=float(np.log(p / (1 - p))))
    words = stored(_words(rows), "words")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    # Words that toxic documents have far more often than clean ones would by chance.
    score = odds * F.sqrt("toxic")
    told = words.filter((F.col("toxic") >= 2) & (odds > 1.5)).orderBy(F.desc(score), "word").limit(TELLING).collect()
    common = words.filter(F.col("clean") > 0).orderBy(F.desc("clean"), "word").limit(OTHERS // 2)
    others = common.union(words.filter(F.col("clean") > 0).orderBy(F.xxhash64("word"), "word").limit(OTHERS // 2)).distinct().collect()
    told = _sound(told, toxic, clean)
    plain = sorted(r["word"] for r in others)
    marks = [r["word"] for r in told[: LANDMARKS // 2]]
    marks += plain[:: max(1, len(plain) // (LANDMARKS - len(marks)))][: LANDMARKS - len(marks)]
    strings = [r["word"] for r in told] + plain
    y = np.array([1.0] * len(told) + [-1.0] * len(plain))
    weight = np.array([min(10.0, 1 + r["toxic"] / 10) for r in told] + [1.0] * len(plain))
    model = fit(marks, strings, y, weight)
    for _ in range(2):
        worst = _witnesses(rows, model)
        strings = strings + worst["window"].tolist()
        y = np.concatenate([y, np.where(worst["label"] == 1, 1.0, -1.0)])
        weight = np.concatenate([weight, np.ones(len(worst))])
        model = fit(marks, strings, y, weight)
    return _calibrated(rows, model)


def _sound(told: list, toxic: int, clean: int) -> list:
    """Of the telling words, those at least half as telling as the best; the rest may stand beside them by chance."""
    strength = [np.sqrt(r["toxic"]) * np.log((r["toxic"] + 0.5) / (toxic + 1) * (clean + 1) / (r["clean"] + 0.5)) for r in told]
    return [r for r, s in zip(told, strength, strict=True) if s >= 0.1 * strength[0]]


def _text_of(s: np.ndarray) -> str:
    """Characters that symbols() turns into the same numbers."""
    return "".join(" " if c == 0 else chr(96 + c) if c < 27 else chr(21 + c) if c < 37 else chr(27 * 740 + c - 37) for c in s.tolist())


def _witnesses(rows: DataFrame, model: Model) -> pd.DataFrame:
    """For each clean document its worst window, for each toxic one those beyond the margin's middle, at most eight."""

    def find(frames):
        for frame in frames:
            out = []
            for doc_id, text, label in zip(frame["doc_id"], frame["text"], frame["label"], strict=True):
                s = symbols(text)
                margins = model.margins(s).copy()
                for _ in range(8 if label else 2):
                    at = int(margins.argmax())
                    if label and margins[at] <= 0 or margins[at] < -1.5:
                        break
                    out.append((doc_id, label, _text_of(s[at : at + WINDOW + SPAN - 1])))
                    margins[max(0, at - WINDOW) : at + WINDOW + 1] = -np.inf
            yield pd.DataFrame(out, columns=["doc_id", "label", "window"])

    return rows.mapInPandas(find, "doc_id long, label int, window string").distinct().toPandas().sort_values(["doc_id", "window"])


def _calibrated(rows: DataFrame, model: Model) -> Model:
    def measure(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "x": [model.measures(t) for t in frame["text"]]})

    got = rows.mapInPandas(measure, "doc_id long, label int, x array<double>").toPandas().sort_values("doc_id")
    v = _logistic(np.array(got["x"].tolist()), got["label"].to_numpy(float))
    return Model(model.weights, model.bias, tuple(map(float, v[:-1])), float(v[-1]))


def score_column(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted; the model never sees a label of the held-out fold."""
    model = train(docs, labels, fold(folds) != held)
    return docs.select(
        "doc_id", (fold(folds) == held).alias("held_out"), score_column(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
