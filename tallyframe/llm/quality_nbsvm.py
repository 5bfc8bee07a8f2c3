"""Quality classifier: a linear support vector machine on naive Bayes features (operator 9).

A document's features are hashed n-gram indicators: its words and word pairs, and runs of one to
three word shapes (which symbols and digits a word carries, whether it repeats the word before).  Each indicator is scaled by the log
ratio of its smoothed frequencies in the two classes, and a linear hinge-loss model is fitted to
the scaled indicators by dual coordinate descent.  A logistic curve fitted to the margins of
sample rows that the model did not see turns margins into scores.

Fitting works on the driver, on a bounded sample of labelled rows: FIT_DOCS per class, and of a text
with more than FIT_CHARS characters as many in FIT_PIECES runs spread over all of it.  Executors turn the
sample into feature numbers, so the driver holds these alone: at most about FIT_CHARS / 6 words with
four numbers of 4 bytes each a row, some 130 MB at the bound.  Scoring is one pass over the whole texts
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import Words, byte_table, mix64, slices, texts
from .labels import held_out, sample, sampled_texts

#: Rows of each class and characters of a row that are learned from, and the runs that they are taken in.
FIT_DOCS, FIT_CHARS, FIT_PIECES = 3000, 8000, 8
DIMS = 1 << 20
#: Cost of a margin error, passes over the sample, smoothing of the class counts.
COST, EPOCHS, SMOOTH = 0.1, 12, 1.0
#: Every FOLD-th sample row is kept back for the logistic curve.
FOLD = 5

_U = np.uint64


def _shape_values() -> np.ndarray:
    """A random value for every byte that is no letter; letters and white space add nothing, and
    all digits are alike."""
    v = mix64(np.arange(1, 257, dtype=np.uint64))
    v[0x30:0x3A] = v[0x30]
    for lo, hi in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100), (0x09, 0x0E), (0x20, 0x21)):
        v[lo:hi] = 0
    return v


_SHAPES = _shape_values()


def features(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct feature numbers of each text."""
    words = Words(*texts(column), byte_table("space"))
    out = [[] for _ in range(len(column))]
    if len(words.start):
        ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_SHAPES[words.data])])
        same = np.zeros(len(words.hash), np.uint64)  # the word repeats the one before it
        same[1:] = words.hash[1:] == words.hash[:-1]
        same[words.first[:-1][np.diff(words.first) > 0]] = 0
        shapes = mix64(ends[words.end] - ends[words.start] + same + _U(1))
        grams = [(words.hash, 1)]
        for hashes, most in ((words.hash, 2), (shapes, 3)):
            run = hashes
            for n in range(1, most + 1):
                if n > 1:
                    run = mix64(run[:-1] * _U(0xD6E8FEB86659FD93) + hashes[n - 1:])
                if hashes is shapes or n > 1:
                    grams.append((run + _U(most * 8 + n), n))
        for run, n in grams:
            number = (mix64(run) % _U(DIMS)).astype(np.int32)
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                if b - a >= n:
                    out[i].append(number[a:b - n + 1])
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int32) for x in out]


@dataclass
class Model:
    weights: np.ndarray  # of the indicators, the class log ratio included
    bias: float
    slope: float
    shift: float

    def margin(self, x: np.ndarray) -> float:
        """The mean over the root of the number of features, so that length does not decide."""
        return float(self.weights[x].sum()) / max(1.0, np.sqrt(len(x))) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, share: float, rng) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min (|w|^2 + bias^2) / 2 + sum cost_i * hinge(y_i (w x_i + bias)); the
    classes weigh what they do among all labelled rows."""
    cost = COST * np.where(y > 0, share / (y > 0).mean(), (1 - share) / (y < 0).mean())
    scale = np.array([1 / max(1.0, np.sqrt(len(x))) for x in rows])
    squares = ratio * ratio
    norm = np.array([float(squares[x].sum()) * s * s + 1 for x, s in zip(rows, scale)])
    # w is kept times the ratios, as the rows' values are these by a factor each
    w, bias, dual = np.zeros(len(ratio), np.float64), 0.0, np.zeros(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            slack = 1 - y[i] * (float(w[x].sum()) * scale[i] + bias)
            step = min(max(dual[i] + slack / norm[i], 0.0), cost[i]) - dual[i]
            if step:
                dual[i] += step
                w[x] += step * y[i] * scale[i] * squares[x]
                bias += step * y[i]
    return w, bias


def _logistic(margin: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the score curve, by Newton steps on smoothed targets; the classes weigh
    what they do among all labelled rows (``share`` of 1s), not in the sample."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    want = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    weight = np.where(y > 0, share / max(good, 1), (1 - share) / max(bad, 1)) * len(y)
    x, theta = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -60, 60)))
        grad = x.T @ (weight * (p - want)) + 1e-3 * theta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(hess, grad)
    return float(max(theta[0], 1e-3)), float(theta[1])


def class_ratios(rows: list[np.ndarray], y: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Log ratio of each indicator's smoothed share in class 1 to that in class 0; 0 if never seen."""
    counts = np.full((2, dims), SMOOTH)
    for x, label in zip(rows, y):
        counts[int(label > 0), x] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[(counts == SMOOTH).all(axis=0)] = 0
    return ratio


def fit_features(rows: list[np.ndarray], labels: list[int], share: float | None = None, seed: int = 7) -> Model:
    """Model of rows of feature numbers labelled 1 or 0, of which ``share`` are 1 in general (default:
    as given); without rows of both classes every score is the share of 1s."""
    y = np.where(np.array(labels, int) == 1, 1.0, -1.0)
    if share is None:
        share = float((y > 0).mean()) if len(y) else 0.5
    share = min(max(share, 0.001), 0.999)
    if not len(y) or len(set(y)) < 2:
        return Model(np.zeros(DIMS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept, learn = order[::FOLD], np.array([i for k, i in enumerate(order) if k % FOLD])
    if len(set(y[learn])) < 2 or len(set(y[kept])) < 2:
        kept = learn = order
    own = [rows[i] for i in learn]
    ratio = class_ratios(own, y[learn])
    weights, bias = _descend(own, y[learn], ratio, share, rng)
    model = Model(weights.astype(np.float32), bias, 1.0, 0.0)
    model.slope, model.shift = _logistic(np.array([model.margin(rows[i]) for i in kept]), y[kept], share)
    return model


def fit(texts_: list[str], labels: list[int], share: float | None = None, seed: int = 7) -> Model:
    """``fit_features`` on whole texts, a few at a time."""
    rows = [x for lo in range(0, len(texts_), 64) for x in features(pa.array(texts_[lo:lo + 64], pa.large_string()))]
    return fit_features(rows, labels, share, seed)


def _numbered(batches) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = pa.array([x.tobytes() for x in features(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), rows], ["id", "label", "numbers"])


def _predict(batches, model: Model):
    for whole in batches:
        for batch in slices(whole, "text"):
            margin = np.array([model.margin(x) for x in features(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(margin))], ["id", "score"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit on at most FIT_DOCS rows of each class, none of them held out.  Ids with both labels,
    null labels and null texts teach nothing; an id that stands for several texts teaches one."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
    marks = marks.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top")).filter("label = top")
    chosen = sample(marks, "id", "label", FIT_DOCS, 2)
    rows = sampled_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), chosen, "id", "text",
                         FIT_CHARS, FIT_PIECES).select("id", "label", "text")
    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_numbered, f"id {id_type}, label int, numbers binary").collect()
    found.sort(key=lambda r: r["id"])
    numbers = [np.frombuffer(r["numbers"], np.int32) for r in found]
    return fit_features(numbers, [r["label"] for r in found], marks.agg(F.avg("label")).first()[0])


def score_quality(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  threshold: float = 0.7) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted`` (1 from ``threshold`` on).

    Defined results: null text counts as empty and has a score like any other text without
    features; a null id is not held out; repeated rows score alike; without labels of both classes
    all scores are the share of label 1 (0.5 without any); an empty table gives no row; other
    columns are ignored.
    """
    model = model or train(docs, labels, id_col, text_col, label_col)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    found = narrow.mapInArrow(lambda it: _predict(it, model), f"id {id_type}, score double")
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
