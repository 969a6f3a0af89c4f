"""Quality by naive Bayes support vectors.

n-gram indicators are scaled by the log ratio of their class-conditional rates,
then a linear hinge-loss model is fitted to the scaled rows by dual coordinate
descent, in numpy.  Rates and model come from a bounded sample of the labelled rows
of the training fold.  Margins become probabilities by a logistic curve fitted to
labelled rows that the support vectors have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import NgramPresence, fresh, land
from pitlane.llm.textmodel import bounded_sample, ids_of, presence_rows, sigmoid, texts_of, votes, with_score


@dataclass(frozen=True)
class QualityParams:
    """``max_fit`` bounds the rows of the rates and the hinge fit, ``max_calibrate`` those of the logistic curve."""

    orders: tuple[int, ...] = (2, 3)
    bits: int = 16
    max_fit: int = 9000
    max_calibrate: int = 3000
    alpha: float = 1.0
    cost: float = 1.0
    epochs: int = 15
    threshold: float = 0.3
    seed: int = 11

    def grams(self) -> NgramPresence:
        return NgramPresence(self.orders, self.bits, repeats=True)


@dataclass(frozen=True)
class NbSvm:
    """``weights`` are the hinge weights times the log-count ratios."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, ids: np.ndarray) -> float:
        return float(self.weights[ids].sum(dtype=np.float64)) / np.sqrt(max(1, len(ids))) + self.bias

    def __call__(self, ids: np.ndarray) -> float:
        """The probability of label 1; an empty text has only the padding's n-grams."""
        return sigmoid(self.slope * self.margin(ids) + self.shift)


def class_counts(rows: list[np.ndarray], labels: np.ndarray, bits: int) -> np.ndarray:
    """Document counts (2, 2**bits) of each n-gram by label."""
    of = lambda y: [x for x, z in zip(rows, labels, strict=True) if z == y] or [np.empty(0, np.int32)]
    return np.stack([np.bincount(np.concatenate(of(y)), minlength=1 << bits) for y in (0, 1)])


def log_count_ratio(counts: np.ndarray, alpha: float) -> np.ndarray:
    """log of (smoothed share of the n-gram in class 1) / (its share in class 0)."""
    smooth = counts + alpha
    share = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int,
                            seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM over ratio-scaled, length-scaled indicator rows.

    Stops early once no dual variable of an epoch moves noticeably.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    values = [ratio[x] / np.sqrt(max(1, len(x))) for x in rows]
    square = np.array([v @ v + 1.0 for v in values])
    dual, w, b = np.zeros(len(rows)), np.zeros(len(ratio)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slack = y[i] * (w[rows[i]] @ values[i] + b) - 1.0
            new = min(max(dual[i] - slack / square[i], 0.0), cost)
            step = (new - dual[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                b += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-4:
            break
    return w * ratio, b


def fit_logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton steps on smoothed targets."""
    ones = int((labels > 0).sum())
    zeros = len(labels) - ones
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, np.log(ones / zeros)])
    loss = lambda c: float(np.logaddexp(0, x @ c).sum() - target @ (x @ c)) + 1e-3 * float(c @ c)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        grad = x.T @ (p - target) + 2e-3 * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> NbSvm:
    """Fit on the labels of the training fold.  With labels of one class only every text gets its rate, smoothed."""
    found = ids_of(docs, id_col).join(votes(labels, id_col, label_col), "doc_id")
    chosen = land(bounded_sample(found, params.max_fit + params.max_calibrate), "chosen")
    rows = land(presence_rows(texts_of(docs, chosen, id_col, text_col), "text", "ids", params.grams()), "presence")
    table = rows.orderBy(F.xxhash64("doc_id"), "doc_id").select("ids", "y").toArrow()
    ids = [np.frombuffer(x.as_buffer(), np.int32) for chunk in table["ids"].chunks for x in chunk]
    y = table["y"].to_numpy().astype(np.int64)
    if len(np.unique(y)) < 2:
        rate = (float(y.sum()) + 1) / (len(y) + 2)
        return NbSvm(np.zeros(1 << params.bits, np.float32), 0.0, 1.0, float(np.log(rate / (1 - rate))))
    share = params.max_calibrate / (params.max_fit + params.max_calibrate)
    apart = np.floor(np.arange(1, len(y) + 1) * share) > np.floor(np.arange(len(y)) * share)  # kept for the logistic curve
    fit = np.flatnonzero(~apart)
    ratio = log_count_ratio(class_counts([ids[i] for i in fit], y[fit], params.bits), params.alpha)
    w, b = dual_coordinate_descent([ids[i] for i in fit], y[fit], ratio, params.cost, params.epochs, params.seed)
    model = NbSvm(w.astype(np.float32), b)
    rest = np.flatnonzero(apart)
    slope, shift = fit_logistic(np.array([model.margin(ids[i]) for i in rest]), y[rest])
    return NbSvm(model.weights, b, slope, shift)


def score(docs: DataFrame, model: NbSvm, params: QualityParams = QualityParams(), text_col: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality.  Null texts score like empty ones."""
    return with_score(docs, text_col, name, params.grams(), model)


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at or above the threshold, all columns as they are."""
    name = fresh("quality", docs.columns)
    model = train(docs, labels, params, id_col, text_col)
    return score(docs, model, params, text_col, name).where(F.col(name) >= params.threshold).drop(name)
