"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed byte n-grams is trained in numpy from confirmed toxic
texts (P) and texts without a label (U).  With the share ``prior`` of toxic texts
in U, the risk of calling clean texts toxic is the loss of U as clean less
``prior`` times the loss of P as clean.  That difference can't be negative; where
a batch makes it so, the step undoes the overfit part instead (non-negative risk).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import NgramPresence, fresh, land, text_bytes
from pitlane.llm.textmodel import (
    bounded_sample,
    collect_presence,
    ids_of,
    presence_rows,
    sigmoid,
    texts_of,
    votes,
    with_score,
)


@dataclass(frozen=True)
class ToxicityParams:
    """``max_positive`` bounds the confirmed texts and ``max_unlabelled`` the texts of the mini-batches.

    The choice of n-grams and the cut see every document.  ``bins`` per unit of margin
    up to ``widest`` either side set how finely all margins are counted.
    """

    orders: tuple[int, ...] = (4, 5)
    bits: int = 18
    max_positive: int = 1500
    max_unlabelled: int = 4000
    features: int = 512
    least_apart: float = 5.0
    epochs: int = 60
    batch: int = 128
    rate: float = 0.05
    decay: float = 1e-4
    slack: float = 0.0
    folds: int = 3
    bins: int = 64
    widest: float = 64.0
    threshold: float = 0.5
    seed: int = 7

    def grams(self) -> NgramPresence:
        return NgramPresence(self.orders, self.bits)


@dataclass(frozen=True)
class LinearModel:
    """``weights`` has one entry per hashed n-gram; the chosen ones are not zero."""

    weights: np.ndarray
    chosen: np.ndarray
    bias: float
    cut: float = 0.0
    steep: float = 4.0

    def margin(self, ids: np.ndarray) -> float:
        ids = ids[self.chosen[ids]]
        return float(self.weights[ids].sum(dtype=np.float64)) / np.sqrt(max(1, len(ids))) + self.bias

    def __call__(self, ids: np.ndarray) -> float:
        """0 to 1, 0.5 at the cut; a text without chosen n-grams has the bias as its margin."""
        return sigmoid(self.steep * (self.margin(ids) - self.cut))


def gram_counts(rows: list[np.ndarray], size: int) -> np.ndarray:
    """How many rows have each n-gram; a row has each once."""
    total = np.zeros(size, np.int64)
    for x in rows:
        total[x] += 1
    return total


def choose_features(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int, p: ToxicityParams) -> np.ndarray:
    """A flag for the ``features`` n-grams whose document shares in P and U differ most, in standard errors."""
    pool = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(pool * (1 - pool) * (1 / n_p + 1 / n_u) + 1e-6)
    apart = np.abs(in_p / n_p - in_u / n_u) / error
    flags = np.zeros(len(in_p), bool)
    flags[np.argsort(-apart, kind="stable")[:p.features]] = True
    return flags & (apart > p.least_apart)


def pick_cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float, weights: np.ndarray | None = None) -> float:
    """The margin above which a text counts as toxic: least non-negative PU error, middle of the best range.

    Missed toxic texts are ``prior`` times the share of P below the cut; false alarms
    are the share of U above it less ``prior`` times the share of P above it, 0 at least.
    ``weights`` says how many unlabelled texts have each margin (one, if not given).
    """
    at = np.unique(np.concatenate([positive, unlabelled]))
    cuts = np.concatenate([[at[0] - 1], (at[1:] + at[:-1]) / 2, [at[-1] + 1]])

    def above(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        order = np.argsort(x, kind="stable")
        below = np.concatenate([[0], np.cumsum(n[order])])
        return 1 - below[np.searchsorted(x[order], cuts)] / below[-1]

    hit = above(positive, np.ones(len(positive)))
    alarm = above(unlabelled, np.ones(len(unlabelled)) if weights is None else weights)
    error = prior * (1 - hit) + np.maximum(0, alarm - prior * hit)
    best = np.flatnonzero(error <= error.min() + 1e-12)
    if best[0] == 0 or best[-1] == len(cuts) - 1:
        return float(cuts[best].mean())
    return float((at[best[0] - 1] + at[best[-1]]) / 2)


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, p: ToxicityParams,
             in_u: np.ndarray | None = None, n_u: int = 0) -> LinearModel:
    """Minimise the non-negative PU risk of the logistic loss by Adam over mini-batches; the cut is left at 0.

    ``in_u`` of ``n_u`` texts have each n-gram on the unlabelled side; counted from
    ``unlabelled`` if not given.
    """
    size = 1 << p.bits
    w, b = np.zeros(size + 1), np.log(prior / (1 - prior))  # the last weight takes steps for the bias
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    rng, step = np.random.default_rng(p.seed), 0
    if not any(map(len, positive)) or not any(map(len, unlabelled)):
        return LinearModel(w[:size].astype(np.float32), np.zeros(size, bool), b, steep=1.0)
    if in_u is None:
        in_u, n_u = gram_counts(unlabelled, size), len(unlabelled)
    chosen = choose_features(gram_counts(positive, size), len(positive), in_u, n_u, p)
    positive, unlabelled = ([x[chosen[x]] for x in rows] for rows in (positive, unlabelled))
    scale = lambda rows: [1.0 / np.sqrt(max(1, len(x))) for x in rows]
    norm_p, norm_u = scale(positive), scale(unlabelled)
    per_epoch = -(-len(unlabelled) // p.batch)
    for _ in range(p.epochs):
        order_u, order_p = rng.permutation(len(unlabelled)), rng.permutation(len(positive))
        for k in range(per_epoch):
            us = order_u[k * p.batch:(k + 1) * p.batch]
            ps = order_p[np.arange(k * len(order_p) // per_epoch, max((k + 1) * len(order_p) // per_epoch,
                                                                       k * len(order_p) // per_epoch + 1)) % len(order_p)]
            rows = [positive[i] for i in ps] + [unlabelled[i] for i in us]
            norms = np.array([norm_p[i] for i in ps] + [norm_u[i] for i in us])
            ends = np.cumsum([len(x) for x in rows])
            flat = np.concatenate(rows)
            sums = np.diff(np.concatenate([[0.0], np.cumsum(w[flat])])[np.concatenate([[0], ends])])
            g = sums * norms + w[size] + b
            s = 1.0 / (1.0 + np.exp(-np.clip(g, -50, 50)))
            n = len(ps)
            as_clean_p, as_clean_u = np.logaddexp(0, g[:n]).mean(), np.logaddexp(0, g[n:]).mean()
            slope = np.empty_like(g)
            if as_clean_u - prior * as_clean_p >= -p.slack:
                slope[:n] = prior * ((s[:n] - 1) - s[:n]) / n  # P as toxic, less P as clean
                slope[n:] = s[n:] / len(us)
            else:  # climb back out of the negative part
                slope[:n] = prior * s[:n] / n
                slope[n:] = -s[n:] / len(us)
            grad = np.bincount(flat, np.repeat(slope * norms, np.diff(np.concatenate([[0], ends]))), size + 1).astype(np.float64)
            grad[size] = slope.sum()
            grad[:size] += p.decay * w[:size]
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            w -= p.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return LinearModel(w[:size].astype(np.float32), chosen, b + w[size])


def corpus_counts(texts: DataFrame, text_col: str, grams: NgramPresence) -> tuple[np.ndarray, int]:
    """How many of all texts have each n-gram, and how many texts there are.

    Each task counts its texts in one array; only (n-gram, count) rows are shuffled, and
    2**bits of them reach the driver whatever the data.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << grams.bits, np.int64), 0
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                total[grams(text)] += 1
                n += 1
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(ids, -1)), pa.array(np.append(total[ids], n))], names=["gram", "n"])

    found = texts.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found.column("gram").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros(1 << grams.bits, np.int64)
    counts[ids[ids >= 0]] = n[ids >= 0]
    return counts, int(n[ids < 0].sum())


def to_bin(margin: np.ndarray, p: ToxicityParams) -> np.ndarray:
    return np.floor(np.clip(margin, -p.widest, p.widest) * p.bins).astype(np.int64)


def margin_histogram(texts: DataFrame, text_col: str, fold_col: str, models: list[LinearModel],
                     p: ToxicityParams) -> tuple[np.ndarray, np.ndarray]:
    """Margin bins of all texts, each scored by the model of its own fold, and their counts: 2 * widest * bins + 1 rows at most."""
    shared = texts.sparkSession.sparkContext.broadcast(cloudpickle.dumps(models))  # 2**bits weights per fold, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_fold, grams = cloudpickle.loads(shared.value), p.grams()
        for batch in batches:
            folds = batch.column(1).to_pylist()
            margins = [by_fold[k].margin(grams(t)) for k, t in zip(folds, text_bytes(batch.column(0)), strict=True)]
            bins, n = np.unique(to_bin(np.array(margins), p), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n.astype(np.int64))], names=["bin", "n"])

    found = texts.select(text_col, fold_col).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    return found.column("bin").to_numpy(), found.column("n").to_numpy()


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> LinearModel:
    """Fit on toxic labels of the training fold against the corpus without regard to labels.

    The unlabelled side is drawn from all documents, as the risk estimator assumes: the
    n-grams are chosen by their share of all documents, the cut by the margins of all
    documents; only mini-batches come from a sample of documents that no label names.
    A document's margin comes from the model that leaves its fold out.  A repeated row
    counts each time.  The prior is the share of toxic ones among all labelled rows of
    the training fold.  Without a label of either kind every text scores the prior (0.5
    if there is none).
    """
    ids = ids_of(docs, id_col)
    found = land(ids.join(votes(labels, id_col, label_col), "doc_id"), "votes")
    counts = found.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    prior = float(np.clip((counts["toxic"] or 0) / counts["n"], 1e-4, 0.5)) if counts["n"] else 0.5
    free = ids.join(ids_of(labels, id_col), "doc_id", "left_anti")
    chosen = land(bounded_sample(found.where("y = 1").select("doc_id"), params.max_positive).withColumn("y", F.lit(1)).unionByName(
        bounded_sample(free, params.max_unlabelled).withColumn("y", F.lit(0))), "chosen")
    fold = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long"), F.lit(params.seed)), F.lit(params.folds))
    rows = land(presence_rows(texts_of(docs, chosen, id_col, text_col), "text", "ids", params.grams()).withColumn(
        "fold", fold("doc_id")), "presence")
    (positive, fold_p), (unlabelled, fold_u) = (
        (collect_presence(side, "ids"), side.select("fold").toArrow().column(0).to_numpy())
        for side in (rows.where(F.col("y") == y).orderBy("doc_id") for y in (1, 0)))
    if not any(map(len, positive)) or not any(map(len, unlabelled)):
        return fit_nnpu(positive, unlabelled, prior, params)
    in_u, n_u = corpus_counts(docs, text_col, params.grams())
    model = fit_nnpu(positive, unlabelled, prior, params, in_u, n_u)
    if min(len(positive), len(unlabelled)) < params.folds or not model.chosen.any():
        return model
    others = [fit_nnpu([x for x, f in zip(positive, fold_p, strict=True) if f != k],
                       [x for x, f in zip(unlabelled, fold_u, strict=True) if f != k], prior, params, in_u, n_u)
              for k in range(params.folds)]
    bins, n = margin_histogram(docs.select(F.col(text_col).alias("text"), fold(id_col).alias("fold")), "text", "fold", others, params)
    confirmed = to_bin(np.array([others[f].margin(x) for x, f in zip(positive, fold_p, strict=True)]), params)
    middle = lambda x: (x + 0.5) / params.bins
    return replace(model, cut=pick_cut(middle(confirmed), middle(bins), prior, n.astype(np.float64)))


def score(docs: DataFrame, model: LinearModel, params: ToxicityParams = ToxicityParams(), text_col: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic.  Null texts score like empty ones."""
    return with_score(docs, text_col, name, params.grams(), model)


def keep_clean(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are."""
    name = fresh("toxicity", docs.columns)
    model = train(docs, labels, params, id_col, text_col)
    return score(docs, model, params, text_col, name).where(F.col(name) < params.threshold).drop(name)
