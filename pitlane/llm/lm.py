"""Masked pseudo-likelihood scoring with a bidirectional window network.

Tokens are words: the corpus's frequent ones each have an id, and their list grows
with the corpus; the rest share hash buckets, and each of them has its share of its
bucket from the whole corpus's word counts.  A network sees ``window`` tokens on either side of a masked place
and predicts the token there: embeddings, one tanh layer, then a softmax over
classes of tokens and one over the tokens of the class.  It is trained in numpy on
every document: each partition starts from the same weights, takes steps over its
own texts, and the partitions' weights are averaged by their token counts, a few
at a time, until one model is left; further rounds mask the other places, so that
every token is predicted in training.  A document's
score is the sum of its tokens' log-probabilities, each given both sides; a word
out of the list has log p(bucket | both sides) + log p(word | bucket).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import land


@dataclass(frozen=True)
class LmParams:
    """``classes * class_size`` tokens: ``buckets`` of them hashed, the others the most frequent words.

    These are the least: ``vocabulary`` makes them larger with the corpus.  The
    ``rounds`` passes share the places of a text among them, ``stride`` in turn: each is
    masked in one pass, or in more if there are more passes than ``stride``.
    ``held`` is how many words out of the list a task looks up itself, ``slice`` how many
    weights of ``fan_in`` models are averaged in one group.
    """

    classes: int = 32
    class_size: int = 32
    buckets: int = 256
    window: int = 2
    width: int = 12
    hidden: int = 32
    stride: int = 8
    rounds: int = 2
    batch: int = 8192
    rate: float = 0.012
    fan_in: int = 64
    held: int = 1 << 17
    slice: int = 1 << 16
    seed: int = 5

    @property
    def size(self) -> int:
        return self.classes * self.class_size


# -- tokens ----------------------------------------------------------------------------------------


def word_counts(docs: DataFrame, text_col: str = "text", held: int = 200_000) -> DataFrame:
    """(word, n) over all documents: lower-case runs without white space, summed per task before they are dealt out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                              names=["word", "n"])

        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update((text or "").lower().split())
                if len(found) > held:
                    yield rows()
                    found = Counter()
        yield rows()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Tokens(dict):
    """Word -> code: the id of a listed word, then the places of the words of ``known``, then the buckets.

    ``known`` are (word, log p(word | bucket)) of some words out of the list.  Words that
    are neither get their bucket's code, remembered for the first ``held`` of them.
    """

    def __init__(self, words: list[str], p: LmParams, known: list[tuple[str, float]] = (), held: int = 200_000):
        super().__init__((w, i) for i, w in enumerate(words))
        self.first, self.buckets, self.size, self.held = p.size - p.buckets, p.buckets, p.size, held + len(words) + len(known)
        self.update((w, p.size + i) for i, (w, _) in enumerate(known))
        every = np.arange(p.size + len(known) + p.buckets)
        every[p.size:] = self.first + np.array([self.bucket(w) for w, _ in known] + [*range(p.buckets)], np.int64)
        self.id_of, self.unknown = every.astype(np.int32), p.size + len(known)
        self.shares = np.zeros(len(every))
        self.shares[p.size:self.unknown] = [x for _, x in known]

    def bucket(self, word: str) -> int:
        return zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.buckets

    def __missing__(self, word: str) -> int:
        found = self.unknown + self.bucket(word)
        if len(self) < self.held:
            self[word] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        return self.id_of[self.codes(text.lower().split())]

    def codes(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def ids_and_rest(self, text: str) -> tuple[np.ndarray, float, Counter[int]]:
        """The ids of a text, the known words' summed shares, and how often it has each other word out of the list, by hash."""
        words = text.lower().split()
        codes = self.codes(words)
        hashes = (xxhash.xxh64_intdigest(words[i].encode("utf-8", "surrogatepass"), 42)
                  for i in np.flatnonzero(codes >= self.unknown).tolist())
        return self.id_of[codes], float(self.shares[codes].sum()), Counter(hashes)


def _top(counts: DataFrame, most: int) -> list[str]:
    return [r["word"] for r in counts.orderBy(F.col("n").desc(), "word").limit(most).collect()]


def frequent_words(docs: DataFrame, p: LmParams, text_col: str = "text") -> list[str]:
    """The most frequent words, ties in alphabetical order: ``size - buckets`` at most."""
    return _top(word_counts(docs, text_col), p.size - p.buckets)


def vocabulary(counts: DataFrame, p: LmParams) -> tuple[list[str], LmParams]:
    """The words with an id of their own, and ``p`` grown to hold them.

    ``counts`` is a written table of ``word_counts``.  Every word that occurs at least
    max(sqrt(N), N / 2^16) times among the corpus's N words has an id, and never fewer
    than the ``size - buckets`` most frequent ones: at most sqrt(N) and at most 2^16
    words.  Classes, their size and the buckets grow in proportion; so do the
    mini-batches, as an update costs as much as there are weights.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(math.sqrt(total), total / (1 << 16))).collect()
    grown = len(often) / (p.size - p.buckets)
    if grown <= 1:
        return _top(counts, p.size - p.buckets), p
    side = math.sqrt(grown)
    return [r["word"] for r in sorted(often, key=lambda r: (-r["n"], r["word"]))], replace(
        p, classes=math.ceil(p.classes * side), class_size=math.ceil(p.class_size * side), buckets=int(p.buckets * grown),
        batch=int(p.batch * grown))


def bucket_shares(counts: DataFrame, words: list[str], p: LmParams) -> DataFrame:
    """(word, n, share) of each counted word out of the list: log p(word | bucket)."""
    listed = counts.sparkSession.createDataFrame([(w,) for w in words], "word string")
    rest = counts.join(F.broadcast(listed), "word", "left_anti").withColumn("bucket", F.crc32(F.col("word").cast("binary")) % p.buckets)
    sums = rest.groupBy("bucket").agg(F.sum("n").alias("total"))
    return rest.join(F.broadcast(sums), "bucket").select("word", "n", F.log(F.col("n") / F.col("total")).alias("share"))


def held_shares(shares: DataFrame, p: LmParams) -> list[tuple[str, float]]:
    """(word, share) of the ``held`` most frequent words of a written table of ``bucket_shares``."""
    top = shares.orderBy(F.col("n").desc(), "word").limit(p.held).select("word", "share").toArrow()
    return list(zip(top["word"].to_pylist(), top["share"].to_pylist(), strict=True))


# -- network ---------------------------------------------------------------------------------------


class Network:
    """Weights in one float32 vector ``flat``, seen as named arrays."""

    def __init__(self, p: LmParams, flat: np.ndarray | None = None):
        self.p = p
        shapes = {"embed": (p.size + 1, p.width), "w1": (2 * p.window * p.width, p.hidden), "b1": (p.hidden,),
                  "wc": (p.hidden, p.classes), "bc": (p.classes,),
                  "ww": (p.classes, p.hidden, p.class_size), "bw": (p.classes, p.class_size)}
        sizes = [int(np.prod(s)) for s in shapes.values()]
        if flat is None:
            rng = np.random.default_rng(p.seed)
            flat = np.concatenate([rng.normal(0, 0 if k[0] == "b" else 0.5 if k == "embed" else 1 / np.sqrt(s[-2]),
                                              n).astype(np.float32) for (k, s), n in zip(shapes.items(), sizes, strict=True)])
        self.flat = np.array(flat, np.float32)
        at = 0
        for (name, shape), n in zip(shapes.items(), sizes, strict=True):
            setattr(self, name, self.flat[at:at + n].reshape(shape))
            at += n

    def by_class(self, target: np.ndarray) -> np.ndarray:
        """The order by target; 16-bit numbers are sorted by radix."""
        return np.argsort(target.astype(np.uint16) if self.p.size < 1 << 16 else target, kind="stable")

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log p(target | both sides) per row.

        Works on columns ordered by class, so that each class is a slice and the sums
        of the softmaxes run over whole rows.
        """
        size = self.p.class_size
        order = self.by_class(target)
        target = target[order]
        x = self.embed.take(context.take(order, axis=0), axis=0).reshape(len(order), -1)
        h = np.tanh(self.w1.T @ x.T + self.b1[:, None])

        def picked(z: np.ndarray, of: np.ndarray) -> np.ndarray:
            top = z.max(axis=0)
            return z[of, np.arange(z.shape[1])] - top - np.log(np.exp(z - top).sum(axis=0))

        found = picked(self.wc.T @ h + self.bc[:, None], target // size)
        cuts = np.searchsorted(target, np.arange(self.p.classes + 1) * size)
        for c in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[c], cuts[c + 1])
            found[own] += picked(self.ww[c].T @ h[:, own] + self.bw[c][:, None], target[own] % size)
        out = np.empty_like(found)
        out[order] = found
        return out

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Gradient of the mean negative log-probability, laid out like ``flat``."""
        n, size = len(target), self.p.class_size
        g = Network(self.p, np.zeros_like(self.flat))
        order = self.by_class(target)  # each class is a slice, as in ``log_probs``
        context, target = context.take(order, axis=0), target[order]
        x = self.embed.take(context, axis=0).reshape(n, -1)
        h = np.tanh(self.w1.T @ x.T + self.b1[:, None])

        def off(z: np.ndarray, of: np.ndarray) -> np.ndarray:
            z -= z.max(axis=0)
            np.exp(z, out=z)
            z /= z.sum(axis=0) * np.float32(n)
            z[of, np.arange(z.shape[1])] -= np.float32(1 / n)
            return z

        d = off(self.wc.T @ h + self.bc[:, None], target // size)
        g.wc += h @ d.T
        g.bc += d.sum(axis=1)
        dh = self.wc @ d
        cuts = np.searchsorted(target, np.arange(self.p.classes + 1) * size)
        for c in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[c], cuts[c + 1])
            d = off(self.ww[c].T @ h[:, own] + self.bw[c][:, None], target[own] % size)
            g.ww[c] += h[:, own] @ d.T
            g.bw[c] += d.sum(axis=1)
            dh[:, own] += self.ww[c] @ d
        dh *= 1 - h * h
        g.w1 += x.T @ dh.T
        g.b1 += dh.sum(axis=1)
        dx = (self.w1 @ dh).reshape(2 * self.p.window, self.p.width, n)
        flat = context.T.ravel()
        for k in range(self.p.width):
            g.embed[:, k] += np.bincount(flat, dx[:, k].ravel(), self.p.size + 1)
        return g.flat


def examples(texts: list[np.ndarray], p: LmParams, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, target, document) for every token, or those at ``places``; beyond a text is the padding id ``size``."""
    pad = np.full(p.window, p.size, np.int32)
    line = np.concatenate([pad, *[x for t in texts for x in (t, pad)]])
    lengths = np.array([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), lengths)
    doc = doc if places is None else doc[places]
    # a text's tokens lie one padding further on for each text before it
    at = p.window * (doc + 1) + (np.arange(len(doc)) if places is None else places)
    steps = [k for k in range(-p.window, p.window + 1) if k]
    return np.stack([line.take(at + k) for k in steps], axis=1), line.take(at), doc


def masked(n: int, p: LmParams, number: int) -> np.ndarray:
    """The places of ``n`` that round ``number`` masks; all rounds together mask every place."""
    turns = min(p.rounds, p.stride)
    return np.flatnonzero(np.arange(n) % p.stride % turns == number % turns)


class Trainer:
    """Adam over mini-batches of masked places, from given weights."""

    def __init__(self, p: LmParams, flat: np.ndarray):
        self.net, self.p, self.step = Network(p, flat), p, 0
        self.first, self.second = np.zeros_like(self.net.flat), np.zeros_like(self.net.flat)

    def fit(self, context: np.ndarray, target: np.ndarray) -> None:
        for at in range(0, len(target), self.p.batch):
            g = self.net.gradient(context[at:at + self.p.batch], target[at:at + self.p.batch])
            self.step += 1
            self.first += 0.1 * (g - self.first)
            self.second += 0.01 * (g * g - self.second)
            self.net.flat -= self.p.rate * (self.first / (1 - 0.9 ** self.step)) / (
                np.sqrt(self.second / (1 - 0.99 ** self.step)) + 1e-7)


# -- jobs ------------------------------------------------------------------------------------------


def encode(docs: DataFrame, words: list[str], p: LmParams, id_col: str = "doc_id", text_col: str = "text",
           known: list[tuple[str, float]] = ()) -> DataFrame:
    """(row, doc_id, ids, share, rest, times) per row of ``docs``: the ids of its words; none for a null text.

    ``share`` sums the shares of its words in ``known``; ``rest`` are the XXH64 hashes of
    its other words out of the list and ``times`` how often each occurs; ``row`` numbers the rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((words, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(sent.value[0], p, sent.value[1])

        def lists(parts: list, kind: type) -> pa.ListArray:
            flat = np.concatenate([np.asarray(x, kind) for x in [*parts, []]])
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(flat))

        for batch in batches:
            found = [tokens.ids_and_rest(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists([ids for ids, _, _ in found], np.int32), pa.array([x for _, x, _ in found], pa.float64()),
                 lists([np.fromiter(r, np.uint64, len(r)).view(np.int64) for _, _, r in found], np.int64),
                 lists([list(r.values()) for _, _, r in found], np.int32)], names=["row", "doc_id", "ids", "share", "rest", "times"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(
        run, "row long, doc_id long, ids array<int>, share double, rest array<long>, times array<int>")


def _groups(column: pa.ListArray, most: int = 1 << 16) -> Iterator[tuple[int, list[np.ndarray]]]:
    """A batch's token ids, some texts at a time: (place of the first in the batch, ids)."""
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield start, [flat[a:b] for a, b in zip(ends[start:stop], ends[start + 1:stop + 1], strict=True)]
        start = stop


def _round(encoded: DataFrame, flat: np.ndarray, p: LmParams, number: int) -> np.ndarray:
    """One pass over all documents from ``flat``: the average of the partitions' weights."""
    sent = encoded.sparkSession.sparkContext.broadcast(flat.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = Trainer(p, np.frombuffer(sent.value, np.float32)), 0
        rng = np.random.default_rng([p.seed, number])
        for batch in batches:
            for _, ids in _groups(batch.column(0)):
                places = masked(sum(map(len, ids)), p, number)
                rng.shuffle(places)
                context, target, _ = examples(ids, p, places)
                trainer.fit(context, target)
                seen += len(places)
        if seen:
            slices = [trainer.net.flat[at:at + p.slice].tobytes() for at in range(0, len(flat), p.slice)]
            k = len(slices)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.array([TaskContext.get().partitionId()] * k, pa.int64()),
                 pa.array([float(seen)] * k), pa.array(slices, pa.binary())], names=["slice", "part", "n", "flat"])

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        total = group["n"].sum()
        flat = sum(np.frombuffer(w, np.float32).astype(np.float64) * (n / total)
                   for _, w, n in sorted(zip(group["part"], group["flat"], group["n"], strict=True)))
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "part": [int(group["part"].iloc[0]) // p.fan_in], "n": [total],
                             "flat": [flat.astype(np.float32).tobytes()]})

    schema = "slice int, part long, n double, flat binary"
    models = land(encoded.select("ids").mapInArrow(run, schema), "models")
    top = models.agg(F.max("part")).first()[0]
    if top is None:
        return flat
    while True:  # a group averages a slice of fan_in models at most
        models = land(models.groupBy("slice", F.floor(F.col("part") / p.fan_in).alias("g")).applyInPandas(mean, schema), "models")
        top //= p.fan_in
        if not top:
            return np.concatenate([np.frombuffer(r["flat"], np.float32) for r in models.orderBy("slice").collect()])


@dataclass(frozen=True)
class LanguageModel:
    params: LmParams
    words: list[str]
    flat: np.ndarray


def fit(encoded: DataFrame, words: list[str], params: LmParams = LmParams()) -> LanguageModel:
    """Train on all rows of a written table of ``encode``.  Without any word the weights stay as they began."""
    flat = Network(params).flat
    for number in range(params.rounds):
        flat = _round(encoded, flat, params, number)
    return LanguageModel(params, words, flat)


def score(encoded: DataFrame, model: LanguageModel, shares: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) per row of ``encoded``.

    ``shares`` (see ``bucket_shares``) gives words out of the list their own
    probability; those that ``encode`` knew are summed up there already, the others are
    joined.  Without it words out of the list have their bucket's.  With it, ``encoded`` must be
    written, as its rows are read twice.  A text without tokens (null, empty, white
    space) has log_prob 0 and no mean.  Repeated rows each have their own.
    """
    p, sent = model.params, encoded.sparkSession.sparkContext.broadcast(model.flat.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(p, np.frombuffer(sent.value, np.float32))
        for batch in batches:
            count, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for start, ids in _groups(batch.column(2)):
                context, target, doc = examples(ids, p)
                order = net.by_class(target)  # so that a slice has few classes
                context, target, doc = context.take(order, axis=0), target[order], doc[order]
                for at in range(0, len(target), 1 << 12):  # by slices that stay in the processor's cache
                    some = slice(at, at + (1 << 12))
                    logs = net.log_probs(context[some], target[some]).astype(np.float64)
                    total[start:start + len(ids)] += np.bincount(doc[some], logs, len(ids))
                count[start:start + len(ids)] = [len(x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(count), pa.array(total)],
                                             names=["row", "doc_id", "n_tokens", "log_prob"])

    found = encoded.select("row", "doc_id", "ids").mapInArrow(run, "row long, doc_id long, n_tokens long, log_prob double")
    if shares is not None:
        # words are joined by their hash; a listed word's own share is in ``share`` already
        own = shares.groupBy(F.xxhash64("word").alias("hash")).agg(F.min("share").alias("own"))
        rest = encoded.select("row", F.explode(F.arrays_zip("rest", "times")).alias("r")).select(
            "row", F.col("r.rest").alias("hash"), F.col("r.times").alias("times"))
        rest = rest.join(own.hint("shuffle_hash"), "hash").groupBy("row").agg(F.sum(F.col("times") * F.col("own")).alias("more"))
        more = encoded.select("row", "share").join(rest, "row", "left").select(
            "row", (F.col("share") + F.coalesce("more", F.lit(0.0))).alias("more"))
        found = found.join(more, "row").withColumn("log_prob", F.col("log_prob") + F.col("more"))
    return found.select("doc_id", "n_tokens", "log_prob",
                        F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))


def train_and_score(docs: DataFrame, params: LmParams = LmParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count words, train on all of ``docs`` and score every row (see ``score``)."""
    counts = land(word_counts(docs, text_col), "words")
    words, params = vocabulary(counts, params)
    shares = land(bucket_shares(counts, words, params), "shares")
    encoded = land(encode(docs, words, params, id_col, text_col, held_shares(shares, params)), "encoded")
    return score(encoded, fit(encoded, words, params), shares)
