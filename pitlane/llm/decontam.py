"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: '1' positions are hashed, '0'
positions are ignored, so a substituted word there doesn't matter.  The masks below
hit every such window with at most a fifth of its words substituted (the tests try
all patterns).  Training hashes first pass a bit filter built from the test hashes,
whose size is bounded by a parameter; what passes is joined with the test hashes.
Around each hit the text is laid against the item along the hit's diagonal, and
an overlap counts if some window agrees in 80 % of its words.  Items too short for
that are hashed whole and must occur word for word.  Characters of scripts without
spaces between words are words of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import fresh, land, text_bytes

#: Together they hit every window of 10 to 19 words with at most a fifth of its words substituted.
MASKS = ("110111", "11010011", "11111")


@dataclass(frozen=True)
class DecontamParams:
    """``window`` words (the whole item if shorter) must agree in ``similarity`` of them.

    The masks are sure to hit for windows of 10 to 19 words at 0.8.  Items under
    ``min_words`` words must occur whole, word for word; those under ``alone_words``
    words are everyday wording, and match documents that hold nothing else.
    """

    window: int = 13
    similarity: float = 0.8
    min_words: int = 10
    alone_words: int = 3
    max_filter_bits: int = 1 << 27


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.full(4096, 0xD6E8FEB86659FD93, np.uint64))


#: Characters of Thai, Lao, Tibetan, Burmese, Khmer, kana, Bopomofo and Han: no spaces part their words.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u312f\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff]")


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: a run of letters, digits and non-ASCII characters, in lower case.

    Each character of a script without spaces is a word.
    """
    line = text.decode("utf-8", "replace").lower()
    if not line.isascii():
        line = _UNSPACED.sub(r" \g<0> ", line)
    data = np.frombuffer(line.encode() + b" ", np.uint8)
    inside = _WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    # sum over the letters of letter times an odd power for its place in the word, then mixed
    letters = data[inside].astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
    place = np.arange(len(letters)) - np.repeat(begin, ends - starts)
    power = _POWERS[place & 4095] + ((place >> 12) << 1).astype(np.uint64)
    hashed = np.add.reduceat((letters + np.uint64(1)) * power, begin)
    hashed ^= hashed >> np.uint64(32)
    return hashed * _MIX


def seed_hashes(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash under ``mask`` at each word where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, salt + 1, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ words[k:k + n]) * _BASE
            out ^= out >> np.uint64(29)
    return out * _MIX


def whole_seeds(words: np.ndarray, length: int, p: DecontamParams) -> np.ndarray:
    """The hash of every ``length`` words in a row; for very short items only if there are no other words."""
    if length < p.alone_words and len(words) != length:
        return np.empty(0, np.uint64)
    return seed_hashes(words, "1" * length, len(MASKS) + length)


def index_items(items: DataFrame, p: DecontamParams, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, hashes) per item: its word hashes and (seed hash, word number) pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("hash", pa.int64()), ("at", pa.int32())])
        for batch in batches:
            words, pairs = [], []
            for text in text_bytes(batch.column(1)):
                w = word_hashes(text)
                words.append(w.view(np.int64))
                seeds = ([seed_hashes(w, mask, m) for m, mask in enumerate(MASKS)] if len(w) >= p.min_words
                         else [whole_seeds(w, len(w), p)] if len(w) else [])
                pairs.append([{"hash": int(h), "at": i} for found in seeds for i, h in enumerate(found.view(np.int64))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64())), pa.array(pairs, pa.list_(pair))],
                                             names=["item_id", "words", "hashes"])

    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col))
    return rows.distinct().mapInArrow(run, "item_id long, words array<long>, hashes array<struct<hash:long,at:int>>").where(
        F.size("words") > 0)


def hash_filter(hashes: DataFrame, max_bits: int) -> np.ndarray:
    """Bits (packed, little-endian) set at two places per test hash; about 32 bits a hash, ``max_bits`` at most."""
    n = hashes.count()
    size = 1 << 16
    while size < min(max_bits, 32 * n):
        size *= 2
    places = hashes.select(F.explode(F.array(
        F.col("hash").bitwiseAND(F.lit(size - 1)),
        F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(size - 1)))).alias("at"))
    longs = places.select(F.shiftright("at", 6).alias("slot"), F.expr(
        "shiftleft(1L, cast(at & 63 AS int))").alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()  # size / 64 rows at most
    out = np.zeros(size // 64, np.int64)
    out[longs["slot"].to_numpy()] = longs["bits"].to_numpy()
    return out.view(np.uint8)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have both their bits set."""
    size = np.uint64(len(bits) * 8 - 1)
    test = lambda at: (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    found = np.flatnonzero(test(hashes & size))
    return found[test((hashes[found] >> np.uint64(32)) & size) == 1]


def hit_segments(docs: DataFrame, bits: np.ndarray, p: DecontamParams, short: list[int] = ()) -> DataFrame:
    """(doc_id, text_key, start, words, hits) for each stretch of a document around hits that pass the filter.

    Hits closer than two windows share a stretch, which has a window's words on either
    side, so every window with a hit lies inside it.  ``short`` are the lengths of the
    items that have to occur whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(sent.value, np.uint8)
        pair = pa.struct([("hash", pa.int64()), ("at", pa.int32())])
        for batch in batches:
            keys, starts, words, hits = [], [], [], []
            for i, text in enumerate(text_bytes(batch.column(2))):
                w = word_hashes(text)
                at, found = [], []
                for h in (*(seed_hashes(w, mask, m) for m, mask in enumerate(MASKS)), *(whole_seeds(w, n, p) for n in short)):
                    near = passes(table, h)
                    at.append(near)
                    found.append(h[near])
                at, found = np.concatenate(at), np.concatenate(found).view(np.int64)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                cuts = np.flatnonzero(np.diff(at) > 2 * p.window) + 1
                for a, h in zip(np.split(at, cuts), np.split(found, cuts), strict=True):
                    lo, hi = max(0, int(a[0]) - p.window), int(a[-1]) + 2 * p.window
                    keys.append(i)
                    starts.append(lo)
                    words.append(w[lo:hi].view(np.int64))
                    hits.append([{"hash": x, "at": y} for x, y in zip(h.tolist(), (a - lo).tolist(), strict=True)])
            pick = pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(starts, pa.int64()),
                 pa.array(words, pa.list_(pa.int64())), pa.array(hits, pa.list_(pair))],
                names=["doc_id", "text_key", "start", "words", "hits"])

    return docs.mapInArrow(run, "doc_id long, text_key long, start long, words array<long>, hits array<struct<hash:long,at:int>>")


def align(text: np.ndarray, item: np.ndarray, shift: int, window: int) -> tuple[float, int, int]:
    """The best window of ``item`` laid ``shift`` words into ``text``: share that agrees, its place in text, its length."""
    size = min(window, len(item))
    lo, hi = max(0, shift), min(len(text), shift + len(item))
    if hi - lo < size:
        return 0.0, 0, size
    same = np.concatenate([[0], np.cumsum(text[lo:hi] == item[lo - shift:hi - shift])])
    agree = same[size:] - same[:-size]
    best = int(np.argmax(agree))
    return float(agree[best]) / size, lo + best, size


def overlaps(docs: DataFrame, items: DataFrame, params: DecontamParams = DecontamParams(), id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start, words): the best verified window of each document and item.

    ``text_key`` is the XXH64 of the text: with the id it names a row, and repeated
    rows give one result.  ``start`` counts the document's words before the window.
    Null and empty texts match nothing; null ids are kept as they are.
    """
    index = land(index_items(items, params, item_col, item_text_col).withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = index.select("item", F.explode("hashes").alias("h")).select("item", "h.hash", F.col("h.at").alias("item_at"))
    bits = hash_filter(seeds.select("hash").distinct(), params.max_filter_bits)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"),
                                                           F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    # below min_words, so at most that many lengths
    short = [r[0] for r in index.where(F.size("words") < params.min_words).select(F.size("words")).distinct().collect()]
    segments = land(hit_segments(texts, bits, params, short).withColumn("segment", F.monotonically_increasing_id()), "segments")
    hits = segments.select("segment", F.explode("hits").alias("h")).select("segment", "h.hash", F.col("h.at").alias("at"))
    # one row for each way to lay an item against a stretch
    laid = hits.join(seeds, "hash").select("segment", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = laid.join(index.select("item", "item_id", F.col("words").alias("item_words")), "item").join(
        segments.drop("hits"), "segment")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, item = batch.column("words"), batch.column("item_words")
            found = [align(text[i].values.to_numpy(), item[i].values.to_numpy(), s, params.window)
                     for i, s in enumerate(batch.column("shift").to_pylist())]
            need = [params.similarity - 1e-9 if len(x) >= params.min_words else 1.0 for x in item]
            good = pa.array([i for i, f in enumerate(found) if f[0] >= need[i]], pa.int64())
            start = batch.column("start").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(good) for c in ("doc_id", "text_key", "item_id")]
                + [pa.array([found[i][0] for i in good.to_pylist()], pa.float64()),
                   pa.array([int(start[i]) + found[i][1] for i in good.to_pylist()], pa.int64()),
                   pa.array([found[i][2] for i in good.to_pylist()], pa.int32())],
                names=["doc_id", "text_key", "item_id", "similarity", "start", "words"])

    verified = pairs.mapInArrow(verify, "doc_id long, text_key long, item_id long, similarity double, start long, words int")
    best = verified.groupBy("doc_id", "text_key", "item_id").agg(
        F.min(F.struct(-F.col("similarity"), "start", "words")).alias("best"))
    return best.select("doc_id", "text_key", "item_id", (-F.col("best.col1")).alias("similarity"), "best.start", "best.words")


def keep_uncontaminated(docs: DataFrame, items: DataFrame, params: DecontamParams = DecontamParams(), id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified overlap with any item, all columns as they are."""
    name, key = (fresh(x, docs.columns) for x in ("found_id", "found_key"))
    bad = land(overlaps(docs, items, params, id_col, text_col).select(
        F.col("doc_id").alias(name), F.col("text_key").alias(key)).distinct(), "contaminated")
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col(name)) & (F.xxhash64(text_col) == F.col(key)), "left_anti")
