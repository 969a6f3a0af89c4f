"""Ranked lexical search by pipelined term partitioning.

Documents are dealt into blocks as they are read; a block has one postings list per
term.  Terms are owned by stages, by the share of documents that hold them, rare ones
first.  A bundle is up to ``bundle_items`` items and, for one block, a sparse
accumulator of document scores per item.  It passes through the stages in turn: each
cogroups the bundles with the postings that it owns and adds their integer
contributions, and the last one, which owns the most frequent terms, selects the
best documents of the block.  A merge over the blocks keeps the best of all.

A task holds one bundle and one block, whatever the size of the tables.  The only
broadcasts are a bit filter of bounded size, which keeps postings of terms of no item
out, and the owners of ``most_common`` frequent terms.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import join_hot, land, text_bytes

#: Bytes of a term stay, A-Z in lower case; all others part terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class SearchParams:
    """``shares``: a stage owns the terms that at most this share of the documents hold; the last owns the rest.

    ``length_weight`` of a hundred is how much a document's length counts.  A block
    ends at ``block_docs`` documents or ``block_tokens`` terms.  Owners change how far
    accumulators fill up on the way, never a result.
    """

    k: int = 10
    shares: tuple[float, ...] = (1 / 512, 1 / 32, 1 / 8)
    length_weight: int = 75
    block_docs: int = 8192
    block_tokens: int = 1 << 22
    bundle_items: int = 256
    most_common: int = 4096
    filter_bits: int = 1 << 24


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all non-ASCII characters, only A-Z lower-cased."""
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, item, term, times): how often each item holds each of its terms.

    ``item`` is the text's XXH64: with the id it names an item, so repeated rows are one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t, n) for i, text in enumerate(text_bytes(batch.column(2))) for t, n in Counter(terms_of(text)).items()]
            at = pa.array([i for i, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([t for _, t, _ in found], pa.binary()),
                 pa.array([n for _, _, n in found], pa.int64())], names=["item_id", "item", "term", "times"])

    rows = items.select(F.col(id_col).alias("item_id"), F.xxhash64(text_col).alias("item"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL").distinct()
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {kind}, item long, term binary, times long")


def term_filter(terms: DataFrame, bits: int) -> bytes:
    """``bits`` bits, one set per term: at most bits / 64 longs reach the driver."""
    longs = terms.select((F.crc32("term") % bits).alias("at")).select(F.shiftright("at", 6).alias("slot"), F.expr(
        "shiftleft(1L, cast(at & 63 AS int))").alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(-(-bits // 64), np.int64)
    out[longs["slot"].to_numpy()] = longs["bits"].to_numpy()
    return out.tobytes()


# -- postings --------------------------------------------------------------------------------------


class Block:
    """Postings of some documents, gathered in the order in which they are read."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.tokens = 0
        self.lists: defaultdict[bytes, tuple[array, array]] = defaultdict(lambda: (array("i"), array("i")))

    def rows(self, number: int) -> pa.RecordBatch:
        """Its documents under a null term, then one row per term."""
        def lists(parts: list) -> pa.ListArray:
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.asarray(x, np.int32) for x in parts])))

        terms = list(self.lists)
        none = [[]] * len(terms)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(terms) + 1, number)), pa.array([None, *terms], pa.binary()),
             lists([[], *[self.lists[t][0] for t in terms]]), lists([[], *[self.lists[t][1] for t in terms]]),
             pa.array([self.ids, *none], pa.list_(pa.int64())), lists([self.lengths, *none])],
            names=["block", "term", "places", "counts", "doc_ids", "lengths"])


def postings(docs: DataFrame, bits: bytes, p: SearchParams, id_col: str, text_col: str) -> DataFrame:
    """(block, term, places, counts, doc_ids, lengths): the postings lists of each block.

    ``places`` are documents by their place in the block, ``counts`` how often they
    hold the term.  The row of a null term has all its documents: their ids and
    numbers of terms.  Documents without terms are in no block.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, known = np.frombuffer(sent.value, np.uint8), {}

        def wanted(term: bytes) -> bool:
            if (found := known.get(term)) is None:
                at = zlib.crc32(term) % p.filter_bits
                found = bool(marks[at >> 3] >> (at & 7) & 1)
                if len(known) < 1 << 18:
                    known[term] = found
            return found

        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                for term, n in Counter(terms).items():
                    if wanted(term):
                        places, counts = block.lists[term]
                        places.append(len(block.ids))
                        counts.append(n)
                block.ids.append(doc)
                block.lengths.append(len(terms))
                block.tokens += len(terms)
                if len(block.ids) == p.block_docs or block.tokens >= p.block_tokens:
                    yield block.rows(number)
                    number, block = number + 1, Block()
        if block.ids:
            yield block.rows(number)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(
        run, "block long, term binary, places array<int>, counts array<int>, doc_ids array<long>, lengths array<int>")


# -- stages ----------------------------------------------------------------------------------------


def _best(scores: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, ties to the smaller id, null ids last."""
    held = np.flatnonzero(scores > 0)
    if len(held) > k:
        held = held[scores[held] >= np.partition(scores[held], len(held) - k)[len(held) - k]]
    return np.array(sorted(held.tolist(), key=lambda i: (-scores[i], not ids[i].is_valid, ids[i].as_py() or 0))[:k], np.int64)


def _stage(stage: int, last: bool, corpus: tuple[int, int], p: SearchParams) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A bundle's accumulators after the postings that this stage owns; the last stage selects instead."""
    return lambda bundle, owned: _add_owned(bundle, owned, stage, last, corpus, p)


def _add_owned(bundle: pa.Table, owned: pa.Table, stage: int, last: bool, corpus: tuple[int, int], p: SearchParams) -> pa.Table:
    n_docs, n_terms = corpus
    bundle, owned = bundle.combine_chunks(), owned.combine_chunks()
    terms = owned.column("term").to_pylist()
    whole = terms.index(None)  # every block has this row
    ids, lengths = owned.column("doc_ids")[whole].values, owned.column("lengths")[whole].values.to_numpy().astype(np.int64)
    size = 100 - p.length_weight + (p.length_weight * lengths * n_docs) // n_terms
    gains: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
    for i, term in enumerate(terms):
        if term is not None:
            at, tf = owned.column("places")[i].values.to_numpy(), owned.column("counts")[i].values.to_numpy().astype(np.int64)
            gains[term] = at, (1_000_000_000 * tf) // (1000 * tf + 8 * size[at])
    found, rest = [], []
    for i in range(len(bundle)):
        mine = bundle.column("terms")[i].values
        owners, weights = (bundle.column(c)[i].values.to_numpy() for c in ("owners", "weights"))
        scores = np.zeros(len(ids), np.int64)
        scores[bundle.column("places")[i].values.to_numpy()] = bundle.column("scores")[i].values.to_numpy()
        for t in np.flatnonzero(owners == stage):
            if (held := gains.get(mine[t].as_py())) is not None:
                scores[held[0]] += weights[t] * held[1]
        place = _best(scores, ids, p.k) if last else np.flatnonzero(scores).astype(np.int32)
        found.append((place, scores[place]))
        rest.append(np.flatnonzero(owners > stage))
    counts = [len(x) for x, _ in found]
    places = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int32)
    scores = pa.array(np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64))
    if last:
        each = pa.array(np.repeat(np.arange(len(bundle)), counts))
        return pa.table({"item_id": bundle.column("item_id").take(each), "item": bundle.column("item").take(each),
                         "doc_id": ids.take(pa.array(places)), "score": scores})
    ends = pa.array(np.cumsum([0, *counts]).astype(np.int32))
    left = {c: pa.array([bundle.column(c)[i].values.take(pa.array(r)) for i, r in enumerate(rest)], bundle.schema.field(c).type)
            for c in ("terms", "owners", "weights")}
    return pa.table({**{c: bundle.column(c) for c in ("bundle", "block", "item_id", "item")}, **left,
                     "places": pa.ListArray.from_arrays(ends, pa.array(places)), "scores": pa.ListArray.from_arrays(ends, scores)})


def search(docs: DataFrame, items: DataFrame, p: SearchParams = SearchParams(), id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``p.k`` best documents of each item with a score above 0.

    Equal scores go by ascending doc_id, a null one last.  Every row of ``docs`` is a
    document, repeated rows too; null texts and texts without terms are none.  Items
    with a null text, without terms or without a matching document give no row; repeated
    item rows count once, and rows that share an id but not a text are ranked each on
    their own.  Other columns are not read.  Empty tables give an empty result.
    """
    asked = land(item_terms(items, item_col, item_text_col), "item-terms")
    lists = land(postings(docs, term_filter(asked, p.filter_bits), p, id_col, text_col), "postings")
    n_docs, n_terms, n_blocks = lists.where("term IS NULL").agg(
        F.sum(F.size("doc_ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.count(F.lit(1))).first()
    n_docs, n_terms = n_docs or 0, n_terms or 1
    holders = land(lists.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("places")).alias("df")), "holders")
    owner = sum((F.col("df") > share * n_docs).cast("int") for share in p.shares)
    # at most most_common rows; terms beyond them, however frequent, are owned by the first stage
    common = holders.where(F.col("df") > p.shares[0] * n_docs).orderBy(F.col("df").desc(), "term").limit(p.most_common).select(
        "term", owner.alias("owner"))
    common = land(common, "common")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    # bundles: the items' terms with owner and weight
    names = asked.select("item_id", "item").distinct()
    bundles = max(1, -(-names.count() // p.bundle_items))
    weighed = join_hot(asked, holders, "term").join(F.broadcast(common), "term", "left").select(
        "item_id", "item", F.pmod(F.xxhash64("item_id", "item"), F.lit(bundles)).cast("int").alias("bundle"),
        F.struct("term", F.coalesce("owner", F.lit(0)).alias("owner"), (weight * F.col("times")).alias("weight")).alias("t"))
    members = land(weighed.groupBy("item_id", "item", "bundle").agg(F.collect_list("t").alias("t")).select(
        "item_id", "item", "bundle", F.col("t.term").alias("terms"), F.col("t.owner").alias("owners"), F.col("t.weight").alias("weights")),
        "bundles")
    # every bundle meets every block once; salted, as a few bundles meet all blocks
    salts = max(1, -(-n_blocks // 64))
    each = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    documents = lists.where("term IS NULL")
    places = documents.select("block", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), each)
    carried = places.join(members.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["bundle", "salt"]).select(
        "bundle", "block", "item_id", "item", "terms", "owners", "weights",
        F.array().cast("array<int>").alias("places"), F.array().cast("array<long>").alias("scores"))
    # postings to the bundles that ask for them: rare terms by a join, common ones to all
    owned = lists.where("term IS NOT NULL").join(F.broadcast(common), "term", "left")
    wanting = land(weighed.where("t.owner = 0").select("t.term", "bundle").distinct(), "wanting")
    columns = ["bundle", "block", "term", "places", "counts", "doc_ids", "lengths"]
    for stage in range(len(p.shares) + 1):
        last = stage == len(p.shares)
        if stage:
            mine = owned.where(F.col("owner") == stage).select(each, *columns[1:])
        else:
            mine = owned.where("owner IS NULL OR owner = 0").join(wanting, "term").select(*columns)
        mine = mine.unionByName(documents.select(each, *columns[1:])).select(*[F.col(c).alias(c) for c in columns])
        out = T.StructType([carried.schema["item_id"], carried.schema["item"], T.StructField("doc_id", T.LongType()),
                            T.StructField("score", T.LongType())]) if last else carried.schema
        carried = carried.groupBy("bundle", "block").cogroup(mine.groupBy("bundle", "block")).applyInArrow(
            _stage(stage, last, (n_docs, n_terms), p), out)
    order = Window.partitionBy("item_id", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return carried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.k).select(
        "item_id", "rank", "doc_id", "score")
