"""Vector best-fit packing of documents into training sequences.

A piece takes three resources of a sequence: tokens, one of the document places,
and attention cost (the square of its length).  Pieces are taken from large to
small; each goes to the open sequence that can hold it under every capacity and
is best by the weighted dot product of demand and residual, or by the smallest
weighted norm of what would be left; a new sequence is opened if none can.

Pieces are dealt by hash over shards of bounded tokens and pieces, and each shard
is packed by itself.  A second round gathers the pieces of badly filled sequences
of all shards and packs those again.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import land, per_worker

# -- tokens ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """``json`` is a `tokenizers` file.  ``ranks``, if given, is the same vocabulary as a rank file.

    With it, texts of common Latin characters are encoded by `tiktoken`, which
    yields the same ids in a quarter of the time; all others by `tokenizers`.
    """

    json: str
    ranks: str | None = None
    pattern: str | None = None

    def encoder(self):
        """A function from texts to id lists, without special tokens of its own."""
        def build():
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(self.json)
            of_slow = lambda texts: [x.ids for x in slow.encode_batch(texts, add_special_tokens=False)]
            if not self.ranks:
                return of_slow
            import tiktoken

            with open(self.ranks, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            # where both libraries' character classes are known to agree and no special token is spelt out
            odd = re.compile("[^\\t\\n\\r -~\\u00a1-\\u024f]|<\\|").search

            def run(texts: list[str]) -> list[list[int]]:
                out = [None if odd(t) else fast.encode_ordinary(t) for t in texts]
                rest = [i for i, x in enumerate(out) if x is None]
                for i, ids in zip(rest, of_slow([texts[i] for i in rest]) if rest else [], strict=True):
                    out[i] = ids
                return out

            return run

        return per_worker(f"vocabulary {self.json} {self.ranks}", build)


def public_vocabulary() -> Vocabulary:
    """The 50k byte-level vocabulary of the installed public files."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


def cut_points(n: int, most: int) -> list[int]:
    """Where the pieces of ``n`` tokens start: all have ``most`` tokens, but the first may be shorter."""
    return [0, *range(n % most or most, n, most)]


def pieces(docs: DataFrame, vocabulary: Vocabulary, max_tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) per piece of each document.

    A document is its ids and then ``end_id``; a null text is an empty one, so every
    row has at least one piece.  Repeated rows each have their own.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                names = batch.column(0)[at:at + 256].to_pylist()
                texts = [t or "" for t in batch.column(1)[at:at + 256].to_pylist()]
                rows = []
                for name, ids in zip(names, encode(texts), strict=True):
                    flat = np.array([*ids, end_id], "<u4")
                    starts = cut_points(len(flat), max_tokens)
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(flat)], strict=True)):
                        rows.append((name, i, a, b - a, zlib.crc32(flat[a:b].tobytes()), flat[a:b].astype(np.int32)))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][:5 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, fields)


# -- packing ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PackParams:
    """Capacities of a sequence, how bins are chosen, and how large a shard may be.

    ``weights`` are for tokens, documents and attention.  ``rule`` is 'norm' (smallest
    weighted residual norm) or 'dot' (largest weighted dot product).  A sequence with
    more than ``loose`` of its tokens free is packed again in the second round.
    """

    max_tokens: int = 2048
    max_docs: int = 2048
    max_attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"
    shard_tokens: int = 1 << 20
    shard_pieces: int = 20_000
    loose: float = 0.01

    def piece_tokens(self) -> int:
        """The longest piece that fits alone."""
        return max(1, min(self.max_tokens, math.isqrt(self.max_attention)))


def best_fit(lengths: np.ndarray, p: PackParams) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; bins are numbered in the order they are opened."""
    n = len(lengths)
    capacity = np.array([p.max_tokens, p.max_docs, p.max_attention], np.float64)
    weights = np.array(p.weights)
    demand = np.stack([lengths, np.ones(n), np.square(lengths.astype(np.float64))])
    left = np.empty((3, n))  # residual capacities of the open bins, by column
    name = np.empty(n, np.int64)  # their numbers
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    open_bins = made = 0
    least = lengths.min() if n else 0
    share = (weights / capacity**2)[:, None]
    for i in np.argsort(-lengths, kind="stable"):
        need = demand[:, i:i + 1]
        room = left[:, :open_bins]
        fits = np.flatnonzero((room >= need).all(axis=0))
        if len(fits):
            held = room[:, fits]
            score = -(share * (held - need) ** 2).sum(axis=0) if p.rule == "norm" else (share * held * need).sum(axis=0)
            at = fits[np.argmax(score)]
        else:
            at, left[:, open_bins], name[open_bins] = open_bins, capacity, made
            open_bins, made = open_bins + 1, made + 1
        bins[i], offsets[i] = name[at], p.max_tokens - left[0, at]
        left[:, at] -= demand[:, i]
        if left[0, at] < least or left[1, at] < 1:  # full: the last open bin takes its place
            open_bins -= 1
            left[:, at], name[at] = left[:, open_bins], name[open_bins]
    return bins, offsets


def _round(rows: DataFrame, p: PackParams, at: int) -> DataFrame:
    """Deal ``rows`` over shards and pack each; adds sequence_id, offset and filled."""
    total = rows.agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("pieces")).first()
    shards = max(1, -(-(total["tokens"] or 0) // p.shard_tokens), -(-total["pieces"] // p.shard_pieces))

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        bins, offsets = best_fit(shard["length"].to_numpy(np.int64), p)
        filled = np.bincount(bins, shard["length"].to_numpy(np.float64)).astype(np.int64)
        return shard.drop(columns=["_shard"]).assign(
            sequence_id=(bins * shards + shard["_shard"].to_numpy()) * 2 + at, offset=offsets, filled=filled[bins])

    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.groupBy("_shard").applyInPandas(pack, f"{fields}, sequence_id long, offset long, filled long")


def pack(found: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """The rows of ``found`` (with a column ``length``) with sequence_id and offset.

    No piece may be longer than ``params.piece_tokens()``.  Offsets have no gaps and
    start from 0.  Pieces that fill a sequence alone have it alone.
    """
    rows = land(found.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = rows.where(F.col("length") == params.max_tokens).withColumns(
        {"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("long")})
    first = land(_round(rows.where(F.col("length") < params.max_tokens), params, 0), "packed")
    tight = F.col("filled") >= params.max_tokens * (1 - params.loose)
    again = _round(first.where(~tight).drop("sequence_id", "offset", "filled"), params, 1)
    return first.where(tight).drop("filled").unionByName(again.drop("filled")).unionByName(whole).drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) from packed rows that kept their ``ids``: at most a sequence's tokens each."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, params: PackParams = PackParams(), id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: the columns of ``pieces`` with sequence_id and offset."""
    return pack(pieces(docs, vocabulary, params.piece_tokens(), 0, id_col, text_col, with_ids), params)
