"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 hashes of all
word shingles.  Two fingerprints with at most ``max_bits`` differing bits must
agree in at least ``blocks - max_bits`` of ``blocks`` blocks, so every choice of
that many blocks is a key, and a close pair meets under one of them at least.
More blocks give longer keys: the number is picked so that unrelated fingerprints
seldom meet, and the result is the same for each.

A bucket (fingerprints under one key) is cut into chunks and each pair of chunks
is a tile, so a bucket of any size is spread over tasks.  A tile verifies Hamming
distances in numpy and gives back a spanning forest of its links, not the links:
at most one row per fingerprint.  Min-label propagation over these edges yields
the components.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import append_column, check_new, extended, fresh, join_hot, land, text_bytes

SEED = 42
BITS = 64
TILE_ROWS = 1024


# -- fingerprints ----------------------------------------------------------------------------------


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each ``words``-word shingle, repeats included.

    A-Z become lower case; a word is a run of bytes other than space and \\t..\\r.
    With fewer words the whole sequence is the only shingle; with none there is none.
    """
    tokens = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)] if tokens else [], np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = [0, *ends[:len(tokens) - words].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)),
                       np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if set in over half of ``hashes``; 0 without any."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", words: int = 4) -> DataFrame:
    """``docs`` with its SimHash as a long (the 64 bits, signed) in the column ``name``, which it must not have.

    A null text has no words: 0.
    """
    check_new(docs, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t, words)) for t in text_bytes(batch.column(at))]
            yield append_column(batch, name, pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64()))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, extended(docs.schema, name, T.LongType()))


# -- candidate buckets -----------------------------------------------------------------------------


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """A mask for each choice of ``blocks - max_bits`` of ``blocks`` bit ranges."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    ranges = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(ranges, blocks - max_bits)]


def pick_blocks(prints: int, max_bits: int) -> int:
    """The fewest blocks whose shortest key leaves under 1/4 unrelated fingerprint per bucket on average.

    The number of keys per fingerprint is comb(blocks, max_bits); 200 at most.
    """
    blocks = max_bits + 1
    while comb(blocks + 1, max_bits) <= 200 and 4 * prints > 1 << (BITS * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def _forest(nodes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``nodes`` (uint64).

    Breadth first: a fingerprint that is reached leaves the rest, so each is compared
    once with what is left, and no list of pairs is held.
    """
    left = np.arange(len(nodes))
    source: list[np.ndarray] = []
    target: list[np.ndarray] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(nodes[left] ^ nodes[at]) <= max_bits
            if near.any():
                found = left[near]
                source.append(np.full(len(found), nodes[at]))
                target.append(nodes[found])
                queue.extend(found.tolist())
                left = left[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(source), np.concatenate(target)) if source else (none, none)


def _verify_tiles(rows: np.ndarray, max_bits: int, small: int = 16) -> pa.RecordBatch:
    """Edges of sorted tiles (m, key, i, j, fingerprint by row); small ones are compared all at once by lag."""
    bits = rows[4].view(np.uint64)
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    ends = np.repeat(starts + sizes, sizes)
    little = np.flatnonzero(np.repeat(sizes <= small, sizes))
    out = []
    for lag in range(1, small):
        little = little[little + lag < ends[little]]
        near = little[np.bitwise_count(bits[little] ^ bits[little + lag]) <= max_bits]
        out.append((bits[near], bits[near + lag]))
    for at, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        out.append(_forest(bits[at:at + n], max_bits))
    a, b = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(prints: DataFrame, max_bits: int = 4, blocks: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints linked by ``max_bits`` or fewer bits.

    ``prints`` is a written table of distinct longs ``fingerprint``.  The edges are
    true links and span the same components as all links; not every link is a row.
    """
    blocks = blocks or pick_blocks(prints.count(), max_bits)
    masks = block_masks(blocks, max_bits)
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    if max_bits >= BITS:
        raise ValueError("max_bits must be below 64")
    keyed = prints.select("fingerprint", F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("m", "mask")).select(
        "fingerprint", "m", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keyed.groupBy("m", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keyed.join(sizes, ["m", "key"]).withColumn(
        "chunks", F.ceil(F.col("n") / F.lit(tile_rows)).cast("int"))
    # each pair of chunks is one tile; where there is one chunk, so is its tile
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    tiles = met.withColumn("x", mine).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where(
        (F.col("x") != F.col("y")) | (F.col("chunks") == 1)).select(
        "m", "key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "fingerprint")
    tile = ["m", "key", "i", "j"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles follow each other in sorted order; the last of a batch may go on in the next."""
        held: np.ndarray | None = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = np.flatnonzero((rows[:4] != rows[:4, -1:]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = rows[:, cut:]
            yield _verify_tiles(rows[:, :cut], max_bits)
        if held is not None:
            yield _verify_tiles(held, max_bits)

    return tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(verify, "a long, b long")


# -- components ------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes that have an edge.

    Alternating large-star and small-star steps, both as a grouped minimum joined
    back, until an iteration changes no edge.  Each iteration's edges are written out.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b") if not large else e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = both.join(low, "a")
        hung = near.where(F.col("b") > F.col("a")) if large else near.where(F.col("b") != F.col("m"))
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(low.where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                     F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")).alias("s")).first()

    # edges point from the larger node a to the smaller node b
    now = land(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "edges")
    seen = mark(now)
    while seen["n"]:
        now = land(star(star(now, True), False), "edges")
        before, seen = seen, mark(now)
        if seen == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b"), F.col("b")).distinct())


def classes(marked: DataFrame, max_bits: int = 4, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fingerprint, root): a class for each distinct ``fingerprint`` of the written table ``marked``."""
    prints = land(marked.select("fingerprint").distinct(), "prints")
    roots = components(links(prints, max_bits, tile_rows=tile_rows))
    return prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    max_bits: int = 4, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    ``fingerprint`` is a signed long, ``component_id`` the smallest id reachable over
    links of at most ``max_bits`` differing bits, itself included.  Null and wordless
    texts have fingerprint 0 and are linked like any other.  A null id is no smallest
    id unless its component has no other.  Repeated rows stay.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = land(with_fingerprint(rows, "text", "fingerprint", words).drop("text"), "fingerprints")
    found = land(classes(marked, max_bits, tile_rows), "classes")
    low = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("low"))
    least = found.join(low, "fingerprint").groupBy("root").agg(F.min("low").alias("component_id"))
    # one class may hold much of the fingerprints, and one fingerprint much of the rows
    named = land(join_hot(found, least, "root").select("fingerprint", "component_id"), "named")
    return join_hot(marked, named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_fingerprint(bits: str) -> F.Column:
    """A signed long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                       max_bits: int = 4) -> DataFrame:
    """The row of each component with the smallest id, all its columns as they are.

    Of rows that share that id, or of a component that has null ids only, one stays.
    """
    taken = docs.columns
    bits, row = fresh("fingerprint", taken), fresh("row_number", taken)
    # numbered once and written, so that the numbers hold for every later read
    marked = land(with_fingerprint(docs, text_col, bits, words).withColumn(row, F.monotonically_increasing_id()), "marked")
    slim = marked.select(F.col(id_col).alias("doc_id"), F.col(bits).alias("fingerprint"), F.col(row).alias("row"))
    low = slim.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("low"))
    kept = classes(slim, max_bits).join(low, "fingerprint").groupBy("root").agg(F.min("low").alias("low")).select(
        F.col("low.row").alias(row))
    return marked.join(kept, row, "left_semi").select(*taken)
