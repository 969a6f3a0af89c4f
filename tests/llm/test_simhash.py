import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm import simhash as S
from pitlane.llm.common import land
from tests.llm.helpers import DOCS, docs


def plain_print(text, words=4):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints, bits):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return [min(groups[root(i)]) for i in range(len(ids))]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB \t\n\x0b\x1c Äİx", max_size=60))
def test_fingerprint_matches_plain(text):
    assert S.fingerprint(S.shingle_hashes(text.encode(), 4)) == plain_print(text)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.integers(5, 9))
def test_close_pairs_share_a_key(x, flips, blocks):
    y = x ^ sum(1 << f for f in flips)
    masks = S.block_masks(blocks, 4)
    assert any(x & m == y & m for m in masks)
    assert all(m.bit_count() >= 64 * (blocks - 4) // blocks - 4 for m in masks)


def test_links_and_components_match_brute_force(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, 1, 2**64 - 1}
    prints |= {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for _ in range(250)}  # a hot bucket
    chain = rng.getrandbits(64)
    for _ in range(30):  # a long chain of links
        for _ in range(4):
            chain ^= 1 << rng.randrange(64)
        prints.add(chain)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = land(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), "prints")
    for tile in (16, 1024):
        for blocks in (5, 6):
            found = {r.node: r.root for r in S.components(S.links(df, 4, blocks, tile)).collect()}
            want = plain_components(signed, prints, 4)
            assert [found.get(x, x) for x in signed] == want


def test_near_duplicates_and_keeping_one(spark):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [base, base + " tail", base.upper(), "other text of its own entirely", None, "", "  \n", "a b", "A\tB",
             " ".join(f"x{i}" for i in range(60_000)), base]
    df = docs(spark, texts).union(docs(spark, [base]))
    got = S.near_duplicates(df).collect()
    prints = [plain_print(t) for t in texts]
    want = dict(enumerate(plain_components(list(range(len(texts))), prints, 4)))
    assert len(got) == len(texts) + 1
    assert all(r.component_id == want[r.doc_id] and r.fingerprint % 2**64 == prints[r.doc_id] for r in got)
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "same words here now ok", *[None] * 6), (None, "same words here now ok", *[None] * 6),
                                (None, "quite another text it is", *[None] * 6)], DOCS)
    assert S.keep_one_per_group(df).count() == 2
    assert S.near_duplicates(df).where("component_id is null").count() == 3
    assert S.near_duplicates(df.limit(0)).count() == 0
    assert S.keep_one_per_group(df.limit(0)).count() == 0
