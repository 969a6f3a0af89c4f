import itertools
import random

import numpy as np
import pytest

from pitlane.llm import decontam as D
from tests.llm.helpers import docs

WORDS = [f"w{i}" for i in range(4000)]
HAN = "我们今天在公园里看到了很多漂亮的花和树木"


def hit(mask, gone, n):
    return any(all(m == "0" or not gone >> (o + k) & 1 for k, m in enumerate(mask)) for o in range(n - len(mask) + 1))


@pytest.mark.parametrize("n", [10, 11, 12, 13, 15, 17, 19])
def test_masks_hit_every_pattern_of_a_fifth_substituted(n):
    for gone in itertools.combinations(range(n), n // 5):
        bits = sum(1 << g for g in gone)
        assert any(hit(m, bits, n) for m in D.MASKS)


def brute(texts, items):
    found = set()
    for d, t in texts:
        w = D.word_hashes((t or "").encode())
        for i, x in items:
            it = D.word_hashes((x or "").encode())
            if len(it) < 10:  # whole and word for word; everyday wording only by itself
                n, ends = len(it), range(len(w) - len(it) + 1)
                if n and (n >= 3 or len(w) == n) and any((w[s:s + n] == it).all() for s in ends):
                    found.add((d, i))
                continue
            if any(D.align(w, it, s, 13)[0] >= 0.8 for s in range(-len(it), len(w) + 1)):
                found.add((d, i))
    return found


def test_overlaps_match_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.choice([9, 10, 13, 19, 20, 45])))) for i in range(30)]
    items += [(30, None), (31, ""), (0, items[0][1]), (32, items[5][1].upper() + "!")]
    items += [(33, "Three short words"), (34, "w7"), (35, "w8 w9"), (36, HAN), (37, "ภาษาไทย"),
              (38, " ".join(WORDS[100:109]))]
    texts = []
    for d in range(160):
        body = rng.choices(WORDS, k=rng.choice([0, 5, 40, 300]))
        piece = rng.choice(items)[1] or ""
        words = piece.split()
        for k in rng.sample(range(len(words)), int(len(words) * rng.choice([0, 0.1, 0.2, 0.3]))) if words else []:
            words[k] = "zzz"
        lo = rng.choice([0, 0, 5, 9])
        at = rng.randrange(len(body) + 1)
        texts.append(" ".join(body[:at] + words[lo:] + body[at:]))
    texts += [None, "", items[3][1] * 2, "w" * 200_000, texts[0]]
    texts += ["these three short words, and more", "three short w1 words", "W7.", "w7 w7", "so w8 w9", "w8, w9", "早上" + HAN + "。",
              HAN[:9] + "也" + HAN[10:], HAN[:7], "พูดภาษาไทยได้", " ".join(WORDS[99:110]), " ".join(WORDS[100:108])]
    df = docs(spark, texts)
    items_df = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    got = D.overlaps(df, items_df).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(list(enumerate(texts)), items)
    assert all(r.similarity >= 0.8 for r in got)
    first = len(texts) - 12
    short = {(d - first, i) for d, i in ((r.doc_id, r.item_id) for r in got) if d >= first}
    assert short >= {(0, 33), (2, 34), (5, 35), (6, 36), (7, 36), (9, 37), (10, 38)} and not {d for d, _ in short} & {1, 3, 4, 8, 11}
    kept = {r.doc_id for r in D.keep_uncontaminated(df, items_df).collect()}
    assert kept == set(range(len(texts))) - {r.doc_id for r in got}


def test_null_ids_and_empty_tables(spark):
    item = " ".join(WORDS[:30])
    df = spark.createDataFrame([(None, item), (None, "clean"), (1, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.overlaps(df, items).collect()] == [(None, 7)]
    assert sorted(r.text or "" for r in D.keep_uncontaminated(df, items).collect()) == ["", "clean"]
    assert D.overlaps(df, items.limit(0)).count() == 0
    assert D.overlaps(df.limit(0), items).count() == 0
    assert D.keep_uncontaminated(df, items.limit(0)).count() == 3


def test_filter_has_no_false_negatives():
    h = np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64)
    bits = np.zeros(1 << 13, np.uint8)
    for x in h.tolist():
        for at in (x & 0xFFFF, x >> 32 & 0xFFFF):
            bits[at >> 3] |= 1 << (at & 7)
    assert len(D.passes(bits, h)) == len(h)
