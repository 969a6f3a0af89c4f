import math
import re
from collections import Counter

from pitlane.llm import lexical as X
from tests.llm.helpers import docs as docs_frame

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """Plain version: {(item, text): [(doc, score), ...]} over (id, text) rows."""
    terms = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n_docs, n_terms = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = {}
    for item in dict.fromkeys(i for i in items if i[1] is not None):
        scored = []
        for d, c in terms:
            m = 25 + 75 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in split(item[1]) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        if scored:
            out[item] = [(None if none else d, -s) for s, none, d in sorted(scored)[:k]]
    return out


TEXTS = (["the Cat sat", "the cat sat on THE mat", "", None, "  \t\n!?", "Été été naïve", "the"] + ["the dog ran"] * 40
         + [f"the word{i % 7} and word{i % 3} a1-b2_c3" for i in range(30)] + ["中文 text　here", "the " * 3000 + "needle"])
ITEMS = [(1, "the cat"), (2, "THE dog dog"), (3, "été"), (4, None), (5, ""), (6, "nothing of this"), (7, "word1 word2 A1 the"),
         (8, "needle 中文"), (1, "the cat"), (9, "中文 the"), (None, "mat"), (2, "mat cat")]


def run(spark, docs, items, **kw):
    frame = spark.createDataFrame([(i, t, None, 7) for i, t in items], "item_id long, text string, rank string, item long")
    got = {}
    for r in sorted(X.search(docs, frame, X.SearchParams(**kw)).collect(), key=lambda r: r.rank):
        got.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    return got


def by_id(want):
    """Ranked lists by item id; an id with several texts has one list for each."""
    out = {}
    for (item, _), ranked in want.items():
        out.setdefault(item, []).extend((i + 1, d, s) for i, (d, s) in enumerate(ranked))
    return {k: sorted(v, key=repr) for k, v in out.items()}


def test_matches_plain_for_any_layout(spark):
    docs = docs_frame(spark, TEXTS).union(docs_frame(spark, ["the cat sat"], 0).selectExpr(
        "CAST(NULL AS LONG)", "text", "lang", "source", "n_chars", "score", "fingerprint", "row_number"))
    want = by_id(plain([*enumerate(TEXTS), (None, "the cat sat")], ITEMS))
    for kw in ({}, {"block_docs": 3, "bundle_items": 2}, {"most_common": 2, "block_tokens": 10}, {"shares": (0.2,), "filter_bits": 64}):
        got = {k: sorted(v, key=repr) for k, v in run(spark, docs, ITEMS, **kw).items()}
        assert got == want, kw


def test_fewer_matches_than_k_and_ties(spark):
    got = run(spark, docs_frame(spark, ["b a", "a b", "c", "a b"]), [(1, "a"), (2, "c")], k=2)
    assert [d for _, d, _ in got[1]] == [0, 1] and len({s for _, _, s in got[1]}) == 1
    assert [(r, d) for r, d, _ in got[2]] == [(1, 2)]


def test_empty_tables(spark):
    assert run(spark, docs_frame(spark, []), ITEMS) == {}
    assert run(spark, docs_frame(spark, ["", None]), ITEMS) == {}
    assert run(spark, docs_frame(spark, TEXTS[:3]), []) == {}


def test_terms():
    assert X.terms_of("A-b_C Été　x 9\x00z".encode()) == [t.encode() for t in ["a", "b", "c", "Été　x", "9", "z"]]
    assert X.terms_of(b"") == []
