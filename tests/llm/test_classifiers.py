import random
import zlib
from dataclasses import replace

import numpy as np
import pytest

from pitlane.llm import quality as Q
from pitlane.llm import toxicity as X
from pitlane.llm.common import NgramPresence
from tests.llm.helpers import docs

SYLLABLES = ["ra", "ti", "no", "ve", "lu", "ke", "so", "mi", "da", "pe"]


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def corpus(n, seed):
    """Texts, toxic flags (an insult somewhere) and quality flags (no junk signs or repeats)."""
    rng = random.Random(seed)
    texts, toxic, good = [], [], []
    for _ in range(n):
        words = prose(rng, rng.randint(5, 120)).split()
        bad, junk = rng.random() < 0.2, rng.random() < 0.3
        if junk:
            words = [w + "###" for w in words] if rng.random() < 0.5 else [words[0]] * len(words)
        if bad:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["zxqword", "wyxfool", "gqhscum"]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
        good.append(int(not junk))
    return texts, toxic, good


def training(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


@pytest.fixture(scope="module")
def labelled(spark):
    texts, toxic, good = corpus(2400, 1)
    texts += [None, "", "   ", "w" * 400_000]
    df = docs(spark, texts).union(docs(spark, texts[:1])).cache()
    rows = [(i, good[i], toxic[i], "c") for i in range(2400) if i % 3]
    rows += [(0, None, None, "c"), (None, 1, 1, "c"), (1, 7, 9, "c"), (99999, 1, 1, "c")]
    rows += [(2, 1 - good[2], 1 - toxic[2], "c")]  # an id with both labels
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int, y string").cache()
    return df, labels, toxic, good


def plain_ngrams(text, orders):
    data = b" " + b" ".join(text.lower().encode().split()) + b" "
    return {data[i:i + n] for n in orders for i in range(len(data) - n + 1)}


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_presence_counts_each_ngram_once(size):
    grams = NgramPresence((2, 3), 24, slice_bytes=size)
    for text in ("", "a", "The  the\ncat", "Ünï code " * 40):
        assert len(grams(text.encode())) == len(plain_ngrams(text, (2, 3)))  # no collision at 24 bits here
    assert (grams(b"abc abc") == NgramPresence((2, 3), 24)(b"abc abc")).all()
    with_runs = NgramPresence((2, 3), 24, repeats=True)
    assert len(with_runs(b"a a a a")) > len(grams(b"a a a a"))


def test_toxicity_on_held_out(labelled):
    df, labels, toxic, _ = labelled
    model = X.train(df, labels)
    got = X.score(df, model, name="score_").collect()
    assert len(got) == 2405
    held = [(r.score_ >= 0.5, toxic[r.doc_id]) for r in got if r.doc_id < 2400 and (r.doc_id % 3 == 0 or not training(r.doc_id))]
    assert np.mean([p for p, t in held if t]) > 0.9
    assert np.mean([p for p, t in held if not t]) < 0.03
    assert all(0 <= r.score_ <= 1 for r in got)
    kept = X.keep_clean(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.score_ < 0.5 for r in got)


def test_quality_on_held_out(labelled):
    df, labels, _, good = labelled
    model = Q.train(df, labels)
    got = Q.score(df, model, name="score_").collect()
    held = [(r.score_ >= 0.3, good[r.doc_id]) for r in got if r.doc_id < 2400 and (r.doc_id % 3 == 0 or not training(r.doc_id))]
    assert np.mean([p for p, t in held if t]) > 0.97
    assert np.mean([p for p, t in held if not t]) < 0.1
    assert Q.keep_good(df, labels).count() == sum(r.score_ >= 0.3 for r in got)


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(labelled, spark):
    df, labels, _, _ = labelled
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) quality",
                                "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic", "y")
    for a, b in ((Q.train(df, labels), Q.train(df, flipped)), (X.train(df, labels), X.train(df, flipped))):
        assert (a.weights == b.weights).all() and a.bias == b.bias


def test_no_labels_one_class_and_no_documents(labelled, spark):
    df, labels, _, _ = labelled
    none = labels.limit(0)
    assert {round(r.s, 6) for r in X.score(df, X.train(df, none), name="s").collect()} == {0.5}
    assert {round(r.s, 6) for r in Q.score(df, Q.train(df, none), name="s").collect()} == {0.5}
    only = labels.where("quality = 1").selectExpr("doc_id", "quality", "0 toxic")
    assert len({r.s for r in Q.score(df, Q.train(df, only), name="s").collect()}) == 1
    assert X.keep_clean(df, only).count() == 2405
    empty = df.limit(0)
    assert X.keep_clean(empty, labels).count() == 0 and Q.keep_good(empty, labels).count() == 0


def test_sample_bounds_hold(labelled):
    df, labels, toxic, _ = labelled
    small = replace(X.ToxicityParams(), max_positive=20, max_unlabelled=50, least_apart=0.0)
    assert X.train(df, labels, small).weights.any()
    assert Q.train(df, labels, replace(Q.QualityParams(), max_fit=60, max_calibrate=20)).weights.any()


def test_counts_and_margins_of_the_whole_corpus_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(0, 30)) for _ in range(300)] + [None, "", "ra ti"]
    p = replace(X.ToxicityParams(), bits=12, bins=8, widest=1.0)
    grams = p.grams()
    rows = [grams((t or "").encode()) for t in texts]
    counts, n = X.corpus_counts(docs(spark, texts).repartition(5), "text", grams)
    assert n == 303 and (counts == X.gram_counts(rows, 1 << 12)).all()
    models = [X.LinearModel(np.random.default_rng(k).normal(size=1 << 12), np.ones(1 << 12, bool), 0.1 * k) for k in range(3)]
    folded = docs(spark, texts).selectExpr("text", "pmod(doc_id, 3) as fold").repartition(4)
    bins, n = X.margin_histogram(folded, "text", "fold", models, p)
    want = np.unique(np.floor(np.clip([models[i % 3].margin(x) for i, x in enumerate(rows)], -1, 1) * 8), return_counts=True)
    order = np.argsort(bins)
    assert bins[order].tolist() == want[0].tolist() and n[order].tolist() == want[1].tolist()
    assert X.corpus_counts(docs(spark, texts).limit(0), "text", grams)[1] == 0


def test_a_source_outside_the_sample_moves_features_and_cut(spark):
    """Clean documents that share a phrase with the toxic ones: none is in the sample, yet the phrase stops counting."""
    rng = random.Random(5)
    toxic = ["zxqword greetings " + prose(rng, 20) for _ in range(60)]
    plain = [prose(rng, 20) for _ in range(400)]
    rare = ["greetings " + prose(rng, 20) for _ in range(6000)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(260)], "doc_id long, toxic int")
    p = replace(X.ToxicityParams(), max_unlabelled=120)
    few, all_ = (X.train(docs(spark, toxic + plain + more), labels, p) for more in ([], rare))
    gram = p.grams()
    apart = lambda m: m.margin(gram(b"greetings")) - m.margin(gram(b""))
    assert apart(few) > 0.5 and apart(all_) < 0.5 * apart(few)
    got = X.score(docs(spark, toxic + plain + rare), all_, name="s").where("s >= 0.5").select("doc_id").toPandas().doc_id
    assert (got < 60).sum() >= 55 and (got >= 60).sum() < 60


def test_weighted_cut_equals_repeated_margins():
    rng = np.random.default_rng(2)
    for _ in range(50):
        pos, unl, n = rng.integers(0, 20, 15) / 4, rng.integers(-20, 15, 30) / 4, rng.integers(1, 5, 30)
        assert X.pick_cut(pos, unl, 0.2, n.astype(float)) == pytest.approx(X.pick_cut(pos, np.repeat(unl, n), 0.2))


def test_nnpu_gradient_sign_and_cut():
    assert X.pick_cut(np.array([2.0, 3.0]), np.array([-1.0, 0.0, -2.0, 2.5]), 0.25) == pytest.approx(1.0)
    p = replace(X.ToxicityParams(), bits=8, least_apart=0.0)
    pos = [np.array([1, 5]), np.array([1, 6])] * 20
    unl = [np.array([2, 5]), np.array([3, 6]), np.array([2, 6]), np.array([1, 5])] * 20
    m = X.fit_nnpu(pos, unl, 0.25, p)
    assert m.margin(np.array([1, 5])) > m.margin(np.array([2, 5]))


def test_dual_coordinate_descent_reaches_the_optimum():
    """The primal objective is no better at nearby weights, and dual and primal agree."""
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(60)]
    y = np.array([1 if 0 in r or rng.random() < 0.2 else 0 for r in rows])
    ratio = rng.normal(size=12)
    w, b = Q.dual_coordinate_descent(rows, y, ratio, 1.0, 4000, 1)
    v = np.divide(w, ratio)

    def primal(v, b):
        margin = np.array([(v[r] * ratio[r]).sum() / np.sqrt(5) + b for r in rows])
        return 0.5 * (v @ v + b * b) + np.maximum(0, 1 - np.where(y > 0, 1, -1) * margin).sum()

    best = primal(v, b)
    for _ in range(200):
        assert primal(v + rng.normal(0, 0.05, 12), b + rng.normal(0, 0.05)) >= best - 1e-3


def test_log_count_ratio_by_hand():
    counts = Q.class_counts([np.array([0, 1]), np.array([1]), np.array([2])], np.array([1, 0, 0]), 2)
    assert counts.tolist() == [[0, 1, 1, 0], [1, 1, 0, 0]]
    r = Q.log_count_ratio(counts, 1.0)
    assert r[0] == pytest.approx(np.log((2 / 6) / (1 / 6))) and r[1] == pytest.approx(0.0)
