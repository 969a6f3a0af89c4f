import random
from dataclasses import replace

import numpy as np

from pitlane.llm import lm as L
from pitlane.llm.common import land
from tests.llm.helpers import docs

P = replace(L.LmParams(), classes=4, class_size=8, buckets=8, stride=2, batch=256)


def plain_score(model, text):
    """Token by token, softmax over all tokens written out."""
    p, net = model.params, L.Network(model.params, model.flat)
    ids = L.Tokens(model.words, p).ids(text)
    total = 0.0
    for i, t in enumerate(ids):
        context = [ids[j] if 0 <= j < len(ids) else p.size for j in range(i - p.window, i + p.window + 1) if j != i]
        h = np.tanh(np.concatenate([net.embed[c] for c in context]) @ net.w1 + net.b1)
        every = []
        zc = np.exp(h @ net.wc + net.bc)
        for c in range(p.classes):
            zw = np.exp(h @ net.ww[c] + net.bw[c])
            every.extend(zc[c] / zc.sum() * zw / zw.sum())
        assert abs(sum(every) - 1) < 1e-4
        total += np.log(every[t])
    return total


def test_gradient_matches_differences():
    net, rng = L.Network(P), np.random.default_rng(0)
    context, target = rng.integers(0, P.size + 1, (9, 4)), rng.integers(0, P.size, 9)
    g = net.gradient(context, target)
    loss = lambda flat: -L.Network(P, flat).log_probs(context, target).astype(np.float64).mean()
    for i in rng.choice(len(g), 60):
        up, down = net.flat.copy(), net.flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[i]) < 1e-3


def test_scores_match_plain_and_order_matters(spark):
    rng = random.Random(1)
    grammar = {"a": "b", "b": "c", "c": "d", "d": "a"}

    def text(n):
        w = [rng.choice("abcd")]
        for _ in range(n):
            w.append(grammar[w[-1]])
        return " ".join(w)

    texts = [text(rng.randint(1, 60)) for _ in range(300)]
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts[:40]]
    extra = [None, "", " \n ", "one", "Unseen words here", "a b " * 40_000]
    df = docs(spark, texts + extra)
    words = L.frequent_words(df, P)
    assert words[:4] == sorted(words[:4], key=lambda w: words.index(w)) and set("abcd") <= set(words)
    encoded = land(L.encode(df.repartition(6), words, P), "encoded")
    model = L.fit(encoded, words, replace(P, rounds=3))
    got = {r.doc_id: r for r in L.score(encoded, model).collect()}
    assert len(got) == len(texts) + len(extra)
    for i in [0, 7, 33, 303, 304]:
        t = (texts + extra)[i]
        assert abs(got[i].log_prob - plain_score(model, t)) < 1e-2 and got[i].n_tokens == len(t.split())
    for i in (300, 301, 302):
        assert got[i].log_prob == 0 and got[i].n_tokens == 0 and got[i].mean_log_prob is None
    other = {r.doc_id: r for r in L.score(L.encode(docs(spark, shuffled), words, P), model).collect()}
    long = [i for i in range(40) if got[i].n_tokens > 15]
    assert all(got[i].mean_log_prob > other[i].mean_log_prob for i in long)


def test_averaging_is_weighted_and_covers_every_partition(spark):
    df = docs(spark, [f"a b c {i}" for i in range(64)]).repartition(10)
    words = L.frequent_words(df, P)
    encoded = land(L.encode(df, words, P), "encoded")
    a = L.fit(encoded, words, replace(P, rounds=1, fan_in=2))
    b = L.fit(encoded, words, replace(P, rounds=1, fan_in=64))
    assert np.allclose(a.flat, b.flat, atol=1e-5)


def test_empty(spark):
    assert L.train_and_score(docs(spark, []), P).count() == 0
    assert L.train_and_score(docs(spark, [None, ""]), P).count() == 2


def test_words_out_of_the_list_have_their_own_probability(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(9)]) for _ in range(60)) + " rare" * (i < 9) + f" once{i}" for i in range(150)]
    df = docs(spark, [*texts, "rare", "once3", None])
    small = replace(P, buckets=1, classes=1, class_size=6)
    counts = land(L.word_counts(df), "words")
    words, p = L.vocabulary(counts, small)
    n = {r.word: r.n for r in counts.collect()}
    least = sum(n.values()) ** 0.5
    assert small.size - small.buckets < len(words) <= p.size - p.buckets and set(words) == {w for w in n if n[w] >= least}
    shares = {r.word: r.share for r in L.bucket_shares(counts, words, p).collect()}
    assert set(shares) == set(n) - set(words)
    encoded = land(L.encode(df, words, p), "encoded")
    model = L.fit(encoded, words, p)
    tokens = L.Tokens(words, p)
    for b in range(p.buckets):  # the words of a bucket share all of it
        own = [s for w, s in shares.items() if tokens[w] == tokens.first + b]
        assert not own or abs(sum(np.exp(own)) - 1) < 1e-9
    got = {r.doc_id: r for r in L.score(encoded, model, land(L.bucket_shares(counts, words, p), "shares")).collect()}
    assert len(got) == len(texts) + 3 and got[152].log_prob == 0 and got[152].mean_log_prob is None
    for i in (0, 60, 150, 151):
        text = [*texts, "rare", "once3"][i]
        assert abs(got[i].log_prob - plain_score(model, text) - sum(shares.get(w, 0) for w in text.split())) < 1e-2
    whole = {r.doc_id: r.log_prob for r in L.train_and_score(df, small).collect()}
    assert abs(whole[60] - got[60].log_prob) < 1 and whole.keys() == got.keys()


def test_every_token_is_predicted_in_training(spark):
    for stride, rounds, n in ((8, 2, 29), (2, 3, 5), (8, 1, 3), (3, 3, 1), (1, 2, 4)):
        p = replace(P, stride=stride, rounds=rounds)
        assert set(np.concatenate([L.masked(n, p, k) for k in range(rounds)])) == set(range(n))
    p = replace(P, stride=8, rounds=2, rate=0.02)
    df = docs(spark, ["a b c d e f g h"] * 4000).repartition(1)
    words = L.frequent_words(df, p)
    encoded = land(L.encode(df, words, p), "encoded")
    assert L.score(encoded, L.fit(encoded, words, p)).first().mean_log_prob > -1  # places 2 to 7 of 8 were never targets
