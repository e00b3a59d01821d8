"""The topic sampler against plain Python, draw for draw."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.functions import draws
from rostrum.operators import gibbs
from rostrum.operators.parts import in_parts
from rostrum.plans.stage import stage

K, V, SEED, BETA = 4, 30, 7, 0.01
ALPHA = [0.5, 1.0, 0.25, 2.0]


def documents():
    rng = np.random.RandomState(3)
    docs = {}
    for d in range(40):
        terms = rng.randint(0, 10, 12) + 10 * (d % 3)
        docs[1000 - 7 * d] = collections.Counter(terms.tolist())
    docs[-5] = collections.Counter({2: 60, 29: 1})
    docs[5] = collections.Counter({0: 1})
    return docs


@pytest.fixture(scope="module")
def counts(spark):
    rows = [(d, t, c) for d, terms in documents().items() for t, c in terms.items()]
    return spark.createDataFrame(rows, "doc_id long, term_id long, cnt long").repartition(5)


def number(seed, step, doc, place):
    """The hash in Python's own integers."""
    m = (1 << 64) - 1
    x = (seed * 0xD1342543DE82EF95 + step * 0xAF251AF3B0F025B5 + 0x9E3779B97F4A7C15) & m
    x = (x + doc * 0x2545F4914F6CDD1D + place * 0x9E3779B97F4A7C15) & m
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & m
    return ((x ^ (x >> 31)) >> 11) * 2.0 ** -53


def plain(docs, passes):
    tokens = {d: [t for t in sorted(c) for _ in range(c[t])] for d, c in docs.items()}
    topics = {d: [int(number(SEED, 0, d, i) * K) for i in range(len(w))] for d, w in tokens.items()}
    for p in range(1, passes + 1):
        n_wk, n_k = collections.Counter(), collections.Counter()
        for d, w in tokens.items():
            for t, z in zip(w, topics[d]):
                n_wk[t, z] += 1
                n_k[z] += 1
        for d, w in tokens.items():
            own, own_w, own_k = collections.Counter(topics[d]), collections.Counter(), collections.Counter()
            for i, t in enumerate(w):
                z = topics[d][i]
                own[z] -= 1
                own_w[t, z] -= 1
                own_k[z] -= 1
                upto, total = [], 0.0
                for k in range(K):
                    total += (own[k] + ALPHA[k]) * (n_wk[t, k] + own_w[t, k] + BETA) / (n_k[k] + own_k[k] + V * BETA)
                    upto.append(total)
                u = number(SEED, p, d, i) * total
                z = next((k for k in range(K) if upto[k] > u), K - 1)
                topics[d][i] = z
                own[z] += 1
                own_w[t, z] += 1
                own_k[z] += 1
    return tokens, topics


def run(counts, passes, part_cells=1_000_000):
    parts = in_parts(counts, part_cells)
    state = stage(gibbs.start(parts, K, SEED), "s")
    table = stage(gibbs.count_tokens(state), "c")
    for p in range(1, passes + 1):
        state = stage(gibbs.one_pass(parts, state, table, gibbs._totals(table, K), ALPHA, BETA, V, SEED, p, True), "s")
        table = stage(gibbs.apply_changes(table, state), "c")
    return state, table


@pytest.mark.parametrize("part_cells", [1_000_000, 20])
def test_draw_for_draw(counts, part_cells):
    tokens, topics = plain(documents(), 2)
    state, table = run(counts, 2, part_cells)
    got = {r.doc_id: (r.terms, r.topics) for r in state.filter("kind = 0").collect()}
    assert got == {d: (tokens[d], topics[d]) for d in tokens}
    want = collections.Counter((t, z) for d in tokens for t, z in zip(tokens[d], topics[d]))
    assert {(r.term_id, r.topic): r.n for r in table.collect()} == dict(want)
    sizes = collections.Counter((z, c) for d in topics for z, c in collections.Counter(topics[d]).items())
    sizes.update((K, len(topics[d])) for d in topics)
    hist = gibbs._listed(state, 2).groupBy("topics", "terms").agg(F.sum("n").alias("n")).collect()
    assert {(r.topics, r.terms): r.n for r in hist} == dict(sizes)


def test_slices_do_not_matter(counts):
    rng = np.random.RandomState(1)
    sizes = np.array([5, 0, 17, 3, 9])
    terms = np.concatenate([np.sort(rng.randint(0, 6, n)) for n in sizes])
    topics, n_wk = rng.randint(0, K, len(terms)), rng.randint(5, 50, (6, K))
    args = (terms, topics, sizes, np.array([3, 9, -1, 4, 8]), n_wk, n_wk.sum(0), np.array(ALPHA), BETA, 6, 1, 1)
    a, b = draws.sweep(*args), draws.sweep(*args, cells=K)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and (a[1].sum(axis=1) == sizes).all()


def test_prior_and_planted_topics(spark, counts):
    digamma = lambda x: sum(-1 / (x + i) for i in range(200_000))  # noqa: E731  (differences only)
    hist = [(0, 3, 2), (0, 1, 4), (1, 5, 1), (2, 3, 3), (2, 6, 1)]
    got = gibbs.fit_prior([0.5, 1.5], spark.createDataFrame(hist, "topic int, size int, docs long"), 1)
    up = [sum(n * (digamma(s + a) - digamma(a)) for t, s, n in hist if t == k) for k, a in ((0, 0.5), (1, 1.5), (2, 2.0))]
    assert np.allclose(got, [0.5 * up[0] / up[2], 1.5 * up[1] / up[2]], rtol=1e-4)
    rules = gibbs.Sampler(num_topics=3, alpha=1.0, passes=30, burn_in=10, optimize_every=10)
    found = gibbs.fit(counts, V, rules, seed=3)
    weights = found.topic_weights().collect()
    sums = collections.Counter()
    for r in weights:
        sums[r.topic_id] += r.weight
    assert len(weights) == 3 * V and all(abs(x - 1) < 1e-9 for x in sums.values())
    # the three planted vocabularies come out as the three topics
    best = {t: {r.term_id // 10 for r in sorted((r for r in weights if r.topic_id == t), key=lambda r: -r.weight)[:8]} for t in range(3)}
    assert sorted(tuple(x) for x in best.values()) == [(0,), (1,), (2,)]
    assert found.alpha != [1 / 3] * 3
    theta = {r.doc_id: r.theta for r in found.doc_topics().collect()}
    assert len(theta) == 42 and all(abs(sum(x) - 1) < 1e-9 for x in theta.values())
    assert sum(max(x) > 0.8 for x in theta.values()) >= 40  # a document's words come from one vocabulary


def test_empty(spark, counts):
    found = gibbs.fit(counts.limit(0), V, gibbs.Sampler(num_topics=2, passes=1), seed=1)
    assert found.counts.count() == 0 and found.doc_topics().count() == 0 and found.topic_weights().count() == 2 * V
