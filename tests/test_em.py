"""Expectation-maximisation by parts, against pyspark.ml and against itself on other partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import em, lda

TERMS = 30


@pytest.fixture(scope="module")
def counts(spark):
    """Two topics over thirty terms, the last of which occurs nowhere; one document has no id."""
    rng, rows = np.random.default_rng(1), []
    for doc in range(80):
        share = rng.beta(0.3, 0.3)
        words = np.where(rng.random(60) < share, rng.integers(0, 14, 60), rng.integers(14, TERMS - 1, 60))
        rows += [(doc or None, int(t), float(c)) for t, c in zip(*np.unique(words, return_counts=True))]
    return spark.createDataFrame(rows, "doc_id long, term_id int, cnt double").repartition(5)


def likelihood(counts, weights, theta):
    w, t = np.zeros((2, TERMS)), {r.doc_id: np.array(r.theta) for r in theta.collect()}
    for r in weights.collect():
        w[r.topic_id, r.term_id] = r.weight
    return sum(r.cnt * np.log(t[r.doc_id] @ w[:, r.term_id]) for r in counts.collect())


def test_likelihood_is_that_of_the_library(spark, counts):
    f = lda.vectors(counts, TERMS)
    model = lda.fit_em(f, 2, iterations=20, alpha=5.0, beta=0.01)
    fit = em.fit(counts, TERMS, 2, iterations=20, alpha=5.0, beta=0.01)
    ours, theirs = (likelihood(counts, *x) for x in ((fit.topic_weights(), fit.doc_topics(counts)), (lda.topic_weights(model, TERMS), lda.doc_topics(model, f))))
    assert ours > 1.01 * theirs  # both below zero
    total = counts.agg(F.sum("cnt")).first()[0]
    assert abs(sum(sum(r.lam) for r in fit.topics.collect()) - total) < 1e-6 * total
    w = {(r.topic_id, r.term_id): r.weight for r in fit.topic_weights().collect()}
    assert len(w) == 2 * TERMS and w[0, TERMS - 1] == w[1, TERMS - 1] == 0
    assert abs(sum(x for (k, _), x in w.items() if k == 0) - 1) < 1e-9


def test_a_fit_does_not_depend_on_parts(spark, counts):
    table = lambda f: {r.term_id: r.lam for r in f.topics.collect()}
    a, b = (table(em.fit(c, TERMS, 3, 7, 4, 5.0, 0.01, cells)) for c, cells in ((counts, 10**6), (counts.repartition(2), 100)))
    assert a.keys() == b.keys() and all(np.allclose(a[t], b[t], rtol=1e-9) for t in a)
    one = {r.term_id: r.lam for r in em.fit(counts, TERMS, 1, iterations=1).topics.collect()}
    whole = {r.term_id: r.n for r in counts.groupBy("term_id").agg(F.sum("cnt").alias("n")).collect()}
    assert one.keys() == whole.keys() and all(abs(one[t][0] - whole[t]) < 1e-9 for t in one)
