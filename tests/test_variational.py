"""Online variational steps and fold-in against plain dense numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.functions import kernels
from rostrum.operators import variational as VB
from rostrum.operators.parts import in_parts

K, V = 3, 12
psi = kernels.digamma


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(5)
    m = rng.poisson(0.7, (30, V)) * (1 + 4 * (np.arange(V)[None] % K == np.arange(30)[:, None] % K))
    m[7] = 0
    m[7, 3] = 1
    m[m.sum(1) == 0, 0] = 1
    m[:, 9] = 0
    rows = [(500 - d, w, int(m[d, w])) for d in range(30) for w in range(V) if m[d, w]]
    return m.astype(float), spark.createDataFrame(rows, "doc_id long, term_id long, cnt long").repartition(4)


def plain(m, beta, alpha, iterations, tolerance):
    """One document after the other, one round after the other."""
    gammas, rounds, sums = [], [], np.zeros_like(beta)
    for c in m:
        g, used = np.ones(K), 0
        for _ in range(iterations):
            t = np.exp(psi(g) - psi(np.array(g.sum())))
            new = alpha + t * ((c / (beta @ t)) @ beta)
            used, done, g = used + 1, np.abs(new - g).mean() < tolerance, new
            if done:
                break
        t = np.exp(psi(g) - psi(np.array(g.sum())))
        sums += beta * t * (c / (beta @ t))[:, None]
        gammas.append(g)
        rounds.append(used)
    return np.array(gammas), rounds, sums


def test_fold_in(spark, data):
    m, counts = data
    rng = np.random.RandomState(1)
    beta, alpha = rng.dirichlet(np.ones(V), K).T, np.array([0.1, 0.4, 0.2])
    rows = spark.createDataFrame([(w, beta[w].tolist()) for w in range(V) if w != 4], "term_id long, beta array<double>")
    m = m.copy()
    known = m.copy()
    known[:, 4] = 0  # a term that the topics do not know
    for cells in (10, 1_000_000):
        got = {r.doc_id: r for r in VB.fold_in(counts, rows, alpha.tolist(), 40, 0.01, cells).collect()}
        gamma, rounds, _ = plain(known, beta, alpha, 40, 0.01)
        assert len(got) == 30 and len(set(rounds)) > 3  # documents stop at different rounds
        for d in range(30):
            assert np.allclose(got[500 - d].theta, gamma[d] / gamma[d].sum(), atol=1e-9) and got[500 - d].rounds == rounds[d]


def test_slices():
    rng = np.random.RandomState(2)
    sizes = np.array([4, 0, 7, 1, 5])
    at, cnt, beta = rng.randint(0, 6, 17), rng.randint(1, 4, 17).astype(float), rng.rand(6, K)
    a = kernels.fit_mixtures(at, cnt, sizes, beta, np.ones(K), 20, 1e-4, True)
    b = kernels.fit_mixtures(at, cnt, sizes, beta, np.ones(K), 20, 1e-4, True, cells=K)
    assert all(np.allclose(x, y) for x, y in zip(a, b)) and np.allclose(a[0][1], 1)


def test_steps_and_prior(spark, data):
    m, counts = data
    rules = VB.Online(num_topics=K, alpha="auto", eta=0.05, offset=2.0, batches=2, iterations=15, tolerance=1e-4, passes=2)
    parts = in_parts(counts, 25, 2)
    batch = {r.doc_id: r.batch for r in parts.docs.collect()}
    assert set(batch.values()) == {0, 1}
    lam = np.array([r.lam for r in VB.start(spark, V, K, 42).orderBy("term_id").collect()])
    alpha = np.ones(K) / K
    for number in range(4):
        rate = (2.0 + number) ** -0.5
        mine = m[[batch[500 - d] == number % 2 for d in range(30)]]
        beta = np.exp(psi(lam) - psi(lam.sum(0)))
        gamma, _, sums = plain(mine, beta, alpha, 15, 1e-4)
        lam = (1 - rate) * lam + rate * (0.05 + 30 / len(mine) * sums)
        mean = (psi(gamma) - psi(gamma.sum(1))[:, None]).mean(0)
        # Newton's step with the full Hessian
        h = kernels.trigamma(np.array(alpha.sum())) * np.ones((K, K)) - np.diag(kernels.trigamma(alpha))
        moved = alpha - rate * np.linalg.solve(h, psi(np.array(alpha.sum())) - psi(alpha) + mean)
        alpha = moved if (moved > 0).all() else alpha
    fit = VB.fit(counts, V, rules, 42, 25)
    got = np.array([r.lam for r in fit.topics.orderBy("term_id").collect()])
    assert np.allclose(got, lam, rtol=1e-7) and np.allclose(fit.alpha, alpha, rtol=1e-7)
    w = fit.topic_weights().groupBy("topic_id").agg(F.sum("weight").alias("s"), F.count("*").alias("n")).collect()
    assert len(w) == K and all(abs(r.s - 1) < 1e-9 and r.n == V for r in w)
    assert fit.doc_topics(counts).count() == 30


def test_trigamma_and_priors():
    x = np.array([0.05, 0.7, 3.0, 40.0])
    assert np.allclose(kernels.trigamma(x), (psi(x + 1e-5) - psi(x - 1e-5)) / 2e-5, rtol=1e-6)
    assert VB.priors(VB.Online(num_topics=2, alpha="asymmetric"))[0][0] > 0.5
    with pytest.raises(ValueError):
        VB.priors(VB.Online(alpha="odd"))


def test_empty(spark, data):
    rules = VB.Online(num_topics=2, batches=2)
    fit = VB.fit(data[1].limit(0), V, rules)
    assert fit.topics.count() == V and fit.doc_topics(data[1].limit(0)).count() == 0
