"""Factorisation against a small dense model written from the update equations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.functions import kernels, special
from rostrum.operators import factorization as PF

K, STEPS, V = 3, 5, 7
A = 0.3


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.RandomState(0)
    m = rng.poisson(0.8, size=(12, V))
    m[4] = 0
    m[4, 2] = 1
    m[:, 5] = 0  # a term without counts
    m[m.sum(1) == 0, 0] = 2
    rows = [(100 + d, w, int(m[d, w])) for d in range(12) for w in range(V) if m[d, w]]
    return m, spark.createDataFrame(rows, "doc_id bigint, term_id bigint, cnt bigint")


def lg(x):
    return np.vectorize(math.lgamma)(x)


def dense(m, ts, tr, tp, bs, br, bp, steps):
    """Factors are documents x K and terms x K."""
    psi, s0 = kernels.digamma, A + K * A
    bounds = []
    for _ in range(steps):
        gd, gt = np.exp(psi(ts)) / tr, np.exp(psi(bs)) / br
        norm = gd @ gt.T
        share = m / norm
        nts = A + gd * (share @ gt)
        ntr = (s0 / tp)[:, None] + (bs / br).sum(0)[None]
        ntp = A + (nts / ntr).sum(1)
        nbs = A + gt * (share.T @ gd)
        nbr = (s0 / bp)[:, None] + (nts / ntr).sum(0)[None]
        nbp = A + (nbs / nbr).sum(1)
        ts, tr, tp, bs, br, bp = nts, ntr, ntp, nbs, nbr, nbp

        def ent(s, r):
            return np.sum(s - np.log(r) + lg(s) + (1 - s) * psi(s))

        def prior(r):
            return np.sum((A - 1) * (psi(np.array(s0)) - np.log(r)) - A * s0 / r)

        def cond(s, r, p):
            return (K * A * np.sum(psi(np.array(s0)) - np.log(p)) + (A - 1) * np.sum(psi(s) - np.log(r))
                    - np.sum(s / r * (s0 / p)[:, None]))

        bounds.append(prior(tp) + prior(bp) + cond(ts, tr, tp) + cond(bs, br, bp) - np.sum((ts / tr) @ (bs / br).T)
                      + ent(np.full_like(tp, s0), tp) + ent(np.full_like(bp, s0), bp) + ent(ts, tr) + ent(bs, br)
                      + np.sum(m * np.log(norm)))
    return ts, tr, tp, bs, br, bp, bounds


def pull(df, seed, key):
    rows = sorted(df.filter(F.col("seed") == seed).collect(), key=lambda r: r[key])
    return (np.array([r.shape for r in rows]), np.array([r["rate"] for r in rows]), np.array([r.prior_rate for r in rows]))


@pytest.mark.parametrize("limit", [PF.BROADCAST_LIMIT, 0], ids=["packed", "relational"])
def test_fit_equals_dense_model(spark, counts, limit):
    m, df = counts
    seeds = [3, 11]
    steps = STEPS if limit else 2
    fit = PF.fit(df, V, K, seeds, steps=steps, elbo_every=1, checkpoint_every=2, broadcast_limit=limit)
    for seed in seeds:
        t0 = PF.init_state(df.select("doc_id").distinct(), "doc_id", "document", seeds, K)
        b0 = PF.init_state(PF._terms(spark, V), "term_id", "topic", seeds, K)
        want = dense(m, *pull(t0, seed, "doc_id"), *pull(b0, seed, "term_id"), steps)
        got = [*pull(fit.theta, seed, "doc_id"), *pull(fit.beta, seed, "term_id")]
        for g, w in zip(got, want):
            np.testing.assert_allclose(g, w, rtol=1e-9)
        bounds = [r.elbo for r in fit.bounds.filter(F.col("seed") == seed).orderBy("step").collect()]
        np.testing.assert_allclose(bounds, want[-1], rtol=1e-9)
        if steps > 2:
            assert all(b >= a - 1e-9 for a, b in zip(bounds[1:], bounds[2:]))


def test_seed_groups_under_a_small_limit(spark, counts):
    _, df = counts
    one = PF.fit(df, V, K, [3, 11], steps=2, broadcast_limit=V * K * 8)
    both = PF.fit(df, V, K, [3, 11], steps=2)
    for seed in (3, 11):
        for name, key in (("theta", "doc_id"), ("beta", "term_id")):
            for a, b in zip(pull(getattr(one, name), seed, key), pull(getattr(both, name), seed, key)):
                np.testing.assert_allclose(a, b, rtol=1e-12)


def test_slices_do_not_change_the_kernel():
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    rng = np.random.RandomState(1)
    schema = to_arrow_schema(PF._STATE)
    idx = [sorted(rng.choice(V, size=n, replace=False).tolist()) for n in (3, 0, 5, 2, 6)]
    n = len(idx)
    batch = pa.RecordBatch.from_arrays([
        pa.array([0] * n, pa.int8()), pa.array([7, 7, 9, 9, 7], pa.int32()), pa.array(range(n), pa.int64()), pa.array(idx, pa.list_(pa.int32())),
        pa.array([[1.0] * len(x) for x in idx], pa.list_(pa.float64())), pa.array(np.exp(rng.randn(n, K)).tolist()),
        pa.array(np.exp(rng.randn(n, K)).tolist()), pa.array(np.exp(rng.randn(n)))], schema=schema)
    geo, topic_sum = np.exp(rng.randn(2 * V, K)), np.exp(rng.randn(2, K))
    run = lambda parts: pa.Table.from_batches(list(kernels.doc_update(
        parts, geo, topic_sum, {7: 0, 9: 1}, K, A, A, A + K * A, schema, True))).to_pylist()
    for a, b in zip(run([batch]), run([batch.slice(i, 1) for i in range(n)]), strict=True):
        assert (a["kind"], a["seed"], a["id"]) == (b["kind"], b["seed"], b["id"])
        np.testing.assert_allclose(a["shape"], b["shape"], rtol=1e-10)


def test_special_functions(spark):
    xs = [0.05, 0.3, 1.0, 2.5, 7.0, 40.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(special.digamma(F.col("x")).alias("d"), special.gammaln(F.col("x")).alias("g")).collect()
    np.testing.assert_allclose([r.g for r in rows], [math.lgamma(x) for x in xs], rtol=1e-10, atol=1e-11)
    assert abs(rows[2].d + 0.5772156649015329) < 1e-10
    np.testing.assert_allclose([r.d for r in rows], kernels.digamma(np.array(xs)), rtol=1e-12)
    np.testing.assert_allclose(kernels.gammaln(np.array(xs)), [math.lgamma(x) for x in xs], rtol=1e-10, atol=1e-11)
    one = spark.createDataFrame([([1000.0, 1000.0],)], "a array<double>")
    assert abs(one.select(special.logsumexp(F.col("a"))).first()[0] - (1000 + math.log(2))) < 1e-9


def test_batches_are_cut_by_size():
    import pyarrow as pa

    idx = pa.array([[1] * n for n in (3, 0, 5, 2, 9, 1)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([idx], names=["idx"])
    parts = list(kernels.slices([batch, batch.slice(0, 0)], 2, cells=10))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) > 2
    assert pa.concat_arrays([p.column("idx") for p in parts]).equals(idx)
