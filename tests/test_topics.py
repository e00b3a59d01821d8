"""Topic metrics, scaling, run selection and LDA."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import counts as C, lda, scaling, topics as M


def lists(spark, ts):
    return spark.createDataFrame([(i, r, w) for i, t in enumerate(ts) for r, w in enumerate(t)], "topic_id int, rank int, term_id bigint")


def plain_score(ts, n, mult, compat):
    """Positions by total overlap, then a greedy walk over later positions; equal keys go last-index first."""
    k = len(ts)
    shared = lambda i, j: set(ts[i][:n]) & set(ts[j][:n])
    size = [[0 if i == j else len(shared(i, j)) for j in range(k)] for i in range(k)]
    order = sorted(range(k), key=lambda i: (-sum(size[i]), -i))
    edges = []
    for p in range(k):
        used = set()
        for q in sorted(range(p + 1, k), key=lambda q: (-size[order[p]][order[q]], -q)):
            words = shared(p, q) if compat else shared(order[p], order[q])
            if size[order[p]][order[q]] and not used & words:
                edges.append(size[order[p]][order[q]])
                used |= words
    w = np.linspace(1 / mult, n, num=n)
    return sum(w[e - 1] for e in edges) / (n * (k - 1)), sum(e == n for e in edges)


@pytest.mark.parametrize("compat", [False, True])
def test_overlap_score(spark, compat):
    rng = random.Random(5)
    for case in range(6):
        n, k = rng.choice([3, 5]), rng.choice([4, 6])
        ts = [rng.sample(range(9), n) for _ in range(k)]
        if case == 0:
            ts[1] = list(ts[0])
        if case == 1:
            ts = [list(range(i * n, i * n + n)) for i in range(k)]
        got = M.overlap_score(lists(spark, ts), k, n, compat=compat).first()
        want = plain_score(ts, n, 2, compat)
        assert abs(got.to - want[0]) < 1e-12 and got.entire_overlaps == want[1], (case, ts)


def test_uniqueness_and_redundancy(spark):
    ts = [[1, 2, 3], [1, 4, 5], [1, 2, 6]]
    t = lists(spark, ts)
    tu = {r.topic_id: r.tu for r in M.topic_uniqueness(t, 3).collect()}
    tr = {r.topic_id: r.tr for r in M.topic_redundancy(t, 3, 3).collect()}
    held = lambda w: sum(w in x for x in ts)
    for i, x in enumerate(ts):
        assert abs(tu[i] - sum(1 / held(w) for w in x) / 3) < 1e-12
        assert abs(tr[i] - sum(held(w) - 1 for w in x) / 2) < 1e-12


def test_npmi_against_matrix(spark):
    rng = np.random.RandomState(3)
    b = (rng.rand(40, 8) < 0.4).astype(int)
    b[:, 6] = 1
    b[:, 7] = 1 - b[:, 0]  # never with term 0
    ts = [[0, 1, 2, 7], [3, 4, 5, 0]]
    inc = spark.createDataFrame([(d, w) for d in range(40) for w in range(8) if b[d, w]], "doc_id bigint, term_id bigint")
    value = lambda i, j: 0.0 if not (c := (b[:, i] * b[:, j]).sum()) else (
        math.log(40 * c / (b[:, i].sum() * b[:, j].sum())) / math.log(40 / c))
    want = [np.mean([value(t[i], t[j]) for i in range(4) for j in range(i + 1, 4)]) for t in ts]
    got = {r.topic_id: r.npmi for r in M.npmi(M.pair_cooccurrence(inc, lists(spark, ts), 4), F.lit(40)).collect()}
    np.testing.assert_allclose([got[0], got[1]], want, rtol=1e-12)
    both = spark.createDataFrame([(d, w) for d in range(5) for w in (0, 1)], "doc_id bigint, term_id bigint")
    assert math.isnan(M.npmi(M.pair_cooccurrence(both, lists(spark, [[0, 1]]), 2), F.lit(5)).first().npmi)
    unseen = M.npmi(M.pair_cooccurrence(both, lists(spark, [[8, 9]]), 2), F.lit(5)).first()
    assert unseen.npmi == 0.0


def test_scaling(spark):
    theta = spark.createDataFrame([(s, d, [2.0 * s, 4.0], [1.0, 2.0]) for s in (1, 2) for d in (0, 1)], "seed int, doc_id bigint, shape array<double>, rate array<double>")
    beta = spark.createDataFrame([(s, w, [3.0, 1.0], [1.0, 1.0]) for s in (1, 2) for w in (0, 1, 2)], "seed int, term_id bigint, shape array<double>, rate array<double>")
    f = scaling.scale_factors(theta, beta)
    assert f.first().bm == 6.0 and f.first().tm == 5.0
    w = spark.createDataFrame([(0, t, 0.5) for t in range(3)], "topic_id int, term_id bigint, weight double")
    sb = scaling.scaled_beta(w, f, F.lit(3))
    assert {r.weight for r in sb.collect()} == {3.0}
    assert sorted((r.term_id, r.weight) for r in scaling.topic_word(sb, F.lit(3)).collect()) == [(0, 3.000001), (1, 3.000001)]
    assert scaling.topic_word(sb, F.lit(3), drop_last_term=False).count() == 3
    zero = spark.createDataFrame([(0.0, 0.0)], "bm double, tm double")
    assert scaling.scaled_beta(w, zero, F.lit(3)).first().weight == 1.5
    th = spark.createDataFrame([(0, [0.25, 0.75])], "doc_id bigint, theta array<double>")
    assert scaling.scaled_theta(th, zero).first().theta == [0.5, 1.5]


def test_runs_and_split(spark):
    m = spark.createDataFrame([(7, 0.2), (3, 0.5), (5, 0.5)], "seed int, npmi_mean double")
    assert M.best_run(m, F.col("npmi_mean")).first().seed == 3
    s = M.run_summary(m).first()
    assert s.n_runs == 3 and abs(s["std"] - np.std([0.2, 0.5, 0.5], ddof=1)) < 1e-12
    ids = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = M.eval_split(ids, 0.3).filter("is_eval")
    assert 500 < a.count() < 700
    assert a.exceptAll(M.eval_split(ids.repartition(7), 0.3).filter("is_eval")).count() == 0


def test_lda_finds_planted_topics(spark):
    rng = np.random.RandomState(0)
    rows = []
    for d in range(200):
        for w, c in zip(*np.unique(rng.randint(0, 5, 30) + 5 * (d % 2), return_counts=True)):
            rows.append((d, int(w), int(c)))
    counts = spark.createDataFrame(rows, "doc_id bigint, term_id bigint, cnt bigint")
    f = lda.vectors(counts, 10)
    for model in (lda.fit_em(f, 2, iterations=20, alpha=5.0, beta=0.01), lda.fit_online(f, 2, passes=3)):
        top = M.top_terms(lda.topic_weights(model, 10), 5)
        got = {frozenset(r.term_id for r in top.collect() if r.topic_id == k) for k in (0, 1)}
        assert got == {frozenset(range(5)), frozenset(range(5, 10))}
    theta = lda.doc_topics(model, f).collect()
    assert len(theta) == 200 and all(abs(sum(r.theta) - 1) < 1e-6 for r in theta)


def test_topic_order_breaks_ties_by_term(spark):
    w = spark.createDataFrame([(0, 2, 0.5), (0, 1, 0.5), (0, 3, 0.9)], "topic_id int, term_id bigint, weight double")
    assert [r.term_id for r in M.top_terms(w, 2).orderBy("rank").collect()] == [3, 1]
    inc = C.incidence(spark.createDataFrame([(0, 1, 0), (0, 2, 3)], "doc_id bigint, term_id bigint, cnt bigint"))
    assert inc.count() == 1


def test_priors_of_the_online_optimizer(spark):
    from pyspark.ml.linalg import Vectors

    from rostrum.operators import lda

    rows = spark.createDataFrame([(i, Vectors.sparse(7, [i % 6, i % 6 + 1], [2.0, 1.0])) for i in range(30)], ["doc_id", "features"])
    model = lda.fit_online(rows, 3, alpha="asymmetric", subsampling_rate=0.5)
    prior = model.getDocConcentration()
    assert abs(sum(prior) - 1) < 1e-9 and prior[0] > prior[1] > prior[2]
    for bad in ({"alpha": "other"}, {"eta": "auto"}):
        with pytest.raises(ValueError, match="priors"):
            lda.fit_online(rows, 3, **bad)
