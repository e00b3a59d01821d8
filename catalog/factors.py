"""Factorisation steps, bound terms, fits and rescaling."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions import special
from rostrum.operators import factorization as PF, scaling
from rostrum.plans.stage import new_path, stage

from .fixtures import HASH, table
from .registry import query, r, with_ctes
from .topics import UNI, WEIGHTS, uni_tables, weights

K, SEEDS = 3, [22, 194]
S0 = PF.prior_shape(K)


def _psi(x: str) -> str:
    y = f"({x} + 6)"
    back = " - ".join(f"1 / ({x} + {i})" for i in range(6))
    series = f"1 / (12 * pow({y}, 2)) - 1 / (120 * pow({y}, 4)) + 1 / (252 * pow({y}, 6)) - 1 / (240 * pow({y}, 8)) + 1 / (132 * pow({y}, 10))"
    return f"(ln({y}) - 1 / (2 * {y}) - ({series}) - {back})"


def _noise(name: str, key: str, k: str) -> str:
    u = lambda part: HASH(f"concat_ws(':', seed, '{name}', {key}, {k}, '{part}')")
    return f"exp(0.1 * sqrt(-2 * ln({u('a')})) * cos(2 * pi() * {u('b')}))"


def _init(out, ids, key, name):
    return (f"{out} AS (SELECT seed, {key}, k, {_noise(name + '.shape', key, 'k')} AS shape, {_noise(name + '.rate', key, 'k')} AS rate, "
            f"{_noise(name + '.prior', key, '0')} AS prior_rate FROM (SELECT DISTINCT {key} FROM {ids}), "
            f"(SELECT unnest({SEEDS}) AS seed), (SELECT unnest({list(range(K))}) AS k))")


STATE = [*UNI, _init("th", "uc", "doc_id", "document"), _init("be", "uvocab", "term_id", "topic")]
STEP = [*STATE, f"gth AS (SELECT *, exp({_psi('shape')}) / rate AS g FROM th)", f"gbe AS (SELECT *, exp({_psi('shape')}) / rate AS g FROM be)",
        "nz AS (SELECT seed, doc_id, term_id, cnt, sum(t.g * b.g) AS normalizer FROM uc JOIN gth t USING (doc_id) JOIN gbe b USING (seed, term_id, k) GROUP BY ALL)",
        "dmsg AS (SELECT seed, doc_id, k, sum(cnt / normalizer * b.g) AS m FROM nz JOIN gbe b USING (seed, term_id) GROUP BY ALL)",
        "bsum AS (SELECT seed, k, sum(shape / rate) AS s FROM be GROUP BY ALL)",
        f"th1 AS (SELECT seed, doc_id, k, 0.3 + g * coalesce(m, 0) AS shape, {S0} / prior_rate + s AS rate FROM gth LEFT JOIN dmsg USING (seed, doc_id, k) JOIN bsum USING (seed, k))",
        "nth AS (SELECT *, 0.3 + sum(shape / rate) OVER (PARTITION BY seed, doc_id) AS prior_rate FROM th1)",
        "tmsg AS (SELECT seed, term_id, k, sum(cnt / normalizer * t.g) AS m FROM nz JOIN gth t USING (seed, doc_id) GROUP BY ALL)",
        "tsum AS (SELECT seed, k, sum(shape / rate) AS s FROM nth GROUP BY ALL)",
        f"be1 AS (SELECT seed, term_id, k, 0.3 + g * coalesce(m, 0) AS shape, {S0} / prior_rate + s AS rate FROM gbe LEFT JOIN tmsg USING (seed, term_id, k) JOIN tsum USING (seed, k))",
        "nbe AS (SELECT *, 0.3 + sum(shape / rate) OVER (PARTITION BY seed, term_id) AS prior_rate FROM be1)"]
_LONG_SQL = "SELECT seed, {0}, k, round(shape, 6) AS shape, round(rate, 6) AS rate, round(prior_rate, 6) AS prior_rate FROM {1}"


def _long(state, key):
    x = F.posexplode(F.arrays_zip("shape", "rate")).alias("k", "x")
    return state.select("seed", key, "prior_rate", x).select(
        "seed", key, "k", r(F.col("x.shape")).alias("shape"), r(F.col("x.rate")).alias("rate"), r(F.col("prior_rate")).alias("prior_rate"))


def state(spark, sf):
    """Vocabulary, counts and the initial document and topic factors."""
    v, counts = uni_tables(spark, sf)
    theta, beta = _initial(v, counts)
    return v, counts, theta, beta


def _initial(v, counts):
    theta = PF.init_state(counts.select("doc_id").distinct(), "doc_id", "document", SEEDS, K)
    beta = PF.init_state(v.select("term_id"), "term_id", "topic", SEEDS, K)
    return stage(theta, "theta"), stage(beta, "beta")


def one_step(spark, sf):
    _, counts, theta, beta = state(spark, sf)
    nz = stage(PF.with_normalizer(counts, theta, beta), "normalized")
    new_theta = stage(PF.doc_step(nz, theta, beta, K), "theta1")
    return nz, new_theta, PF.topic_step(nz, beta, new_theta, K)


@query("pf_init", with_ctes(*STATE, select="SELECT seed, doc_id AS id, 'document' AS side, k, round(shape, 6) AS shape, round(rate, 6) AS rate, round(prior_rate, 6) AS prior_rate FROM th"
                                           " UNION ALL SELECT seed, term_id, 'topic', k, round(shape, 6), round(rate, 6), round(prior_rate, 6) FROM be"))
def pf_init(spark, sf):
    _, _, theta, beta = state(spark, sf)
    side = lambda df, key, name: _long(df, key).select("seed", F.col(key).alias("id"), F.lit(name).alias("side"), "k", "shape", "rate", "prior_rate")
    return side(theta, "doc_id", "document").unionByName(side(beta, "term_id", "topic"))


@query("pf_normalizer", with_ctes(*STEP[:-7], select="SELECT seed, doc_id, term_id, round(normalizer, 6) AS normalizer FROM nz"))
def pf_normalizer(spark, sf):
    return PF.with_normalizer(*state(spark, sf)[1:]).select("seed", "doc_id", "term_id", r(F.col("normalizer")).alias("normalizer"))


@query("pf_doc_step", with_ctes(*STEP[:-4], select=_LONG_SQL.format("doc_id", "nth")))
def pf_doc_step(spark, sf):
    _, counts, theta, beta = state(spark, sf)
    return _long(PF.doc_step(PF.with_normalizer(counts, theta, beta), theta, beta, K), "doc_id")


@query("pf_topic_step", with_ctes(*STEP, select=_LONG_SQL.format("term_id", "nbe")))
def pf_topic_step(spark, sf):
    return _long(one_step(spark, sf)[2], "term_id")


# --- bound ---------------------------------------------------------------------------------------

_PRIOR_ROW = "(SELECT DISTINCT seed, {1}, prior_rate FROM {0})"


def _log_prior_sql(t, key):
    return f"SELECT seed, sum(-0.7 * ({_psi(str(S0))} - ln(prior_rate)) - 0.3 * {S0} / prior_rate) AS v FROM {_PRIOR_ROW.format(t, key)} GROUP BY seed"


def _log_cond_sql(t, key):
    return f"""SELECT seed, sum({K * 0.3} * ({_psi(str(S0))} - ln(prior_rate)) / {K} - 0.7 * ({_psi('shape')} - ln(rate)) - shape / rate * {S0} / prior_rate) AS v
 FROM {t} GROUP BY seed"""


def _entropy_sql(t, key):
    e = lambda s, q: f"{s} - ln({q}) + lgamma({s}) + (1 - {s}) * {_psi(s)}"
    return f"""SELECT seed, sum(v) AS v FROM (SELECT seed, {e('shape', 'rate')} AS v FROM {t}
 UNION ALL SELECT seed, {e(f'{S0}::DOUBLE', 'prior_rate')} FROM {_PRIOR_ROW.format(t, key)}) GROUP BY seed"""


def _data_sql(th, be):
    return f"""SELECT seed, -sum(d * t) AS v FROM (SELECT seed, k, sum(shape / rate) AS d FROM {th} GROUP BY ALL)
 JOIN (SELECT seed, k, sum(shape / rate) AS t FROM {be} GROUP BY ALL) USING (seed, k) GROUP BY seed"""


_AUX = "SELECT seed, sum(cnt * ln(normalizer)) AS v FROM nz GROUP BY seed"


def _both(fn):
    return with_ctes(*STATE, select=f"SELECT 'document' AS side, seed, round(v, 4) + 0.0::DOUBLE AS value FROM ({fn('th', 'doc_id')})"
                                    f" UNION ALL SELECT 'topic', seed, round(v, 4) + 0.0::DOUBLE FROM ({fn('be', 'term_id')})")


def _sides(fn, spark, sf):
    _, _, theta, beta = state(spark, sf)
    side = lambda df, name: fn(df, K).select(F.lit(name).alias("side"), "seed", r(F.col("value"), 4).alias("value"))
    return side(theta, "document").unionByName(side(beta, "topic"))


@query("pf_log_prior", _both(_log_prior_sql))
def pf_log_prior(spark, sf):
    return _sides(PF.log_prior, spark, sf)


@query("pf_log_conditional", _both(_log_cond_sql))
def pf_log_conditional(spark, sf):
    return _sides(PF.log_conditional, spark, sf)


@query("pf_gamma_entropy", _both(_entropy_sql))
def pf_gamma_entropy(spark, sf):
    return _sides(PF.gamma_entropy, spark, sf)


@query("pf_data_term", with_ctes(*STATE, select=f"SELECT seed, round(v, 4) AS value FROM ({_data_sql('th', 'be')})"))
def pf_data_term(spark, sf):
    _, _, theta, beta = state(spark, sf)
    return PF.data_term(theta, beta, K).select("seed", r(F.col("value"), 4).alias("value"))


@query("pf_aux_entropy", with_ctes(*STEP[:-7], select=f"SELECT seed, round(v, 4) AS value FROM ({_AUX})"))
def pf_aux_entropy(spark, sf):
    return PF.aux_entropy(PF.with_normalizer(*state(spark, sf)[1:])).select("seed", r(F.col("value"), 4).alias("value"))


_PARTS = " UNION ALL ".join([_log_prior_sql("nth", "doc_id"), _log_prior_sql("nbe", "term_id"), _log_cond_sql("nth", "doc_id"), _log_cond_sql("nbe", "term_id"),
                             _entropy_sql("nth", "doc_id"), _entropy_sql("nbe", "term_id"), _data_sql("nth", "nbe"), _AUX])


@query("pf_elbo", with_ctes(*STEP, select=f"SELECT seed, round(sum(v), 3) AS elbo FROM ({_PARTS}) GROUP BY seed"))
def pf_elbo(spark, sf):
    nz, theta, beta = one_step(spark, sf)
    return PF.elbo(nz, theta, stage(beta, "beta1"), K).select("seed", r(F.col("elbo"), 3).alias("elbo"))


# --- fits ----------------------------------------------------------------------------------------

@query("pf_fit")
def pf_fit(spark, sf):
    v, counts = uni_tables(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).first().n
    return PF.fit(counts, n, 10, [22], steps=20, elbo_every=10).beta.select("seed", "term_id", F.posexplode(
        special.gamma_mean(F.col("shape"), F.col("rate"))).alias("topic_id", "weight"))


def _steps_sql(steps: int) -> list[str]:
    """The update of one step, written out ``steps`` times; the factors after step i are ``th_i`` and ``be_i``."""
    own = {name: name + "_{0}" for name in ("gth", "gbe", "nz", "dmsg", "bsum", "th1", "tmsg", "tsum", "be1", "th", "be")} | {"nth": "th_{1}", "nbe": "be_{1}"}
    named = lambda cte, i: re.sub(r"\b(" + "|".join(own) + r")\b", lambda m: own[m[0]].format(i, i + 1), cte)
    return [*UNI, *[named(x, 0) for x in STATE[len(UNI):]], *[named(x, i) for i in range(steps) for x in STEP[len(STATE):]]]


_FIT_SQL = with_ctes(*_steps_sql(3), select=_LONG_SQL.format("term_id AS id, 'topic' AS side", "be_3") + " UNION ALL " + _LONG_SQL.format("doc_id, 'document'", "th_3"))


def _both_sides(fit):
    side = lambda df, key, name: _long(df, key).select("seed", F.col(key).alias("id"), F.lit(name).alias("side"), "k", "shape", "rate", "prior_rate")
    return side(fit.beta, "term_id", "topic").unionByName(side(fit.theta, "doc_id", "document"))


@query("pf_fit_steps", _FIT_SQL)
def pf_fit_steps(spark, sf):
    """All factors of both seeds after three steps of the packed engine."""
    v, counts = uni_tables(spark, sf)
    return _both_sides(PF.fit(counts, v.agg(F.count(F.lit(1)).alias("n")).first().n, K, SEEDS, steps=3))


class _Killed(Exception):
    pass


@query("pf_resume", _FIT_SQL)
def pf_resume(spark, sf):
    """The same factors from a fit that is killed after its second step, one step behind its last snapshot, and started again."""
    v, counts = uni_tables(spark, sf)
    n, path, seen = v.agg(F.count(F.lit(1)).alias("n")).first().n, new_path(spark, "factor-snapshots"), []

    def kill(step):
        if step == 1:
            raise _Killed

    settings = {"num_topics": K, "seeds": SEEDS, "steps": 3, "store": path, "store_every": 3}
    try:
        PF.fit(counts, n, on_step=kill, **settings)
    except _Killed:
        pass
    again = PF.fit(counts, n, on_step=seen.append, **settings)
    if seen != [1, 2]:
        raise AssertionError(f"the second run did steps {seen}")
    return _both_sides(again)


@query("pf_seed_status", with_ctes(*UNI, select="""SELECT seed, CASE WHEN seed = 194 THEN 'failed' ELSE 'done' END AS status,
 CASE WHEN seed = 194 THEN 0 ELSE (SELECT count(*) FROM uvocab) END AS n_terms,
 CASE WHEN seed = 194 THEN 0 ELSE (SELECT count(DISTINCT doc_id) FROM uc) END AS n_docs FROM (SELECT unnest([22, 194, 164])::INT AS seed)"""))
def pf_seed_status(spark, sf):
    """Three seeds by themselves; one meets snapshots of another fit and fails, the others' factors are there."""
    v, counts = uni_tables(spark, sf)
    n, path, seeds = v.agg(F.count(F.lit(1)).alias("n")).first().n, new_path(spark, "factor-seeds"), [22, 194, 164]
    PF.fit(counts.limit(5), n, K, [194], steps=1, store=path)
    try:
        fits, failures = PF.fit_seeds(counts, n, K, seeds, steps=3, store=path, parallel=2), {}
    except PF.SeedsFailed as e:
        fits, failures = e.fits, e.failures
    size = lambda df: df.groupBy("seed").agg(F.count("*").alias("n"))
    tables = [size(getattr(f, t)).withColumn("t", F.lit(t)) for f in fits.values() for t in ("beta", "theta")]
    sums = reduce(DataFrame.unionByName, tables).groupBy("seed").pivot("t", ["beta", "theta"]).sum("n")
    status = spark.createDataFrame([(s, "failed" if s in failures else "done") for s in seeds], "seed int, status string")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return status.join(sums, "seed", "left").select("seed", "status", zero(F.col("beta")).alias("n_terms"), zero(F.col("theta")).alias("n_docs"))


@query("pf_multi_seed")
def pf_multi_seed(spark, sf):
    v, counts = uni_tables(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).first().n
    return PF.fit(counts, n, K, [22, 194, 164], steps=10, elbo_every=5).bounds


# --- special functions and rescaling -------------------------------------------------------------

_LOGITS = "[ln(n_chars), -n_chars / 100.0::DOUBLE, n_chars / 40.0::DOUBLE, CAST(doc_id AS DOUBLE)]"


@query("logsumexp", f"SELECT doc_id, round(list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l))))), 6) AS value FROM (SELECT doc_id, {_LOGITS} AS l FROM documents)")
def logsumexp(spark, sf):
    d = table(spark, sf, "documents")
    logits = F.array(F.ln("n_chars"), -F.col("n_chars") / F.lit(100.0), F.col("n_chars") / F.lit(40.0), F.col("doc_id").cast("double"))
    return d.select("doc_id", r(special.logsumexp(logits)).alias("value"))


@query("gamma_geo_mean", f"SELECT doc_id, round(exp({_psi('s')}) / q, 6) AS value FROM (SELECT doc_id, n_chars / 1000.0::DOUBLE AS s, 1 + length(source) / 3.0::DOUBLE AS q FROM documents)")
def gamma_geo_mean(spark, sf):
    s, q = F.array(F.col("n_chars") / F.lit(1000.0)), F.array(F.lit(1) + F.length("source") / F.lit(3.0))
    return table(spark, sf, "documents").select("doc_id", r(special.gamma_geo_mean(s, q)[0]).alias("value"))


FACTORS = [*STATE, "bm AS (SELECT avg(s) AS bm FROM (SELECT sum(shape / rate) AS s FROM be GROUP BY seed, k))",
           "tm AS (SELECT avg(s) AS tm FROM (SELECT sum(shape / rate) AS s FROM th GROUP BY seed, doc_id))"]


@query("scale_factors", with_ctes(*FACTORS, select="SELECT round(bm, 6) AS bm, round(tm, 6) AS tm FROM bm, tm"))
def scale_factors(spark, sf):
    _, _, theta, beta = state(spark, sf)
    return scaling.scale_factors(theta, beta).select(r(F.col("bm")).alias("bm"), r(F.col("tm")).alias("tm"))


_WEIGHT_CTE = WEIGHTS[-1]


@query("scaled_beta", with_ctes(*FACTORS, _WEIGHT_CTE, select="""SELECT topic_id, term_id, round(weight * bm, 5) AS weight,
 CASE WHEN term_id < (SELECT count(*) FROM uvocab) - 1 THEN round(weight * bm + 1e-6, 5) END AS topic_word FROM weights, bm"""))
def scaled_beta(spark, sf):
    v, _, theta, beta = state(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).scalar()
    scaled = scaling.scaled_beta(weights(v).drop("term"), stage(scaling.scale_factors(theta, beta), "means"), n)
    out = scaling.topic_word(scaled, n).withColumnRenamed("weight", "topic_word")
    return scaled.join(out, ["topic_id", "term_id"], "left").select(
        "topic_id", "term_id", r(F.col("weight"), 5).alias("weight"), r(F.col("topic_word"), 5).alias("topic_word"))


@query("scaled_theta", with_ctes(*FACTORS, select="SELECT seed, doc_id, k, round(shape * tm, 5) AS weight FROM th, tm"))
def scaled_theta(spark, sf):
    _, _, theta, beta = state(spark, sf)
    means = stage(scaling.scale_factors(theta, beta), "means")
    return scaling.scaled_theta(theta.select("seed", "doc_id", F.col("shape").alias("theta")), means).select(
        "seed", "doc_id", F.posexplode("theta").alias("k", "w")).select("seed", "doc_id", "k", r(F.col("w"), 5).alias("weight"))
