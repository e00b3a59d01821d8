"""Poisson factorisation by coordinate-ascent variational inference.

State tables: ``theta (seed, doc_id, shape, rate, prior_rate)`` and ``beta (seed, term_id, shape,
rate, prior_rate)`` with K-long arrays; ``counts (doc_id, term_id, cnt)`` holds non-zeros only. Seeds
are a column, so several fits are one job.

Two engines share the same updates:

* relational: joins and vector sums on the state tables, any size of model;
* packed (:func:`fit`): one Arrow pass per step over packed documents with the term factors broadcast.
  It is used only while the factors stay below a byte limit that is checked first; larger models take
  the relational engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import kernels
from ..functions.special import array_sum, digamma, dot, gamma_geo_mean, gamma_mean, gammaln
from ..plans.stage import by_key, work_dir
from ..plans.versions import Version, Versions
from .counts import packed_docs

# Workers get the helpers inside the task closure, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(kernels)

PRIOR = 0.3  # shape of the factors' gamma prior, and shape and rate of its hyperprior
DEFAULT_SEEDS = (22, 194, 164, 98, 210, 10, 128, 42, 105, 101)  # fixed values
BROADCAST_LIMIT = 64 * 1024 * 1024  # bytes; a Python worker holds about twice this


def prior_shape(num_topics: int) -> float:
    return PRIOR + num_topics * PRIOR


# --- initial state ----------------------------------------------------------------------------

def _uniform(*parts: Column) -> Column:
    h = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**32))


def _noise(seed: Column, name: str, key: Column, k: Column) -> Column:
    """exp(0.1 N(0, 1)), the same on every run and partitioning: Box-Muller on hashes of the key."""
    u1 = _uniform(seed, F.lit(name), key, k, F.lit("a"))
    u2 = _uniform(seed, F.lit(name), key, k, F.lit("b"))
    return F.exp(F.lit(0.1) * F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * np.pi) * u2))


def init_state(ids: DataFrame, key: str, name: str, seeds: Sequence[int], num_topics: int) -> DataFrame:
    """Add seed, shape, rate and prior_rate to the rows of ``ids``, once per seed."""
    df = ids.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    ks = F.sequence(F.lit(0), F.lit(num_topics - 1))
    draw = lambda part: F.transform(ks, lambda k: _noise(F.col("seed"), f"{name}.{part}", F.col(key), k))
    return (df.withColumn("shape", draw("shape")).withColumn("rate", draw("rate"))
            .withColumn("prior_rate", _noise(F.col("seed"), f"{name}.prior", F.col(key), F.lit(0))))


# --- relational engine ------------------------------------------------------------------------

def _vector_sum(col: str, k: int) -> Column:
    return F.array(*[F.sum(F.get(col, F.lit(i))) for i in range(k)])


def with_normalizer(counts: DataFrame, theta: DataFrame, beta: DataFrame) -> DataFrame:
    """Non-zero counts with both geometric means and ``normalizer`` = sum_k G(theta)_dk G(beta)_kw."""
    gd = theta.select("seed", "doc_id", gamma_geo_mean(F.col("shape"), F.col("rate")).alias("g_doc"))
    gt = beta.select("seed", "term_id", gamma_geo_mean(F.col("shape"), F.col("rate")).alias("g_term"))
    nz = counts.filter("cnt > 0").select("doc_id", "term_id", F.col("cnt").cast("double").alias("cnt"))
    return (nz.join(gd, "doc_id").join(gt, ["seed", "term_id"])
            .withColumn("normalizer", dot(F.col("g_doc"), F.col("g_term"))))


def factor_sum(state: DataFrame, k: int, out: str) -> DataFrame:
    """One row per seed: the sum over rows of shape / rate, a K-long array."""
    means = state.select("seed", gamma_mean(F.col("shape"), F.col("rate")).alias("e"))
    return means.groupBy("seed").agg(_vector_sum("e", k).alias(out))


def _by_seed(sums: DataFrame, column: str) -> Column:
    """The per-seed vector as a lookup in a one-row subquery; there is one entry per seed."""
    m = sums.agg(F.map_from_entries(F.collect_list(F.struct("seed", column))).alias("m")).scalar()
    return F.try_element_at(m, F.col("seed"))


def _update(state: DataFrame, msg: DataFrame, key: str, other_sum: Column, k: int) -> DataFrame:
    """New shape, rate and prior rate of one side; rows without counts keep the prior shape."""
    g = gamma_geo_mean(F.col("shape"), F.col("rate"))
    joined = state.join(msg, ["seed", key], "left")
    new_shape = F.coalesce(F.zip_with(g, F.col("msg"), lambda x, m: F.lit(PRIOR) + x * m),
                           F.transform("shape", lambda _: F.lit(PRIOR)))
    new_rate = F.transform(F.col("other"), lambda t: F.col("base") + t)
    u = (joined.withColumn("other", other_sum).withColumn("base", F.lit(prior_shape(k)) / F.col("prior_rate"))
         .select("seed", key, new_shape.alias("shape"), new_rate.alias("rate")))
    mean_total = array_sum(gamma_mean(F.col("shape"), F.col("rate")))
    return u.withColumn("prior_rate", F.lit(PRIOR) + mean_total)


def doc_step(nz: DataFrame, theta: DataFrame, beta: DataFrame, k: int) -> DataFrame:
    """New document factors from ``nz`` (see :func:`with_normalizer`) and the old topics."""
    share = F.col("cnt") / F.col("normalizer")
    msg = (nz.select("seed", "doc_id", F.transform("g_term", lambda g: g * share).alias("v"))
           .groupBy("seed", "doc_id").agg(_vector_sum("v", k).alias("msg")))
    return _update(theta, msg, "doc_id", _by_seed(factor_sum(beta, k, "t"), "t"), k)


def topic_step(nz: DataFrame, beta: DataFrame, new_theta: DataFrame, k: int) -> DataFrame:
    """New topic factors from old document factors (inside ``nz``) and the new document totals."""
    share = F.col("cnt") / F.col("normalizer")
    msg = (nz.select("seed", "term_id", F.transform("g_doc", lambda g: g * share).alias("v"))
           .groupBy("seed", "term_id").agg(_vector_sum("v", k).alias("msg")))
    return _update(beta, msg, "term_id", _by_seed(factor_sum(new_theta, k, "t"), "t"), k)


# --- evidence lower bound ---------------------------------------------------------------------

def log_prior(state: DataFrame, k: int) -> DataFrame:
    """Expected gamma log-prior of the prior rates, per seed."""
    s0 = F.lit(prior_shape(k))
    r = F.col("prior_rate")
    v = F.lit(PRIOR - 1.0) * (digamma(s0) - F.ln(r)) - F.lit(PRIOR) * (s0 / r)
    return state.groupBy("seed").agg(F.sum(v).alias("value"))


def log_conditional(state: DataFrame, k: int) -> DataFrame:
    """Expected log conditional of the factors given their prior rates, per seed."""
    s0 = F.lit(prior_shape(k))
    r = F.col("prior_rate")
    log_factor = array_sum(F.zip_with("shape", "rate", lambda s, q: digamma(s) - F.ln(q)))
    mean_total = array_sum(gamma_mean(F.col("shape"), F.col("rate")))
    v = F.lit(k * PRIOR) * (digamma(s0) - F.ln(r)) + F.lit(PRIOR - 1.0) * log_factor - mean_total * (s0 / r)
    return state.groupBy("seed").agg(F.sum(v).alias("value"))


def _entropy(shape: Column, rate: Column) -> Column:
    return shape - F.ln(rate) + gammaln(shape) + (F.lit(1.0) - shape) * digamma(shape)


def gamma_entropy(state: DataFrame, k: int) -> DataFrame:
    """Entropy of the factors and of the prior rates, per seed."""
    factors = array_sum(F.zip_with("shape", "rate", _entropy))
    v = factors + _entropy(F.lit(prior_shape(k)), F.col("prior_rate"))
    return state.groupBy("seed").agg(F.sum(v).alias("value"))


def data_term(theta: DataFrame, beta: DataFrame, k: int) -> DataFrame:
    """-sum_dw sum_k E(theta) E(beta), from the two marginal vectors."""
    d = factor_sum(theta, k, "d").join(factor_sum(beta, k, "t"), "seed")
    return d.select("seed", (-dot(F.col("d"), F.col("t"))).alias("value"))


def aux_entropy(nz: DataFrame) -> DataFrame:
    """sum c ln(normalizer) over the non-zero counts, per seed."""
    return nz.groupBy("seed").agg(F.sum(F.col("cnt") * F.ln("normalizer")).alias("value"))


def elbo(nz: DataFrame, theta: DataFrame, beta: DataFrame, k: int) -> DataFrame:
    """Evidence lower bound per seed; ``nz`` carries the normaliser of the step before."""
    parts = [log_prior(theta, k), log_prior(beta, k), log_conditional(theta, k), log_conditional(beta, k),
             gamma_entropy(theta, k), gamma_entropy(beta, k), data_term(theta, beta, k), aux_entropy(nz)]
    return reduce(DataFrame.unionByName, parts).groupBy("seed").agg(F.sum("value").alias("elbo"))


# --- fit --------------------------------------------------------------------------------------

_STATE = T.StructType([
    T.StructField("kind", T.ByteType()), T.StructField("seed", T.IntegerType()), T.StructField("id", T.LongType()),
    T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("val", T.ArrayType(T.DoubleType())),
    T.StructField("shape", T.ArrayType(T.DoubleType())), T.StructField("rate", T.ArrayType(T.DoubleType())),
    T.StructField("prior_rate", T.DoubleType())])


class Fit:
    """Result of a fit: ``theta`` and ``beta`` tables and ``bounds`` (seed, step, elbo)."""

    def __init__(self, theta: DataFrame, beta: DataFrame, bounds: DataFrame):
        self.theta, self.beta, self.bounds = theta, beta, bounds


class Store:
    """Snapshots of one fit: the factor tables after a step, whole or absent (see :mod:`..plans.versions`)."""

    def __init__(self, spark: SparkSession, path: str, counts: DataFrame, num_terms: int, k: int, seeds: Sequence[int], every: int):
        got = counts.agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc_id", "term_id", "cnt").cast("decimal(38,0)")).alias("s")).first()
        self.fit = {"terms": num_terms, "topics": k, "seeds": list(seeds), "counts": [got.n, str(got.s)]}
        self.versions, self.every = Versions(spark, f"{path}/topics-{k}-seeds-{'-'.join(map(str, seeds))}"), every

    def latest(self) -> Version | None:
        """The last whole step of this very fit; snapshots of another one raise."""
        found = self.versions.latest()
        if found and found.about["fit"] != self.fit:
            raise ValueError(f"the snapshots below {self.versions.path} belong to another fit: {found.about['fit']} instead of {self.fit}")
        return found

    def save(self, step: int, theta: DataFrame, beta: DataFrame, bounds: list) -> None:
        self.versions.publish({"theta": theta, "beta": beta}, {"fit": self.fit, "step": step, "bounds": bounds}, number=step)


def fit(counts: DataFrame, num_terms: int, num_topics: int = 50, seeds: Sequence[int] = DEFAULT_SEEDS, steps: int = 300,
        elbo_every: int = 50, checkpoint_every: int = 10, broadcast_limit: int = BROADCAST_LIMIT, store: str | None = None,
        store_every: int = 50, on_step: Callable[[int], None] | None = None) -> Fit:
    """Fit all seeds; the bound is taken every ``elbo_every`` steps and at the last one.

    Document state stays partitioned and cached; every ``checkpoint_every`` steps it goes to the shared
    checkpoint folder, so a lost executor recomputes a few steps at most. With ``store``, a folder that
    outlives the session, the factors are kept every ``store_every`` steps and after the last one, and a
    fit that finds snapshots of its own there goes on from the last of them. ``on_step`` is told every
    step that is done.
    """
    spark = counts.sparkSession
    per_seed = num_terms * num_topics * 8
    done = on_step or (lambda step: None)
    kept = lambda group: Store(spark, store, counts, num_terms, num_topics, group, store_every) if store else None
    if per_seed > broadcast_limit:
        return _fit_relational(counts, num_terms, num_topics, seeds, steps, elbo_every, checkpoint_every, kept(seeds), done)
    width = max(1, broadcast_limit // per_seed)
    packed = packed_docs(by_key(counts, "doc_id")).persist(StorageLevel.MEMORY_AND_DISK)
    groups = [list(seeds[i:i + width]) for i in range(0, len(seeds), width)]
    fits = [_fit_packed(spark, packed, num_terms, num_topics, g, steps, elbo_every, checkpoint_every, kept(g), done) for g in groups]
    packed.unpersist()
    return Fit(*[reduce(DataFrame.unionByName, [getattr(f, part) for f in fits]) for part in ("theta", "beta", "bounds")])


class SeedsFailed(RuntimeError):
    """Some seeds of :func:`fit_seeds` failed; ``failures`` has the error of each, ``fits`` the others' results."""

    def __init__(self, failures: dict[int, Exception], fits: dict[int, Fit]):
        super().__init__(f"factorisation failed for seeds {', '.join(map(str, failures))}")
        self.failures, self.fits = failures, fits


def fit_seeds(counts: DataFrame, num_terms: int, num_topics: int = 50, seeds: Sequence[int] = DEFAULT_SEEDS, steps: int = 300,
              store: str | None = None, parallel: int = 2, **settings) -> dict[int, Fit]:
    """Fit every seed by itself, at most ``parallel`` at once; further ``settings`` as for :func:`fit`.

    Each seed's jobs form a group in a scheduler pool of their own, so seeds share the cluster evenly under
    the fair scheduler. A seed that fails does not stop the others; failures are raised together at the
    end. With ``store``, seeds go on from their last snapshot, and those that are finished are only read.
    """
    from pyspark import inheritable_thread_target

    spark = counts.sparkSession
    fits: dict[int, Fit] = {}
    failures: dict[int, Exception] = {}

    def one(seed: int) -> None:
        sc = spark.sparkContext
        sc.setJobGroup(f"factorisation-seed-{seed}", f"factorisation, seed {seed}", interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", f"seed-{seed}")
        try:
            fits[seed] = fit(counts, num_terms, num_topics, [seed], steps, store=store, **settings)
        except Exception as e:
            failures[seed] = e
            sc.cancelJobGroup(f"factorisation-seed-{seed}")

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(one), s) for s in dict.fromkeys(seeds)]:
            running.result()
    if failures:
        raise SeedsFailed({s: failures[s] for s in seeds if s in failures}, fits)
    return fits


def _terms(spark: SparkSession, num_terms: int) -> DataFrame:
    return spark.range(num_terms).withColumnRenamed("id", "term_id")


def _term_arrays(beta: DataFrame, seeds: list[int], num_terms: int, k: int):
    """Term factors as arrays; their size was checked against the broadcast limit."""
    rows = beta.select("seed", "term_id", "shape", "rate", "prior_rate").toArrow()
    slot = {s: i for i, s in enumerate(seeds)}
    at = np.array([slot[s] for s in rows["seed"].to_pylist()]) * num_terms + rows["term_id"].to_numpy()
    flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in rows[c].chunks]).reshape(-1, k)
    shape, rate = np.empty((len(seeds) * num_terms, k)), np.empty((len(seeds) * num_terms, k))
    prior = np.empty(len(seeds) * num_terms)
    shape[at], rate[at], prior[at] = flat("shape"), flat("rate"), rows["prior_rate"].to_numpy()
    return shape, rate, prior


def _fit_packed(spark, packed, num_terms, k, seeds, steps, elbo_every, checkpoint_every, store, done) -> Fit:
    work_dir(spark)
    s0 = prior_shape(k)
    slot = {s: i for i, s in enumerate(seeds)}
    per_seed = lambda m: m.reshape(len(seeds), num_terms, k)
    old = store.latest() if store else None
    if old:
        begin = packed.withColumnRenamed("doc_id", "id").join(old.read(spark, "theta").withColumnRenamed("doc_id", "id"), "id")
        topics, bounds, first = old.read(spark, "beta"), [tuple(x) for x in old.about["bounds"]], old.about["step"] + 1
    else:
        begin = init_state(packed.withColumnRenamed("doc_id", "id"), "id", "document", seeds, k)
        topics, bounds, first = init_state(_terms(spark, num_terms), "term_id", "topic", seeds, k), [], 0
    state = begin.select(F.lit(0).cast("tinyint").alias("kind"), *_STATE.fieldNames()[1:]).persist(StorageLevel.MEMORY_AND_DISK)
    shape, rate, prior = _term_arrays(topics, seeds, num_terms, k)
    schema = to_arrow_schema(_STATE)
    held = []
    for step in range(first, steps):
        with_elbo = step % elbo_every == 0 or step == steps - 1
        geo = np.exp(kernels.digamma(shape)) / rate
        bc = spark.sparkContext.broadcast((geo, per_seed(shape / rate).sum(axis=1)))

        def run(batches, bc=bc, with_elbo=with_elbo):
            g, topic_sum = bc.value
            yield from kernels.doc_update(batches, g, topic_sum, slot, k, PRIOR, PRIOR, s0, schema, with_elbo)

        new = state.filter("kind = 0").mapInArrow(run, _STATE).persist(StorageLevel.MEMORY_AND_DISK)
        sums = (new.filter("kind > 0").groupBy("kind", "seed", "id")
                .agg(*[F.sum(F.get("shape", F.lit(i))).alias(f"v{i}") for i in range(k + 2)]))
        got = sums.toArrow()
        v = np.column_stack([got[f"v{i}"].to_numpy() for i in range(k + 2)]) if got.num_rows else np.zeros((0, k + 2))
        kind, at_seed = got["kind"].to_numpy(), np.array([slot[s] for s in got["seed"].to_pylist()])
        term = kind == 1
        msg = np.zeros_like(shape)
        msg[(at_seed * num_terms + got["id"].to_numpy())[term]] = v[term][:, :k]
        totals = np.zeros((len(seeds), k + 2))
        totals[at_seed[~term]] = v[~term]
        shape = PRIOR + geo * msg
        rate = (s0 / prior)[:, None] + np.repeat(totals[:, :k], num_terms, axis=0)
        prior = PRIOR + (shape / rate).sum(axis=1)
        if with_elbo:
            topic_sum = per_seed(shape / rate).sum(axis=1)
            for s, j in slot.items():
                part = slice(j * num_terms, (j + 1) * num_terms)
                value = (kernels.factor_elbo(shape[part], rate[part], prior[part], PRIOR, PRIOR, PRIOR, s0)
                         - float(totals[j, :k] @ topic_sum[j]) + totals[j, k] + totals[j, k + 1])
                bounds.append((s, step, float(value)))
        held.append(bc)
        last = step == steps - 1
        if last or (step + 1) % checkpoint_every == 0:
            saved = new.filter("kind = 0").checkpoint()
            state.unpersist()
            new.unpersist()
            for b in held:
                b.unpersist()
            held, state = [], saved
        else:
            state.unpersist()
            state = new
        if store and (last or step % store.every == 0):
            store.save(step, _documents(state), _beta_table(spark, seeds, num_terms, shape, rate, prior), bounds)
        done(step)
    return Fit(_documents(state), _beta_table(spark, seeds, num_terms, shape, rate, prior),
               spark.createDataFrame(bounds, "seed int, step int, elbo double"))


def _documents(state: DataFrame) -> DataFrame:
    return state.filter("kind = 0").select("seed", F.col("id").alias("doc_id"), "shape", "rate", "prior_rate")


def _beta_table(spark, seeds, num_terms, shape, rate, prior) -> DataFrame:
    import pyarrow as pa

    k = shape.shape[1]
    offs = pa.array(np.arange(len(shape) + 1, dtype=np.int32) * k)
    table = pa.table({
        "seed": pa.array(np.repeat(np.array(seeds, dtype=np.int32), num_terms)),
        "term_id": pa.array(np.tile(np.arange(num_terms, dtype=np.int64), len(seeds))),
        "shape": pa.ListArray.from_arrays(offs, pa.array(shape.ravel())),
        "rate": pa.ListArray.from_arrays(offs, pa.array(rate.ravel())),
        "prior_rate": pa.array(prior)})
    return spark.createDataFrame(table)


def _fit_relational(counts, num_terms, k, seeds, steps, elbo_every, checkpoint_every, store, done) -> Fit:
    spark = counts.sparkSession
    work_dir(spark)
    keep = StorageLevel.MEMORY_AND_DISK
    old = store.latest() if store else None
    if old:
        theta, beta, bounds, first = old.read(spark, "theta"), old.read(spark, "beta"), [tuple(x) for x in old.about["bounds"]], old.about["step"] + 1
    else:
        columns = ("shape", "rate", "prior_rate")
        theta = init_state(counts.select("doc_id").distinct(), "doc_id", "document", seeds, k).select("seed", "doc_id", *columns)
        beta = init_state(_terms(spark, num_terms), "term_id", "topic", seeds, k).select("seed", "term_id", *columns)
        bounds, first = [], 0
    theta, beta = theta.persist(keep), beta.persist(keep)
    for step in range(first, steps):
        nz = with_normalizer(counts, theta, beta).persist(keep)
        new_theta = doc_step(nz, theta, beta, k).persist(keep)
        new_beta = topic_step(nz, beta, new_theta, k).persist(keep)
        last = step == steps - 1
        if last or (step + 1) % checkpoint_every == 0:
            new_theta, new_beta = new_theta.checkpoint(), new_beta.checkpoint()
        else:
            new_beta.count()
        if step % elbo_every == 0 or last:  # one number for each seed
            bounds += [(x.seed, step, x.elbo) for x in elbo(nz, new_theta, new_beta, k).collect()]
        for before in (nz, theta, beta):
            before.unpersist()
        theta, beta = new_theta, new_beta
        if store and (last or step % store.every == 0):
            store.save(step, theta, beta, bounds)
        done(step)
    return Fit(theta, beta, spark.createDataFrame(bounds, "seed int, step int, elbo double"))
