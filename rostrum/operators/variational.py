"""Online variational Bayes for latent Dirichlet allocation, with the topics in a table cut by term.

``topics(term_id, lam array)`` holds the variational parameter of the topics, one row of K numbers per term.
A step takes one batch of documents, sends each part of it the rows of its own terms (see :mod:`.parts`),
fits the documents' mixtures there, and gets back sums by term; the topics move towards those sums by a
falling rate. Only vectors of K numbers pass through the driver.

The same fit of mixtures with fixed topics is the inference for unseen documents, :func:`fold_in`. Each
document stops when its own parameter has settled; the others go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.special import array_sum, digamma
from ..plans.stage import remove, stage, written
from .factorization import _noise, _vector_sum
from .parts import PART_CELLS, Parts, in_parts

cloudpickle.register_pickle_by_value(kernels)

#: kind 0: a document's parameter and the number of its rounds; 1: a term's share of the batch's sums.
ROWS = "kind tinyint, id long, vec array<double>, rounds int"


@dataclass(frozen=True)
class Online:
    num_topics: int = 50
    #: Document prior: a number for every topic, ``symmetric`` (1/K), ``asymmetric`` (falling) or ``auto`` (learned).
    alpha: float | str = "symmetric"
    #: Topic prior: a number for every term or ``symmetric`` (1/K).
    eta: float | str = "symmetric"
    decay: float = 0.5
    offset: float = 1.0
    passes: int = 1
    batches: int = 20
    iterations: int = 50
    tolerance: float = 1e-3


def priors(rules: Online) -> tuple[list[float], float]:
    k = rules.num_topics
    falling = [1.0 / (i + k ** 0.5) for i in range(k)]
    named = {"symmetric": [1.0 / k] * k, "auto": [1.0 / k] * k, "asymmetric": [x / sum(falling) for x in falling]}
    if isinstance(rules.alpha, str) and rules.alpha not in named or isinstance(rules.eta, str) and rules.eta != "symmetric":
        raise ValueError(f"priors not supported: alpha={rules.alpha!r}, eta={rules.eta!r}")
    return (named[rules.alpha] if isinstance(rules.alpha, str) else [float(rules.alpha)] * k,
            1.0 / k if isinstance(rules.eta, str) else float(rules.eta))


@dataclass(frozen=True)
class OnlineFit:
    """``topics(term_id, lam)`` and the document prior."""

    topics: DataFrame
    alpha: list[float]

    def topic_weights(self) -> DataFrame:
        """``(topic_id, term_id, weight)`` for every topic and term; each topic's weights sum to one."""
        sums = totals(self.topics, len(self.alpha))
        share = F.zip_with("lam", F.array(*[F.lit(x) for x in sums]), lambda a, b: a / b)
        return self.topics.select("term_id", F.posexplode(share).alias("topic_id", "weight")).select("topic_id", "term_id", "weight")

    def doc_topics(self, counts: DataFrame, rules: Online = Online()) -> DataFrame:
        """``(doc_id, theta, rounds)`` of any documents over the same terms."""
        return fold_in(counts, expected(self.topics, len(self.alpha)), self.alpha, rules.iterations, rules.tolerance)


def start(spark: SparkSession, num_terms: int, num_topics: int, seed: int) -> DataFrame:
    """Parameters around one, from hashes of seed, term and topic."""
    ks = F.sequence(F.lit(0), F.lit(num_topics - 1))
    return spark.range(num_terms).select(F.col("id").alias("term_id"), F.transform(ks, lambda k: _noise(F.lit(seed), "lambda", F.col("id"), k)).alias("lam"))


def totals(topics: DataFrame, k: int) -> list[float]:
    return topics.agg(_vector_sum("lam", k).alias("s")).first().s


def expected(topics: DataFrame, k: int) -> DataFrame:
    """``(term_id, beta)``: exp of the expected log weight of the term in each topic."""
    whole = F.array(*[digamma(F.lit(x)) for x in totals(topics, k)])
    return topics.select("term_id", F.zip_with("lam", whole, lambda x, s: F.exp(digamma(x) - s)).alias("beta"))


def _vectors(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def mixtures(parts: Parts, beta: DataFrame, alpha: Sequence[float], iterations: int, tolerance: float, batch: int | None = None, sums: bool = False) -> DataFrame:
    """``ROWS`` of one batch (of all documents without one): every document's parameter and, on request, sums by term."""
    prior = np.array(alpha)

    def work(docs: pa.Table, rows: pa.Table) -> pa.Table:
        docs, rows = docs.combine_chunks(), rows.combine_chunks()
        if not docs.num_rows or not rows.num_rows:  # none of the terms has topics: the prior stands
            gamma, rounds = np.tile(prior, (docs.num_rows, 1)), np.zeros(docs.num_rows)
            known, found = np.zeros(0, np.int64), np.zeros((0, len(prior)))
        else:
            known = rows["term_id"].to_numpy()
            order = np.argsort(known)
            known, table = known[order], rows["beta"].chunk(0).flatten().to_numpy().reshape(-1, len(prior))[order]
            idx, val = docs["idx"].chunk(0), docs["val"].chunk(0)
            terms, sizes = idx.flatten().to_numpy(), np.diff(idx.offsets.to_numpy()).astype(np.int64)
            at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
            cnt = np.where(known[at] == terms, val.flatten().to_numpy(), 0.0)  # terms without topics say nothing
            gamma, rounds, found = kernels.fit_mixtures(at, cnt, sizes, table, prior, iterations, tolerance, sums)
        ids = docs["doc_id"].chunk(0) if docs.num_rows else pa.array([], pa.int64())  # may hold a null
        out = [(0, ids, gamma, rounds)] + ([(1, pa.array(known), found, np.zeros(len(known)))] if sums else [])
        return pa.concat_tables([pa.Table.from_arrays(
            [pa.array(np.full(len(i), kind, np.int8)), i.cast(pa.int64()), _vectors(v), pa.array(r.astype(np.int32))], ["kind", "id", "vec", "rounds"])
            for kind, i, v, r in out])

    docs = parts.docs if batch is None else parts.docs.filter(F.col("batch") == batch)
    return parts.meet(docs.select("part", "doc_id", "idx", "val"), beta, work, ROWS, batch)


def fold_in(counts: DataFrame, beta: DataFrame, alpha: Sequence[float], iterations: int = 50, tolerance: float = 1e-3, part_cells: int = PART_CELLS) -> DataFrame:
    """``(doc_id, theta, rounds)``: mixtures of the documents of ``counts`` with the topics ``beta(term_id, beta)`` fixed.

    A document stops once its parameter moves by less than ``tolerance`` per topic; ``rounds`` says when. Terms
    that the topics do not know say nothing about a document; one without any known term has the prior's mean.
    """
    rows = mixtures(in_parts(counts, part_cells), beta, alpha, iterations, tolerance)
    whole = array_sum(F.col("vec"))
    return rows.select(F.col("id").alias("doc_id"), F.transform("vec", lambda x: x / whole).alias("theta"), "rounds")


def step(parts: Parts, topics: DataFrame, alpha: Sequence[float], eta: float, rate: float, rules: Online, batch: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The topics after one batch, the batch's ``ROWS``, and the paths of both (written) tables."""
    k = rules.num_topics
    rows, at = written(mixtures(parts, expected(topics, k), alpha, rules.iterations, rules.tolerance, batch, True), "online-batch")
    found = rows.filter("kind = 1").groupBy(F.col("id").alias("term_id")).agg(_vector_sum("vec", k).alias("sums"))
    here = rows.filter("kind = 0").count()
    if not here:
        return topics, rows, [at]
    scale = parts.docs.count() / here
    none = F.array(*[F.lit(0.0)] * k)
    moved = topics.join(found, "term_id", "left").select("term_id", F.zip_with(
        "lam", F.coalesce("sums", none), lambda x, s: F.lit(1 - rate) * x + F.lit(rate) * (F.lit(eta) + F.lit(scale) * s)).alias("lam"))
    new, new_at = written(moved, "online-topics")
    return new, rows, [at, new_at]


def learn_prior(alpha: Sequence[float], rows: DataFrame, rate: float) -> list[float]:
    """One damped Newton step for the document prior, from the mean expected log mixtures of a batch."""
    k = len(alpha)
    whole = digamma(array_sum(F.col("vec")))
    logs = rows.filter("kind = 0").select(F.transform("vec", lambda x: digamma(x) - whole).alias("v"))
    got = logs.agg(F.count("*").alias("n"), *[F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
    if not got.n:
        return list(alpha)
    a, mean = np.array(alpha), np.array([got[f"m{i}"] for i in range(k)])
    gradient = kernels.digamma(np.array(a.sum())) - kernels.digamma(a) + mean
    # the Hessian is a diagonal plus a constant, so Newton's direction takes O(K)
    diagonal, constant = -kernels.trigamma(a), kernels.trigamma(np.array(a.sum()))
    b = (gradient / diagonal).sum() / (1 / constant + (1 / diagonal).sum())
    moved = a - rate * (gradient - b) / diagonal
    return moved.tolist() if (moved > 0).all() else list(alpha)


def fit(counts: DataFrame, num_terms: int, rules: Online = Online(), seed: int = 42, part_cells: int = PART_CELLS) -> OnlineFit:
    """Fit the topics of ``counts(doc_id, term_id, cnt)``; each step's tables are written, those before removed."""
    spark = counts.sparkSession
    alpha, eta = priors(rules)
    parts = in_parts(counts, part_cells, rules.batches)
    topics, old = stage(start(spark, num_terms, rules.num_topics, seed), "online-topics"), []
    for number in range(rules.passes * rules.batches):
        rate = (rules.offset + number) ** -rules.decay
        topics, rows, paths = step(parts, topics, alpha, eta, rate, rules, number % rules.batches)
        if rules.alpha == "auto":
            alpha = learn_prior(alpha, rows, rate)
        if len(paths) == 2:  # else the batch was empty and the topics before stay
            for path in old:
                remove(spark, path)
            old = paths
    return OnlineFit(topics, alpha)


def by_term(weights: DataFrame) -> DataFrame:
    """``(term_id, beta)`` for :func:`fold_in`, from ``(topic_id, term_id, weight)`` with every topic present."""
    each = weights.groupBy("term_id").agg(F.sort_array(F.collect_list(F.struct("topic_id", "weight"))).alias("x"))
    return each.select("term_id", F.transform("x", lambda x: x["weight"]).alias("beta"))
