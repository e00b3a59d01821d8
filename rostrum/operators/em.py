"""Latent Dirichlet allocation by expectation-maximisation over documents in parts.

The updates are those of the optimiser in ``pyspark.ml``: every count is dealt to the topics by

    (n_wk + beta) (n_dk + alpha_k) / (n_k + V beta)

and the shares are summed by document and by term. There a graph with one edge per count is held in memory, and what
does not fit is worked out again from its lineage in every step. Here a step reads written tables: each part of the
documents gets the rows of its own terms (see :mod:`.parts`) and sends back sums by term; the tables of the step
before are removed. First shares are hashes of (seed, document, place), so a fit does not depend on partitions.

Tables: ``state(kind, part, id, idx, val, vec)``, kind 0 a document with its topic counts, kind 1 a term's sums of one
part; ``topics(term_id, lam)`` with the counts of a term by topic. Only vectors of K numbers pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws, kernels
from ..plans.stage import remove, written
from .factorization import _vector_sum
from .parts import PART_CELLS, Parts, in_parts
from .variational import OnlineFit, _vectors, totals

cloudpickle.register_pickle_by_value(draws)
cloudpickle.register_pickle_by_value(kernels)

STATE = "kind tinyint, part int, id long, idx array<int>, val array<double>, vec array<double>"


@dataclass(frozen=True)
class EMFit(OnlineFit):
    """``topics(term_id, lam)``, the counts of the terms that occur, and the document prior plus one, as inference takes it."""

    num_terms: int = 0

    def topic_weights(self) -> DataFrame:
        """``(topic_id, term_id, weight)`` for every topic and term; terms without any count get weight 0."""
        k = len(self.alpha)
        every = (self.topics.sparkSession.range(self.num_terms).withColumnRenamed("id", "term_id")
                 .withColumn("topic_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))))
        return every.join(super().topic_weights(), ["topic_id", "term_id"], "left").select(
            "topic_id", "term_id", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def _rows(part: pa.Array, ids: pa.Array, idx: pa.Array, val: pa.Array, vec: np.ndarray, known: np.ndarray, sums: np.ndarray) -> pa.Table:
    names = ["kind", "part", "id", "idx", "val", "vec"]
    docs = [pa.array(np.zeros(len(ids), np.int8)), part.cast(pa.int32()), ids.cast(pa.int64()), idx.cast(pa.list_(pa.int32())), val.cast(pa.list_(pa.float64())), _vectors(vec)]
    size = len(known)
    terms = [pa.array(np.ones(size, np.int8)), pa.nulls(size, pa.int32()), pa.array(known.astype(np.int64)),
             pa.nulls(size, pa.list_(pa.int32())), pa.nulls(size, pa.list_(pa.float64())), _vectors(sums)]
    return pa.concat_tables([pa.Table.from_arrays(x, names) for x in (docs, terms)])


def start(parts: Parts, num_topics: int, seed: int) -> DataFrame:
    """Every count with random shares, as rows of ``STATE``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ids, idx, val = batch.columns
            sizes = np.diff(idx.offsets.to_numpy()).astype(np.int64)
            known, at = np.unique(idx.flatten().to_numpy(), return_inverse=True)
            share = kernels.first_shares(ids.fill_null(-1).to_numpy(), sizes, num_topics, lambda j, d, p: draws.uniform(seed, j, d, p))
            by_doc, by_term = kernels.share_sums(share, val.flatten().to_numpy(), at, sizes, len(known))
            yield from _rows(part, ids, idx, val, by_doc, known, by_term).to_batches()

    return parts.docs.select("part", "doc_id", "idx", "val").mapInArrow(deal, STATE)


def one_pass(parts: Parts, state: DataFrame, topics: DataFrame, sums: Sequence[float], alpha: float, beta: float, num_terms: int) -> DataFrame:
    """Rows of ``STATE`` after one step from a state, its topics and their sums."""
    whole = np.array(sums) + num_terms * beta

    def deal(docs: pa.Table, rows: pa.Table) -> pa.Table:
        docs, rows = docs.combine_chunks(), rows.combine_chunks()
        k = len(whole)
        if not docs.num_rows:
            none, lists = pa.array([], pa.int64()), [pa.array([], pa.list_(t)) for t in (pa.int32(), pa.float64())]
            return _rows(none, none, *lists, np.zeros((0, k)), np.zeros(0, np.int64), np.zeros((0, k)))
        known = rows["term_id"].to_numpy()
        order = np.argsort(known)
        known, table = known[order], rows["lam"].chunk(0).flatten().to_numpy().reshape(-1, k)[order]
        idx, val, vec = (docs[c].chunk(0) for c in ("idx", "val", "vec"))
        sizes = np.diff(idx.offsets.to_numpy()).astype(np.int64)
        at = np.searchsorted(known, idx.flatten().to_numpy())
        by_doc, by_term = kernels.em_step(at, val.flatten().to_numpy(), sizes, vec.flatten().to_numpy().reshape(-1, k) + alpha, (table + beta) / whole)
        return _rows(docs["part"].chunk(0), docs["id"].chunk(0), idx, val, by_doc, known, by_term)

    return parts.meet(state.filter("kind = 0").select("part", "id", "idx", "val", "vec"), topics, deal, STATE)


def _topics(state: DataFrame, k: int) -> tuple[DataFrame, str]:
    return written(state.filter("kind = 1").groupBy(F.col("id").alias("term_id")).agg(_vector_sum("vec", k).alias("lam")), "em-topics")


def fit(counts: DataFrame, num_terms: int, num_topics: int, seed: int = 42, iterations: int = 50, alpha: float | None = None,
        beta: float | None = None, part_cells: int = PART_CELLS) -> EMFit:
    """Fit the topics of ``counts(doc_id, term_id, cnt)``. ``alpha`` is the sum of the document prior over topics and
    ``beta`` the prior of a term; without them they are 50 and 0.1, as in :func:`.lda.fit_em`."""
    alpha, beta = (50.0 if alpha is None else alpha) / num_topics, 0.1 if beta is None else beta
    parts = in_parts(counts, part_cells)
    state, state_at = written(start(parts, num_topics, seed), "em-state")
    topics, topics_at = _topics(state, num_topics)
    for _ in range(iterations):
        new, new_at = written(one_pass(parts, state, topics, totals(topics, num_topics), alpha, beta, num_terms), "em-state")
        after, after_at = _topics(new, num_topics)
        for path in (state_at, topics_at):
            remove(topics.sparkSession, path)
        state, state_at, topics, topics_at = new, new_at, after, after_at
    return EMFit(topics, [1.0 + alpha] * num_topics, num_terms)
