"""Latent Dirichlet allocation by collapsed Gibbs sampling over partitioned documents.

The state is the topic of every token. A pass draws each token's topic anew, in the order of a document's
places, from

    (n_dk + alpha_k) (n_wk + beta) / (n_k + V beta)

with the token itself taken out. A document sees the term-topic counts of the pass's start and its own
changes since; the changes of all documents are summed by term after the pass and make the counts of the
next one. Draws are hashes of (seed, pass, document, place), so a fit is the same on every partitioning and
after any loss of executors. Documents of a part are drawn in step, place by place, as numpy arrays.

Tables: ``state(part, doc_id, terms, topics)`` with one entry per token, ``counts(term_id, topic, n)`` with
counts above zero. Each part gets the counts of its own terms only (see :mod:`.parts`); only vectors of K
numbers pass through the driver. The document prior is fitted every ``optimize_every`` passes by Minka's
fixed point on histograms of the documents' topic counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.special import digamma
from ..plans.stage import remove, stage, written
from .parts import PART_CELLS, Parts, in_parts
from .topics import top_terms

cloudpickle.register_pickle_by_value(draws)

#: kind 0: a document; 1: changes (term, topic, number) of a part; 2: documents of a part by (topic, tokens);
#: topic K stands for all of a document's tokens.
STATE = "kind tinyint, part int, doc_id long, terms array<int>, topics array<int>, n array<long>"


@dataclass(frozen=True)
class Sampler:
    num_topics: int = 50
    #: Sum of the document prior over topics, and prior of a term.
    alpha: float = 5.0
    beta: float = 0.01
    passes: int = 1000
    optimize_every: int = 10
    burn_in: int = 200
    #: Fixed-point steps of each fit of the prior.
    prior_steps: int = 3
    #: Passes between two snapshots of the topics' first terms (0: none), and the number of those.
    topics_every: int = 0
    topic_words: int = 20


@dataclass(frozen=True)
class GibbsFit:
    """``state`` and ``counts`` after the last pass, the fitted prior, and the number of terms."""

    state: DataFrame
    counts: DataFrame
    alpha: list[float]
    beta: float
    num_terms: int
    #: ``(step, topic_id, rank, term_id)`` of the snapshots, for :func:`..topics.best_snapshot`.
    snapshots: DataFrame | None = None

    def topic_weights(self) -> DataFrame:
        """``(topic_id, term_id, weight)`` for every topic and term; each topic's weights sum to one."""
        spark, k = self.counts.sparkSession, len(self.alpha)
        every = spark.range(self.num_terms).withColumnRenamed("id", "term_id").withColumn("topic_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        own = self.counts.select(F.col("term_id").cast("bigint").alias("term_id"), F.col("topic").alias("topic_id"), "n")
        total = F.array(*[F.lit(float(x)) for x in _totals(self.counts, k)])
        n = F.coalesce("n", F.lit(0)) + F.lit(self.beta)
        return every.join(own, ["term_id", "topic_id"], "left").select(
            "topic_id", "term_id", (n / (F.get(total, F.col("topic_id")) + F.lit(self.num_terms * self.beta))).alias("weight"))

    def doc_topics(self) -> DataFrame:
        """``(doc_id, theta array)``: smoothed shares of each document's tokens."""
        of = lambda i: F.size(F.filter("topics", lambda t: t == F.lit(i)))
        held = [of(i) + F.lit(a) for i, a in enumerate(self.alpha)]
        whole = F.size("topics") + F.lit(float(sum(self.alpha)))
        return self.state.select("doc_id", F.array(*[x / whole for x in held]).alias("theta"))


def _totals(counts: DataFrame, k: int) -> list[int]:
    found = {r.topic: r.n for r in counts.groupBy("topic").agg(F.sum("n").alias("n")).collect()}
    return [found.get(i, 0) for i in range(k)]


def _lists(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)).cast(kind))


def _rows(kind: int, part: int, ids, terms, topics, n) -> pa.Table:
    size = len(terms)
    columns = [pa.array([kind] * size, pa.int8()), pa.array([part] * size, pa.int32()), pa.array(ids, pa.int64()),
               _lists(terms, pa.int32()), _lists(topics, pa.int32()), pa.nulls(size, pa.list_(pa.int64())) if n is None else _lists(n, pa.int64())]
    return pa.Table.from_arrays(columns, ["kind", "part", "doc_id", "terms", "topics", "n"])


def start(parts: Parts, num_topics: int, seed: int) -> DataFrame:
    """Every token with a random topic; tokens of a document are ordered by term."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            terms, topics = [], []
            for doc, idx, val in zip(ids, batch.column(2), batch.column(3)):
                own = np.repeat(idx.values.to_numpy(zero_copy_only=False), val.values.to_numpy(zero_copy_only=False).astype(np.int64))
                order = np.argsort(own, kind="stable")
                terms.append(own[order])
                topics.append((draws.uniform(seed, 0, np.full(len(own), doc), np.arange(len(own))) * num_topics).astype(np.int64))
            out = pa.concat_tables([_rows(0, 0, ids, terms, topics, None)])
            yield from out.set_column(1, "part", pa.array(part, pa.int32())).to_batches()

    return parts.docs.select("part", "doc_id", "idx", "val").mapInArrow(deal, STATE)


def one_pass(parts: Parts, state: DataFrame, counts: DataFrame, totals: Sequence[int], alpha: Sequence[float], beta: float, num_terms: int,
             seed: int, number: int, histogram: bool = False) -> DataFrame:
    """Rows of ``STATE`` after pass ``number``: new documents, the changes by term, and histograms if asked for."""
    k, n_k, prior = len(alpha), np.array(totals, np.int64), np.array(alpha)

    def draw(docs: pa.Table, rows: pa.Table) -> pa.Table:
        docs, rows = docs.combine_chunks(), rows.combine_chunks()
        if not docs.num_rows:
            return _rows(0, 0, [], [], [], None)
        part = docs["part"][0].as_py()
        known, at = np.unique(rows["term_id"].to_numpy(), return_inverse=True)
        n_wk = np.zeros((len(known), k), np.int64)
        n_wk[at, rows["topic"].to_numpy()] = rows["n"].to_numpy()
        lists = [docs[c].chunk(0) for c in ("terms", "topics")]
        terms, old = (x.flatten().to_numpy() for x in lists)
        sizes = np.diff(lists[0].offsets.to_numpy()).astype(np.int64)
        ids = docs["doc_id"].to_numpy()
        new, n_dk = draws.sweep(np.searchsorted(known, terms), old.astype(np.int64), sizes, ids, n_wk, n_k, prior, beta, num_terms, seed, number)
        cuts = np.cumsum(sizes)[:-1]
        out = [_rows(0, part, ids, np.split(terms, cuts), np.split(new, cuts), None)]
        moved = np.zeros_like(n_wk)
        np.add.at(moved, (np.searchsorted(known, terms), new), 1)
        np.subtract.at(moved, (np.searchsorted(known, terms), old), 1)
        w, t = np.nonzero(moved)
        out.append(_rows(1, part, [None], [known[w]], [t], [moved[w, t]]))
        if histogram:
            pairs = np.concatenate([np.column_stack([np.tile(np.arange(k), len(sizes)), n_dk.ravel()]), np.column_stack([np.full(len(sizes), k), sizes])])
            seen, docs_of = np.unique(pairs[pairs[:, 1] > 0], axis=0, return_counts=True)
            out.append(_rows(2, part, [None], [seen[:, 1]], [seen[:, 0]], [docs_of]))
        return pa.concat_tables(out)

    return parts.meet(state.filter("kind = 0").select("part", "doc_id", "terms", "topics"), counts, draw, STATE)


def _listed(state: DataFrame, kind: int) -> DataFrame:
    return state.filter(F.col("kind") == kind).select(F.explode(F.arrays_zip("terms", "topics", "n")).alias("x")).select("x.*")


def count_tokens(state: DataFrame) -> DataFrame:
    """``(term_id, topic, n)`` of the tokens of a state."""
    pairs = state.filter("kind = 0").select(F.explode(F.arrays_zip("terms", "topics")).alias("x"))
    return pairs.groupBy(F.col("x.terms").alias("term_id"), F.col("x.topics").alias("topic")).agg(F.count("*").alias("n"))


def apply_changes(counts: DataFrame, state: DataFrame) -> DataFrame:
    """The counts after a pass, from those before and the parts' changes, summed by term and topic."""
    moved = _listed(state, 1).select(F.col("terms").alias("term_id"), F.col("topics").alias("topic"), "n")
    return counts.unionByName(moved).groupBy("term_id", "topic").agg(F.sum("n").alias("n")).filter("n > 0")


def fit_prior(alpha: Sequence[float], histogram: DataFrame, steps: int = 1) -> list[float]:
    """Minka's fixed point for an asymmetric Dirichlet prior, from ``(topic, size, docs)``; topic K holds whole documents.

    Only one sum per topic comes back from each step.
    """
    alpha, k = list(alpha), len(alpha)
    for _ in range(steps):
        own = F.get(F.array(*[F.lit(float(a)) for a in [*alpha, sum(alpha)]]), F.col("topic"))
        gain = F.col("docs") * (digamma(F.col("size") + own) - digamma(own))
        sums = {r.topic: r.s for r in histogram.groupBy("topic").agg(F.sum(gain).alias("s")).collect()}
        if not sums.get(k):
            break
        alpha = [max(a * sums.get(i, 0.0) / sums[k], 1e-6) for i, a in enumerate(alpha)]
    return alpha


def fit(counts: DataFrame, num_terms: int, rules: Sampler = Sampler(), seed: int = 42, part_cells: int = PART_CELLS) -> GibbsFit:
    """Sample the topics of ``counts(doc_id, term_id, cnt)``. Each pass is written; that before the last is removed."""
    spark, k = counts.sparkSession, rules.num_topics
    parts = in_parts(counts, part_cells)
    alpha = [rules.alpha / k] * k
    state, state_at = written(start(parts, k, seed), "gibbs-state")
    table, table_at = written(count_tokens(state), "gibbs-counts")
    totals, seen = _totals(table, k), []
    for number in range(1, rules.passes + 1):
        tune = rules.optimize_every and number > rules.burn_in and number % rules.optimize_every == 0
        new, new_at = written(one_pass(parts, state, table, totals, alpha, rules.beta, num_terms, seed, number, bool(tune)), "gibbs-state")
        after, after_at = written(apply_changes(table, new), "gibbs-counts")
        if tune:
            histogram = _listed(new, 2).groupBy(F.col("topics").alias("topic"), F.col("terms").alias("size")).agg(F.sum("n").alias("docs"))
            alpha = fit_prior(alpha, histogram, rules.prior_steps)
        totals = _totals(after, k)
        if rules.topics_every and number % rules.topics_every == 0:
            heads = top_terms(after.select(F.col("topic").alias("topic_id"), F.col("term_id").cast("bigint").alias("term_id"), F.col("n").alias("weight")), rules.topic_words)
            seen.append(stage(heads.select(F.lit(number).alias("step"), "topic_id", "rank", "term_id"), "gibbs-topics"))
        for path in (state_at, table_at):
            remove(spark, path)
        state, state_at, table, table_at = new, new_at, after, after_at
    return GibbsFit(state.filter("kind = 0").select("doc_id", "terms", "topics"), table, alpha, rules.beta, num_terms,
                    reduce(DataFrame.unionByName, seen) if seen else None)
