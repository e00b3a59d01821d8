"""numpy helpers for Arrow batches of the topic models. Spark partitions and shuffles the work."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa


def digamma(x):
    y = x + 6.0
    q = 1.0 / (y * y)
    series = q * (1 / 12 - q * (1 / 120 - q * (1 / 252 - q * (1 / 240 - q / 132))))
    back = sum(1.0 / (x + i) for i in range(6))
    return np.log(y) - 0.5 / y - series - back


def trigamma(x):
    y = x + 6.0
    q = 1.0 / (y * y)
    series = 1 / y + q / 2 + q / y * (1 / 6 - q * (1 / 30 - q * (1 / 42 - q / 30)))
    return series + sum(1.0 / ((x + i) * (x + i)) for i in range(6))


def gammaln(x):
    y = x + 6.0
    q = 1.0 / (y * y)
    series = (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q * (1 / 1680 - q / 1188)))) / y
    prod = x
    for i in range(1, 6):
        prod = prod * (x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(prod)


def gamma_entropy(shape, rate):
    return float(np.sum(shape - np.log(rate) + gammaln(shape) + (1.0 - shape) * digamma(shape)))


def factor_elbo(shape, rate, prior_rate, a, hyper_shape, hyper_rate, prior_shape):
    """Bound terms of one factor side; rows are documents (or terms), columns are topics."""
    k = shape.shape[1]
    log_prior_rate = digamma(np.asarray(prior_shape)) - np.log(prior_rate)
    prior = np.sum((hyper_shape - 1.0) * log_prior_rate - hyper_rate * (prior_shape / prior_rate))
    log_factor = digamma(shape) - np.log(rate)
    cond = (k * a * np.sum(log_prior_rate) + (a - 1.0) * np.sum(log_factor)
            - np.sum((shape / rate) * (prior_shape / prior_rate)[:, None]))
    return float(prior + cond) + gamma_entropy(np.full_like(prior_rate, prior_shape), prior_rate) + gamma_entropy(shape, rate)


def slices(batches, width, cells=4_000_000):
    """Cut batches so that one slice's non-zeros times ``width`` stays near ``cells`` numbers."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lens = batch.column("idx").value_lengths().to_numpy(zero_copy_only=False)
        part = (np.cumsum(lens) * width) // cells
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def doc_update(batches, geo, topic_sum, seed_slot, k, a, hyper, prior_shape, out_schema, with_elbo):
    """One document step over the batches of a partition.

    Yields the new document rows batch by batch, then the partition's term messages and totals:
    kind 0 = document, kind 1 = term message, kind 2 = totals (sum of new means, data bound, document bound).
    """
    n_terms = geo.shape[0] // max(1, len(seed_slot))
    message = np.zeros_like(geo)
    touched = np.zeros(geo.shape[0], dtype=bool)
    totals = {s: np.zeros(k + 2) for s in seed_slot}

    def lists(flat, width):
        n = len(flat) // width
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(flat))

    for batch in slices(batches, k):
        seeds = batch.column("seed").to_numpy(zero_copy_only=False)
        slot = np.array([seed_slot[s] for s in seeds.tolist()])
        idx_col, val_col = batch.column("idx"), batch.column("val")
        idx = idx_col.flatten().to_numpy(zero_copy_only=False)
        val = val_col.flatten().to_numpy(zero_copy_only=False)
        lens = idx_col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        shape = batch.column("shape").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        rate = batch.column("rate").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        prior_rate = batch.column("prior_rate").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lens)), lens)
        at = slot[row] * n_terms + idx
        g_doc = np.exp(digamma(shape)) / rate
        g_term = geo[at]
        g_row = g_doc[row]
        norm = np.einsum("ij,ij->i", g_row, g_term)
        share = val / norm
        sums = np.zeros_like(shape)
        full = lens > 0
        if full.any():
            starts = (np.cumsum(lens) - lens)[full]
            sums[full] = np.add.reduceat(g_term * share[:, None], starts, axis=0)
            order = np.argsort(at, kind="stable")
            keys, first = np.unique(at[order], return_index=True)
            message[keys] += np.add.reduceat((g_row * share[:, None])[order], first, axis=0)
            touched[keys] = True
        new_shape = a + g_doc * sums
        new_rate = (prior_shape / prior_rate)[:, None] + topic_sum[slot]
        mean = new_shape / new_rate
        new_prior = hyper + mean.sum(axis=1)
        data = val * np.log(norm)
        for s, j in seed_slot.items():
            mine = slot == j
            if not mine.any():
                continue
            totals[s][:k] += mean[mine].sum(axis=0)
            totals[s][k] += data[mine[row]].sum()
            if with_elbo:
                totals[s][k + 1] += factor_elbo(new_shape[mine], new_rate[mine], new_prior[mine], a, hyper, hyper, prior_shape)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, dtype=np.int8)), batch.column("seed"), batch.column("id"), idx_col, val_col,
             lists(new_shape.ravel(), k), lists(new_rate.ravel(), k), pa.array(new_prior)], schema=out_schema)

    names = {j: s for s, j in seed_slot.items()}
    rows = np.flatnonzero(touched)
    for start in range(0, len(rows), 10_000):
        r = rows[start:start + 10_000]
        n = len(r)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, dtype=np.int8)), pa.array([names[j] for j in (r // n_terms).tolist()], pa.int32()),
             pa.array((r % n_terms).astype(np.int64)), pa.nulls(n, out_schema.field("idx").type),
             pa.nulls(n, out_schema.field("val").type), lists(message[r].ravel(), k),
             pa.nulls(n, out_schema.field("rate").type), pa.nulls(n, pa.float64())], schema=out_schema)
    n = len(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, 2, dtype=np.int8)), pa.array(list(totals), pa.int32()), pa.array(np.zeros(n, dtype=np.int64)),
         pa.nulls(n, out_schema.field("idx").type), pa.nulls(n, out_schema.field("val").type),
         lists(np.concatenate(list(totals.values())), k + 2), pa.nulls(n, out_schema.field("rate").type),
         pa.nulls(n, pa.float64())], schema=out_schema)


def fit_mixtures(at, cnt, sizes, beta, alpha, iterations, tolerance, sums, cells=4_000_000):
    """Variational parameters of documents under fixed topics: ``(gamma, rounds, sums by row of beta)``.

    ``at`` are rows of ``beta`` for the documents' counts ``cnt``, one document after the other. Every
    document starts at one and stops by itself; only those that still move are computed on.
    """
    k, n = len(alpha), len(sizes)
    gamma, rounds = np.ones((n, k)), np.zeros(n, np.int64)
    found = np.zeros((len(beta) if sums else 0, k))
    ends = np.cumsum(sizes)
    part = (ends * k) // cells
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n] if n else []
    for lo, hi in zip(cuts, cuts[1:]):
        mine = slice(int(ends[lo] - sizes[lo]), int(ends[hi - 1]))
        row, b, c = np.repeat(np.arange(lo, hi), sizes[lo:hi]), beta[at[mine]], cnt[mine]
        moving = np.zeros(n, bool)
        moving[lo:hi] = True
        for _ in range(iterations):
            docs = np.flatnonzero(moving)
            if not len(docs):
                break
            keep = moving[row]
            r, bb = np.searchsorted(docs, row[keep]), b[keep]
            theta = _mixture(gamma[docs])
            share = c[keep] / (np.einsum("ij,ij->i", theta[r], bb) + 1e-100)
            got = np.zeros((len(docs), k))
            held, first = np.unique(r, return_index=True)
            if len(held):
                got[held] = np.add.reduceat(bb * share[:, None], first, axis=0)
            new = alpha + theta * got
            rounds[docs] += 1
            moving[docs] = np.abs(new - gamma[docs]).mean(axis=1) >= tolerance
            gamma[docs] = new
        if sums:
            theta = _mixture(gamma[lo:hi])[row - lo]
            share = c / (np.einsum("ij,ij->i", theta, b) + 1e-100)
            np.add.at(found, at[mine], theta * b * share[:, None])
    return gamma, rounds, found


def _mixture(gamma):
    """exp of the expected log mixture."""
    return np.exp(digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])


#: Numbers of one block of shares (counts times topics).
_BLOCK = 4_000_000


def _doc_blocks(sizes: np.ndarray, k: int):
    """``(first document, end, first count, end)`` of runs of documents with a bounded number of shares."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        at = int(ends[lo] - sizes[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, at + _BLOCK // k, side="right")))
        yield lo, hi, at, int(ends[hi - 1])
        lo = hi


def first_shares(ids, sizes, k, uniform):
    """A function of a block of documents that gives random shares, from ``uniform(topic, documents, places)``."""
    def share(lo, hi, a, b):
        own = sizes[lo:hi]
        docs = np.repeat(ids[lo:hi], own)
        places = np.arange(b - a) - np.repeat(np.cumsum(own) - own, own)
        x = np.column_stack([uniform(j, docs, places) for j in range(k)])
        return x / x.sum(axis=1)[:, None]
    share.k = k
    return share


def share_sums(share, cnt, at, sizes, num_terms):
    """Counts dealt by ``share`` (a function of a block of documents), summed by document and by term."""
    k = share.k
    by_doc, by_term = np.zeros((len(sizes), k)), np.zeros((num_terms, k))
    for lo, hi, a, b in _doc_blocks(sizes, k):
        x = share(lo, hi, a, b) * cnt[a:b, None]
        doc = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        for j in range(k):
            by_doc[lo:hi, j] = np.bincount(doc, x[:, j], hi - lo)
            by_term[:, j] += np.bincount(at[a:b], x[:, j], num_terms)
    return by_doc, by_term


def em_step(at, cnt, sizes, docs, terms):
    """One step of expectation-maximisation: ``docs`` and ``terms`` are the smoothed counts by topic."""
    def share(lo, hi, a, b):
        x = terms[at[a:b]] * np.repeat(docs[lo:hi], sizes[lo:hi], axis=0)
        return x / x.sum(axis=1)[:, None]
    share.k = docs.shape[1]
    return share_sums(share, cnt, at, sizes, len(terms))
