"""numpy helpers of the topic sampler: random numbers by hashing, and draws for many documents in step."""

from __future__ import annotations

import numpy as np

# Odd multipliers of a 64-bit mixing function (fixed values).
_STEP = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_KEYS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0x2545F4914F6CDD1D)


def uniform(seed, number, doc, place):
    """Numbers in [0, 1) from the hash of (seed, number, document, place); arrays of documents and places."""
    base = (seed * _KEYS[0] + number * _KEYS[1] + _STEP) % (1 << 64)
    x = np.asarray(doc, np.int64).view(np.uint64) * np.uint64(_KEYS[2]) + np.asarray(place).astype(np.uint64) * np.uint64(_STEP) + np.uint64(base)
    for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def sweep(terms, topics, sizes, ids, n_wk, n_k, alpha, beta, num_terms, seed, number, cells=4_000_000):
    """New topics of all tokens, and the documents' topic counts.

    ``terms`` are rows of ``n_wk``; a document's tokens follow each other, equal terms side by side. All
    documents of a slice draw their i-th token together: they do not see each other's changes, and within
    a document the changes at earlier places are carried along.
    """
    k, n = len(alpha), len(sizes)
    topics = topics.copy()
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if n else np.zeros(0, np.int64)
    counts = np.zeros((n, k), np.int64)
    np.add.at(counts, (np.repeat(np.arange(n), sizes), topics), 1)
    by_size = np.argsort(-sizes, kind="stable")
    width = max(1, cells // k)
    for lo in range(0, n, width):
        docs = by_size[lo:lo + width]
        size, begin, doc = sizes[docs], starts[docs], ids[docs]
        n_dk, own_w, own_k = counts[docs], np.zeros((len(docs), k), np.int64), np.zeros((len(docs), k), np.int64)
        before = np.full(len(docs), -1, np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -i, side="left"))  # documents with more than i tokens
            r, at = np.arange(m), begin[:m] + i
            w, z = terms[at], topics[at]
            own_w[:m][w != before[:m]] = 0
            before[:m] = w
            for counted in (n_dk, own_w, own_k):
                counted[r, z] -= 1
            p = (n_dk[:m] + alpha) * (n_wk[w] + own_w[:m] + beta) / (n_k + own_k[:m] + num_terms * beta)
            upto = np.cumsum(p, axis=1)
            new = np.minimum((upto <= (uniform(seed, number, doc[:m], np.full(m, i)) * upto[:, -1])[:, None]).sum(axis=1), k - 1)
            topics[at] = new
            for counted in (n_dk, own_w, own_k):
                counted[r, new] += 1
        counts[docs] = n_dk
    return topics, counts
