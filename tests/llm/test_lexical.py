"""Ranked search: odd tables and small shards against brute force, and what the bounds skip."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import lexical

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(60)] + ["straße", "東京", "Don"]


def text(topic, n):
    """Words of a topic, the first ones more often, and some of any topic."""
    return " ".join(WORDS[min(int(RNG.expovariate(0.25)), 14) + 15 * topic] if RNG.random() < 0.8 else RNG.choice(WORDS) for _ in range(n))


DOCS = [(i, text(i % 4, RNG.choice([3, 8, 20, 60]))) for i in range(300)] + [
    (7, "w1 w2 W3"), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w16"), (900, None), (901, ""), (902, " \n\t-_."),
    (-3, "don't  STRASSE straße 東京w5 w5,w5"), (950, "w59 " * 30_000 + "w2"), (951, "w1 w2 w3"), (952, "w2 w3 w1")]
ITEMS = [(i, text(i % 4, 12)) for i in range(12)] + [
    (50, "w1 w1 W2, w3"), (50, "w4"), (51, None), (52, ""), (53, "unseen words only"), (None, "w16 Straße"), (None, "東京w5"), (54, "w59"), (55, "Don T"), (0, "w1"), (0, "w1")]


def brute(docs, items, top):
    words = lambda t: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w)
                       for w in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    held = [(d, collections.Counter(words(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    terms = collections.defaultdict(set)
    for i, t in items:
        terms[i].update(words(t))
    out = []
    for i, own in terms.items():
        found = []
        for d, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("rules", [lexical.Rules(top=5), lexical.Rules(top=5, shard_docs=7, block_docs=2, coords=2, first=2, item_chars=150),
                                   lexical.Rules(top=50, shard_cells=900, block_docs=4, first=1), lexical.Rules(top=1, shard_docs=40, first=1000)])
def test_against_brute_force(spark, rules):
    docs = spark.createDataFrame([(*d, 1, "s") for d in DOCS], "doc_id long, text string, score int, term string").repartition(4)
    items = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, rank int").repartition(3)
    got = lexical.rank(docs, items, rules=rules)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(DOCS, ITEMS, rules.top)


def test_empty(spark):
    docs = spark.createDataFrame(DOCS[:5], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:3], "item_id long, text string")
    assert lexical.rank(docs.limit(0), items).count() == 0
    assert lexical.rank(docs, items.limit(0)).count() == 0
    assert lexical.rank(docs, items.select("item_id", F.lit(None).cast("string").alias("text"))).count() == 0


def shard(rules):
    """A shard of documents of four topics, in a random order."""
    rng = np.random.RandomState(4)
    terms, n = 80, 2000
    topic = rng.randint(0, 4, n)
    table = np.zeros((terms, n), np.int64)
    for d in range(n):
        own = np.minimum(rng.geometric(0.15, 30) - 1, 19) + 20 * topic[d]
        np.add.at(table[:, d], own, 1)
        table[rng.randint(0, terms), d] += 1
    order = np.argsort((table > 0).sum(1), kind="stable")
    table = table[order]
    t, d = np.nonzero(table)
    import pyarrow as pa
    weights = np.array([lexical.weight(n, int(h)) for h in (table > 0).sum(1)], np.int64)
    queries = [np.sort(np.flatnonzero(order // 20 == q % 4)[rng.permutation(20)[:6]]) for q in range(12)]
    load = lexical.Workload(n, int(table.sum()), weights, list(enumerate(queries)))
    s = lexical.Shard(terms, pa.array(range(n)), d, t, lexical.impacts(table[t, d], table.sum(0)[d], n, load.n_words))
    s.block(weights, load.coordinates(rules.coords), rules)
    return s, load


@pytest.mark.parametrize("coords", [512, 2])
def test_blocks_and_bounds(coords):
    rules = lexical.Rules(block_docs=16, coords=coords)
    s, load = shard(rules)
    for t, (docs, starts, own, peaks) in s.lists.items():
        assert sorted(docs.tolist()) == np.flatnonzero(s.table[t]).tolist() and own[:1].tolist() in ([t], []) and len(own) <= coords
        for b, members in enumerate(np.split(docs, starts[1:])):  # a summary is the maximum of its block, coordinate by coordinate
            assert (peaks[:, b] == s.table[own][:, members].max(axis=1)).all()
    scored = 0
    for _, numbers in load.queries:
        best = lexical.Best(10)
        scored += lexical.search(s, numbers, load.weights, best)
        every = load.weights[numbers] @ s.table[numbers].astype(np.int64)
        want = sorted(zip((-every).tolist(), range(len(every))))[:10]
        assert list(zip((-best.scores).tolist(), best.ids.tolist())) == [x for x in want if x[0] < 0]
    # the bounds leave most documents that hold a query term unread
    holders = sum(int((s.table[numbers] > 0).any(axis=0).sum()) for _, numbers in load.queries)
    assert scored < 0.6 * holders if coords == 512 else scored <= holders
