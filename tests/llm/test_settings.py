"""Paths that small tables do not reach by themselves: deep trees, cut shards, crowds, blocks and shuffled joins."""

import collections
import random
from fractions import Fraction

import numpy as np
import pytest

from rostrum.llm import fuzzylines, simhash
from rostrum.llm.components import components
from rostrum.plans.stage import stage


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("shard_rows,levels", [(40_000, 1), (100, 2), (12, 4)])
def test_simhash_trees(spark, shard_rows, levels):
    rng = random.Random(shard_rows)
    prints = set()
    for _ in range(250):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            prints.add(base)
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                base ^= 1 << bit
    # a crowd around one fingerprint: one shard holds many points
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    rules = simhash.SimHash(shard_rows=shard_rows)
    assert simhash._levels(len(prints), rules) == levels
    x = np.array(prints, np.int64).view(np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4, 1))
    want = roots(len(prints), near.tolist())
    df = stage(spark.createDataFrame([(p,) for p in prints], "fp long").repartition(4), "prints")
    got = {r.node: r.root for r in components(simhash.links(df, rules)).collect()}
    assert [got.get(p, p) for p in prints] == [prints[i] for i in want]


def test_fuzzy_lines_in_crowds_and_blocks(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    lines = set()
    for _ in range(60):
        base = [word() for _ in range(rng.randint(4, 40))]
        for _ in range(rng.randint(1, 9)):
            lines.add(" ".join(base))
            base[rng.randrange(len(base))] = word()
    template = "the committee will come to order and the clerk will read item"
    lines |= {f"{template} {i}" for i in range(70)}
    lines = sorted(lines)
    rng.shuffle(lines)
    texts = ["\n".join(lines[i:i + 7] + [rng.choice(lines)]) for i in range(0, len(lines), 7)]
    sets = [{x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in lines]
    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= Fraction(4, 5)]
    want = collections.defaultdict(set)
    for x, g in zip(lines, roots(len(lines), pairs)):
        want[g].add(x)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rules = fuzzylines.Rules(crowd=8, block=40, broadcast_lines=0)
    got = collections.defaultdict(set)
    for r in fuzzylines.classes(df, rules=rules).collect():
        got[r["class"]].add(texts[r.doc_id].split("\n")[r.line_no])
    # banding finds a pair at 0.8 with probability 0.998; the classes found here are whole
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and max(map(len, want.values())) > 40
