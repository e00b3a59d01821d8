"""Connected components of an edge table by alternating large and small stars, on joins and partial minima only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage


def _star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (u, v) and, for each u, the least of u and its partners.

    The minimum is combined before its shuffle; the join back has one row per u on one side, so a hub's
    rows on the other side can be split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs, least


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pairs, least = _star(both)
    return pairs.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs, least = _star(down)
    return (pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame, name: str = "components", most_rounds: int = 64) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` except the roots themselves; a root is the least
    node of its component. Self-loops and repeated edges are allowed; an empty table gives an empty one.

    Each round is written to the shared folder, so a lost executor costs one round at most. The number
    of rounds grows with the logarithm of the number of nodes.
    """
    clean = lambda e: e.filter("u != v").distinct()
    print_of = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = stage(clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), name)
    seen = print_of(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        now = stage(clean(_small(_large(now))), name)
        before, seen = seen, print_of(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"{name}: no fixed point after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (index of the least member) after joining the members ``a[i]`` and ``b[i]``; for use inside a task."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
