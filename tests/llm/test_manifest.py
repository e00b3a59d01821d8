"""The Merkle manifest on odd tables, against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rostrum.llm import manifest

SCHEMA = "doc_id long, source string, text string, hash string, tree string, lo long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, width):
    """Top of a tree and, for each leaf, its (left, right) siblings."""
    paths, level = [[] for _ in nodes], [(h, [i]) for i, h in enumerate(nodes)]
    while len(level) > 1:
        up = []
        for s in range(0, len(level), width):
            run = level[s:s + width]
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1:])))
            up.append((sha(*(h for h, _ in run)), [m for _, ms in run for m in ms]))
        level = up
    return level[0][0], paths


def expected(rows, width):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf_of(*r[:3])), r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([k[2] for k, _ in sorted(groups[s], key=lambda x: x[0])], width) for s in names]
    root, above = climb([t for t, _ in trees], width)
    out = []
    for s, (top, paths), up in zip(names, trees, above):
        for (k, doc), path in zip(sorted(groups[s], key=lambda x: x[0]), paths):
            out.append((doc, k[2], top, root, sha(*(x + y for x, y in path + up))))
    return sorted(out, key=repr)


ROWS = ([(i, "hot", f"text {i}") for i in range(70)] + [(5, "hot", "text 5")] * 3 + [(5, "hot", "other")] + [(None, "hot", "no id"), (None, None, None)]
        + [(100 + i, None, "") for i in range(5)] + [(200, "", "x"), (201, "ä", "Ü\U0001F600 " * 5000), (202, "one", None)]
        + [(300 + i, f"host{i}", "t") for i in range(20)])


@pytest.mark.parametrize("width", [2, 3, 16])
def test_against_plain_python(spark, width):
    df = spark.createDataFrame([(*r, "h", "t", 9) for r in ROWS], SCHEMA).repartition(5)
    values = [F.col("doc_id"), F.col("source"), F.col("text")]
    found = manifest.build(df, values, F.col("doc_id"), F.col("source"), fan_out=width)
    rows = found.leaves().select("key", "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("p"),
                                 manifest.fold(F.col("path"), F.col("leaf")).alias("f")).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == expected(ROWS, width)
    assert all(r.f == r.root for r in rows)
    nodes = found.nodes().collect()
    assert len({(n.tree, n.level, n.lo) for n in nodes}) == len(nodes)
    for n in nodes:  # intervals are nested: a node lies in just one node of the next level, if its tree has one
        over = [m for m in nodes if m.tree == n.tree and m.level == n.level + 1]
        assert not over or sum(m.lo <= n.lo and n.hi <= m.hi for m in over) == 1


def test_tampering_and_small_trees(spark):
    one = spark.createDataFrame([(7, "s", "Text")], "doc_id long, source string, text string")
    values = [F.col("doc_id"), F.col("source"), F.col("text")]
    r = manifest.build(one, values, F.col("doc_id"), F.col("source"), F.lit("ab")).leaves().first()
    assert r.leaf == r.subroot == r.root == leaf_of(7, "s", "Text") and r.path == [] and r.presented == "ab"
    two = one.union(spark.createDataFrame([(8, "s", None)], one.schema))
    rows = manifest.build(two, values, F.col("doc_id"), F.col("source"), F.when(F.col("doc_id") == 8, manifest.leaf([F.lit(8), F.lit("s"), F.lit("")]))).leaves()
    got = {r.key: r for r in rows.withColumn("f", manifest.fold(F.col("path"), F.coalesce("presented", "leaf"))).collect()}
    assert got[7].f == got[7].root and got[8].f != got[8].root
    empty = manifest.build(one.limit(0), values, F.col("doc_id"), F.col("source"))
    assert empty.leaves().count() == 0 and empty.nodes().count() == 0
