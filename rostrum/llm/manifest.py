"""Merkle manifest of a dataset with nested-interval labels.

Every row is a leaf. Leaves are ranked inside their group (a source), and every node of a group's tree is
labelled with the interval ``[lo, hi)`` of leaf ranks that it covers. The groups' subroots, in group order,
are the leaves of one more tree, whose top is the root.

* A node's level gives its bucket: ``lo div fan_out ** level``. Attaching a node to its ancestor is an
  equi-join on group and bucket of the ancestor's level with the test that its interval contains the node's.
* The siblings of a node are the difference of its parent's interval and its own: the children that end
  before it, and those that begin after it.

Leaves are ranked by a range sort and running counts over one row per task and group, so a group may hold
any share of the rows; runs of ``fan_out`` leaves are the largest thing grouped. Paths are attached from
the top down, one level at a time, to runs; leaves inherit the path of their run. Only digests move, texts
are read once.

Defined results: null values hash as ``-``; rows without an id come first in their group, rows that repeat
an id are leaves of their own in the order of their digests; a null group is a group of its own and the
first one; a group of one leaf has that leaf as subroot, one group's subroot is the root; an empty table
has no nodes. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import union_all

FAN_OUT = 16


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    return digest(*map(encoded, values))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")


def outside(children: Column, lo: Column, hi: Column) -> Column:
    """The siblings ``(left, right)`` of the node ``[lo, hi)``: its parent's interval without its own."""
    return F.struct(_joined(F.filter(children, lambda x: x["hi"] <= lo)).alias("left"),
                    _joined(F.filter(children, lambda x: x["lo"] >= hi)).alias("right"))


def proof(path: Column) -> Column:
    """Digest of all siblings on a path, lowest level first, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def fold(path: Column, start: Column) -> Column:
    """The root that the leaf ``start`` gives with the siblings of ``path``."""
    return F.aggregate(path, start, lambda h, x: digest(x["left"], h, x["right"]))


def _ranked(rows: DataFrame) -> DataFrame:
    """Staged ``(tree, key, hash, ...)`` with ``lo``, the rank by (key, hash) in the tree, and ``n``, the tree's leaves.

    Rows that are equal in all of these are told apart by their place in the staged files, so even they spread.
    """
    order = ["tree", "key", "hash", "_tie"]
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_rows.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "manifest-places") \
        .withColumn("_task", F.shiftright("_place", 33))
    held = placed.groupBy("_task", "tree").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stage(held.select("_task", "tree", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("n")), "manifest-starts")
    return placed.join(starts, ["_task", "tree"]).withColumn("lo", F.col("_place") + F.col("_shift")).drop("_task", "_place", "_shift")


def _parents(nodes: DataFrame, span: int, extra: Sequence[str] = ()) -> DataFrame:
    """Nodes ``(tree, n, lo, hi, hash, kids)`` over runs of ``nodes``; a parent covers up to ``span`` leaves."""
    kid = F.struct("lo", "hi", "hash", *extra)
    runs = nodes.groupBy("tree", "n", F.expr(f"lo div {span}").alias("_bucket")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    alone = (F.col("n") == 1)
    return runs.select("tree", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                       F.when(alone, F.col("kids")[0]["hash"]).otherwise(digest(_joined(F.col("kids")))).alias("hash"), "kids")


@dataclass(frozen=True)
class Tree:
    """Nodes of all trees of a forest by level, from the runs of leaves up; ``tops`` has one row per tree."""

    levels: list[DataFrame]
    tops: DataFrame
    fan_out: int

    def nodes(self) -> DataFrame:
        """``(tree, level, lo, hi, hash)`` of every inner node; a lone leaf is its own run."""
        return union_all([x.select("tree", F.lit(i + 1).alias("level"), "lo", "hi", "hash") for i, x in enumerate(self.levels)])


def grow(rows: DataFrame, fan_out: int = FAN_OUT) -> Tree:
    """Trees over staged leaves ``(tree, key, hash, ...)``; further columns stay with the leaves."""
    extra = [c for c in rows.columns if c not in ("tree", "hash")]
    ranked = _ranked(rows).withColumn("hi", F.col("lo") + 1)
    span = fan_out
    levels = [stage(_parents(ranked, span, extra), "manifest-runs")]
    largest = levels[0].agg(F.max("n")).first()[0] or 0
    while span < largest:
        below = levels[-1].filter(F.col("n") > span).select("tree", "n", "lo", "hi", "hash")
        span *= fan_out
        levels.append(stage(_parents(below, span), "manifest-level"))
    tops = union_all([x.filter("hi - lo = n").select("tree", "hash") for x in levels])
    return Tree(levels, stage(tops, "manifest-tops"), fan_out)


def _paths(forest: Tree, above: DataFrame) -> DataFrame:
    """The runs of ``forest`` with their ``path`` and what else ``above(tree, path, ...)`` says of their tree."""
    extra = [c for c in above.columns if c not in ("tree", "path")]
    upper, span = None, forest.fan_out ** (len(forest.levels) + 1)
    for k, level in enumerate(reversed(forest.levels)):
        found = level.filter("hi - lo = n").join(above, "tree")
        if upper is not None:
            bucket = F.expr(f"lo div {span}")
            ancestor = upper.select(F.col("tree").alias("_tree"), bucket.alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                    F.col("kids").alias("_kids"), F.col("path").alias("_path"), *extra)
            inside = (F.col("tree") == F.col("_tree")) & (bucket == F.col("_bucket")) & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            step = F.concat(F.array(outside(F.col("_kids"), F.col("lo"), F.col("hi"))), F.col("_path"))
            lower = level.filter("hi - lo < n").join(ancestor, inside)
            found = found.unionByName(lower.select(*level.columns, step.alias("path"), *extra))
        last = k == len(forest.levels) - 1
        upper = found if last else stage(found, "manifest-paths")
        span //= forest.fan_out
    return upper


@dataclass(frozen=True)
class Manifest:
    groups: Tree
    whole: Tree

    def nodes(self) -> DataFrame:
        """``(tree, level, lo, hi, hash)``: inner nodes of the groups' trees and of the tree over them.

        ``tree`` is the group after an ``s``, empty for the null group, and ``*`` for the tree over groups.
        """
        return self.groups.nodes().unionByName(self.whole.nodes())

    def leaves(self) -> DataFrame:
        """One row per leaf: ``key``, what was kept with it, ``leaf``, ``subroot``, ``root`` and its ``path`` of siblings."""
        none = F.array().cast("array<struct<left:string,right:string>>")
        over = _paths(self.whole, self.whole.tops.select("tree", none.alias("path"), F.col("hash").alias("root")))
        own = lambda c: F.when(F.col("n") == 1, F.col("path")).otherwise(
            F.concat(F.array(outside(F.col("kids"), c["lo"], c["hi"])), F.col("path")))
        each = over.select("n", "path", "root", "kids", F.explode("kids").alias("x"))
        above = stage(each.select(F.col("x.key").alias("tree"), own(F.col("x")).alias("path"), F.col("x.hash").alias("subroot"), "root"), "manifest-groups")
        runs = _paths(self.groups, above)
        rows = runs.select("n", "path", "kids", "subroot", "root", F.explode("kids").alias("x"))
        kept = [c for c in self.groups.levels[0].schema["kids"].dataType.elementType.names if c not in ("lo", "hi", "hash")]
        return rows.select(*[F.col(f"x.{c}").alias(c) for c in kept], F.col("x.hash").alias("leaf"), "subroot", "root", own(F.col("x")).alias("path"))


def build(df: DataFrame, values: Sequence[Column], key: Column, group: Column, presented: Column | None = None, fan_out: int = FAN_OUT) -> Manifest:
    """The manifest of ``df``: leaves hash ``values``, ordered by ``key`` within ``group``.

    ``presented`` is kept with each leaf, for example the digest of a copy that is to be verified.
    """
    rows = df.select(F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("")).alias("tree"), key.alias("key"),
                     leaf(values).alias("hash"), (F.lit(None).cast("string") if presented is None else presented).alias("presented"))
    groups = grow(stage(rows, "manifest-leaves"), fan_out)
    return Manifest(groups, grow(groups.tops.select(F.lit("*").alias("tree"), F.col("tree").alias("key"), "hash"), fan_out))
