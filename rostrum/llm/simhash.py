"""SimHash near-duplicates: all fingerprints within a few bits, found with vantage-point trees.

Fingerprints are computed in one Arrow pass and made distinct, so copies are linked by equality and only
different fingerprints are searched. Two fingerprints that differ in at most ``radius`` bits differ in at
most ``radius // blocks`` bits of one of ``blocks`` equal blocks. For each block a vantage-point tree
partitions all fingerprints by their Hamming distances to the vantage points of its levels:

* the *home* shard of a fingerprint is its vector of distances on the upper levels;
* by the triangle inequality a partner within ``rho`` bits lies in a shard whose distances differ by at
  most ``rho`` on every level, so a fingerprint also *visits* those neighbouring shards (one direction
  is enough, since each pair needs to be found once);
* inside a shard the tree goes on: points fall into rings around a vantage point, and queries descend
  only into the rings the triangle bound leaves open. Leaves compare whole fingerprints.

Shards above ``shard_rows`` are cut into blocks of points and blocks of queries, and every block of
queries meets every block of points, so no task holds an unbounded shard. A task returns a spanning
forest of the links it found, never all pairs; connected components of the forests are the groups.

Defined results: null, empty and word-free texts have fingerprint zero and are linked like any other.
Repeated rows are copies of each other. A group's id is its least non-null ``doc_id`` (null if it has none).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import fresh, strings
from .components import components, merge


@dataclass(frozen=True)
class SimHash:
    shingle: int = 4
    seed: int = 42
    radius: int = 4
    blocks: int = 4
    #: Most points, and most queries, that one task searches at a time.
    shard_rows: int = 40_000


#: Vantage points of the upper levels, for blocks of 16 bits: distances to them vary independently.
VANTAGE = (0x0000, 0x00FF, 0x0F0F, 0x3333)


def fingerprint(text: str, width: int, seed: int) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[min(width, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], seed) for i, j in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, rules: SimHash = SimHash()) -> Column:
    """The fingerprint as a (signed) long."""
    @F.arrow_udf("long")
    def prints(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, rules.shingle, rules.seed) for x in strings(column)], pa.int64())

    return prints(text.cast("string"))


def _levels(count: int, rules: SimHash) -> int:
    """Upper levels of the trees: more for more fingerprints, so that shards stay near ``shard_rows``."""
    share = (1.0, 0.2, 0.08, 0.03, 0.01)  # of the fingerprints in the largest shard, by levels
    return next((t for t in range(1, len(VANTAGE)) if count * share[t] <= rules.shard_rows), len(VANTAGE))


def _shards(prints: DataFrame, rules: SimHash, levels: int) -> DataFrame:
    """``(shard, home, fp, block)``: each fingerprint at home and as a visitor, for every block."""
    bits = 64 // rules.blocks
    rho = rules.radius // rules.blocks
    moves = [m for m in product(range(-rho, rho + 1), repeat=levels)
             if m > (0,) * levels and len({x % 2 for x in m}) == 1]  # vantage points have even weight: one parity
    rows = []
    for b in range(rules.blocks):
        part = F.shiftrightunsigned("fp", bits * b).bitwiseAND(F.lit((1 << bits) - 1))
        at = [F.bit_count(part.bitwiseXOR(F.lit(v))) for v in VANTAGE[:levels]]
        key = lambda m: sum(((d + F.lit(x)) * F.lit((bits + 1) ** i) for i, (d, x) in enumerate(zip(at, m))),
                            F.lit(b * (bits + 1) ** levels))
        inside = lambda m: [(d + F.lit(x)).between(0, bits) for d, x in zip(at, m) if x]
        rows.append(F.struct(key((0,) * levels).cast("long").alias("shard"), F.lit(True).alias("home"), F.lit(b).alias("block")))
        for m in moves:
            ok = F.lit(True)
            for x in inside(m):
                ok = ok & x
            rows.append(F.when(ok, F.struct(key(m).cast("long").alias("shard"), F.lit(False).alias("home"), F.lit(b).alias("block"))))
    return prints.select("fp", F.explode(F.array(*rows)).alias("x")).filter("x is not null").select("fp", "x.*")


def _near(points: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(points[:, None] ^ queries[None, :]) <= radius)


def search(points: np.ndarray, queries: np.ndarray, block: int, rules: SimHash, found) -> None:
    """Calls ``found(p, q)`` with index arrays of all pairs within the radius whose block is within rho.

    A vantage-point tree over ``points`` by the distance of one block; once a block no longer separates
    the points, by the distance of the whole fingerprint. A leaf is compared in slices of bounded size.
    """
    bits = 64 // rules.blocks
    mask = np.uint64(((1 << bits) - 1) << (bits * block))
    leaf = 1 << 18
    stack = [(np.arange(len(points)), np.arange(len(queries)), mask, rules.radius // rules.blocks, 0)]
    while stack:
        p, q, part, reach, same = stack.pop()
        if not len(p) or not len(q):
            continue
        if len(p) * len(q) <= leaf or len(p) <= 8 or same > 6:
            for i in range(0, len(p), 1024):
                step = max(1, (1 << 22) // min(1024, len(p)))
                for j in range(0, len(q), step):
                    x, y = _near(points[p[i:i + 1024]], queries[q[j:j + step]], rules.radius)
                    found(p[i:i + 1024][x], q[j:j + step][y])
            continue
        pivot = points[p[(len(p) * 7919 + same) % len(p)]] & part
        dp = np.bitwise_count((points[p] & part) ^ pivot).astype(np.int16)
        dq = np.bitwise_count((queries[q] & part) ^ pivot).astype(np.int16)
        rings, sizes = np.unique(dp, return_counts=True)
        if sizes.max() > 0.9 * len(p):  # this distance no longer separates them
            if part == mask and len(rings) == 1:
                part, reach = np.uint64(0xFFFFFFFFFFFFFFFF), rules.radius
                # only queries that the block's bound leaves open go on
                q = q[dq <= int(rings[0]) + rules.radius // rules.blocks]
            stack_same = same + 1
        else:
            stack_same = same
        for ring in rings if len(rings) > 1 else ():
            stack.append((p[dp == ring], q[np.abs(dq - ring) <= reach], part, reach, stack_same))
        if len(rings) == 1:
            stack.append((p, q, part, reach, stack_same))


def _links(rules: SimHash):
    def find(batch: pa.Table) -> pa.Table:
        fp = batch["fp"].to_numpy().view(np.uint64)
        point = batch["point"].to_numpy(zero_copy_only=False)
        block = int(batch["block"][0].as_py())
        nodes = np.unique(fp)
        points, queries = np.unique(fp[point]), np.unique(fp[~point])
        at_p, at_q = np.searchsorted(nodes, points), np.searchsorted(nodes, queries)
        state = [np.arange(len(nodes)), [], 0]

        def flush():
            if state[1]:
                state[0] = merge(state[0], np.concatenate([x for x, _ in state[1]]), np.concatenate([y for _, y in state[1]]))
                state[1], state[2] = [], 0

        def found(p, q):
            state[1].append((at_p[p], at_q[q]))
            state[2] += len(p)
            if state[2] > 1 << 20:
                flush()

        search(points, queries, block, rules, found)
        flush()
        linked = np.flatnonzero(state[0] != np.arange(len(nodes)))
        return pa.table({"u": nodes[linked].view(np.int64), "v": nodes[state[0][linked]].view(np.int64)})
    return find


def links(prints: DataFrame, rules: SimHash = SimHash()) -> DataFrame:
    """Links ``(u, v)`` that span the same groups as all pairs of the distinct ``prints(fp)`` within the radius."""
    if 64 % rules.blocks or 64 // rules.blocks != 16 or not 0 <= rules.radius // rules.blocks <= 2:
        raise ValueError("blocks must be 4 (of 16 bits) and the radius below 12")
    rows = _shards(prints, rules, _levels(prints.count(), rules))
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n"), F.max("home").alias("used")).filter("used")
    # only occupied shards matter; one with many rows is cut into so many blocks of points and of queries
    cuts = stage(sizes.select("shard", F.ceil(F.col("n") / F.lit(rules.shard_rows)).cast("int").alias("g")), "simhash-shards")
    rows = rows.join(cuts, "shard")
    own = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("g") - 1))
    points = rows.filter("home").select("shard", "block", "fp", own.alias("s"), every.alias("t"), F.lit(True).alias("point"))
    queries = rows.select("shard", "block", "fp", own.alias("t"), every.alias("s"), F.lit(False).alias("point"))
    return points.unionByName(queries).groupBy("shard", "s", "t").applyInArrow(_links(rules), "u long, v long")


def groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: SimHash = SimHash()) -> DataFrame:
    """``(doc_id, fp, root, component_id)``, one row per row of ``df``: its fingerprint, the fingerprint that
    stands for its group, and the group's least document id."""
    prints = stage(df.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprint_column(F.col(f"`{text}`"), rules).alias("fp")), "fingerprints")
    each = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    rooted = each.join(components(links(each.select("fp"), rules), "simhash-components").withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "fingerprints-rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(ids, "root")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: SimHash = SimHash()) -> DataFrame:
    """Just one row of ``df`` per group, one of those with the group's least ``doc_id``; all columns, unchanged.

    Rows that repeat a document id in a group are copies, and one of them stays; rows that share an id but
    lie in different groups are judged each in its own group. Rows without an id stay only where no row of
    their group has one, and then one of them does.
    """
    found = stage(groups(df, doc_id, text, rules), "simhash-groups")
    # ids of a single row say which row stays; repeated and missing ids are settled on whole rows
    ids = stage(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("least")), "simhash-ids")
    odd = ids.filter("n > 1 or doc_id is null")
    # ids that are not settled, or whose only row goes; written, so that its own size decides how texts meet it
    drop = stage(ids.filter("doc_id is not null and (n > 1 or not doc_id <=> least)").select("doc_id"), "simhash-copies")
    fp, other, left, right, pick = (fresh(df, x) for x in ("simhash_fp", "simhash_id", "simhash_print", "simhash_root", "simhash_pick"))
    key = F.col(f"`{doc_id}`")
    plain = df.filter(key.isNotNull()).join(drop.select(F.col("doc_id").alias(other)), key == F.col(other), "left_anti")
    if odd.isEmpty():
        return plain
    mine = df.select(*[F.col(f"`{c}`") for c in df.columns], fingerprint_column(F.col(f"`{text}`"), rules).alias(fp))
    best = found.filter("doc_id <=> component_id").join(odd.select(F.col("doc_id").alias("odd_id")), F.col("doc_id").eqNullSafe(F.col("odd_id")), "left_semi") \
        .select(F.col("doc_id").alias(other), F.col("fp").alias(left), F.col("root").alias(right)).distinct()
    rows = mine.join(best, key.eqNullSafe(F.col(other)) & (F.col(fp) == F.col(left))) \
        .select(right, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(pick), F.xxhash64(F.col(f"`{text}`").cast("string")).alias(fp))
    kept = rows.groupBy(right).agg(F.min_by(pick, fp).alias(pick))
    return plain.unionByName(kept.select(*[F.col(f"`{pick}`.`{c}`") for c in df.columns]))
