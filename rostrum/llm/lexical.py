"""Ranked lexical search over posting lists that are blocked by document similarity.

The index is cut into shards of documents. In a shard, every term has a posting list, and each list is
clustered on its own: its documents go to the nearest of some of its members (pivots), nearness being the
inner product of short random projections of the documents' weighted vectors. A cluster is a block, and a
block keeps the coordinatewise maximum of its documents' vectors.

A query reads its lists from the rarest term to the most frequent one. A document is judged in the list of
the rarest query term that it holds, so in the i-th list only the query's terms from the i-th on can add to
its score. The bound of a block is therefore the sum, over those terms, of weight times block maximum; all
values are integers, so it is never below a member's score. A block is skipped only where its bound is
below the lowest score that still ranks, and the lists from the i-th on are skipped together where the sum
of their maxima in the shard is. All other blocks are scored exactly. Ties with the lowest ranking score are
scored as well, since ids decide them.

Summaries hold the coordinates that some query of the given set reads in a list (terms that share a query
with the list's term and are no rarer). Where these exceed ``coords``, the rest are bounded by their maximum
in the shard, which is an exact bound too.

On Spark: one pass cuts texts into a forward table of query terms, one pass over that table builds shards,
and shards are searched as groups of index rows; a shard's size is bounded in documents and in cells. A first
part of the shards gives each query a score that its last result must reach; the others start from it and
return the rows that reach it. Results are ranked in two levels. Queries are taken in blocks of at most
``item_chars`` characters (more blocks, more passes), so what is sent to tasks is bounded.

Defined results: a null or word-free text has no terms and is never ranked; rows that repeat an id are
results of their own; rows without an id rank after others of their score; items that share an id are one
item with the terms of all their texts, null ids too; an item without terms, or whose terms no document
holds, has no rows. Empty tables give none. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import strings, union_all

#: Words are runs of 0-9, A-Z, a-z and everything beyond ASCII, A-Z lowered; on UTF-8 bytes.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


@dataclass(frozen=True)
class Rules:
    top: int = 50
    #: Documents in a block, on average, of a list that has more.
    block_docs: int = 48
    shard_docs: int = 4096
    #: Documents times query terms of a shard, the size of its table of impacts while it is worked on.
    shard_cells: int = 16_000_000
    #: Coordinates of a summary.
    coords: int = 512
    #: Dimensions of the projections that similarity is judged by.
    dims: int = 16
    item_chars: int = 400_000
    #: One shard in so many is searched first.
    first: int = 8


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Workload:
    """A block of queries. Terms are numbered from the rarest to the most frequent; ``weights`` go by number."""

    n_docs: int
    n_words: int
    weights: np.ndarray
    #: For each query its id and the numbers of its terms, ascending.
    queries: list[tuple[int | None, np.ndarray]]

    def coordinates(self, most: int) -> list[np.ndarray]:
        """For each term, the terms that a query with it reads in its list; at most ``most``, the rarest ones."""
        found: list[set[int]] = [set() for _ in self.weights]
        for _, numbers in self.queries:
            for i, t in enumerate(numbers.tolist()):
                found[t].update(numbers[i:i + most].tolist())
        return [np.array(sorted(x)[:most], np.int32) for x in found]


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What an occurrence count of ``tf`` in a document of ``n`` words adds to a score, per unit of weight."""
    m = 100 - 50 + (50 * n * n_docs) // max(1, n_words)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Shard:
    """Documents, posting lists and summaries of one shard. Impacts are kept as a table of terms by documents."""

    def __init__(self, terms: int, ids: pa.Array, at: np.ndarray, numbers: np.ndarray, values: np.ndarray):
        self.ids, self.known = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
        self.table = np.zeros((terms, len(ids)), np.int32)
        self.table[numbers, at] = values
        self.peak = self.table.max(axis=1) if len(ids) else np.zeros(terms, np.int32)
        self.lists: dict[int, tuple[np.ndarray, ...]] = {}

    def block(self, weights: np.ndarray, coordinates: list[np.ndarray], rules: Rules) -> None:
        """Cluster every posting list, and summarise its blocks."""
        rng = np.random.default_rng(len(weights))
        spread = rng.standard_normal((len(weights), rules.dims)).astype(np.float32) * weights[:, None].astype(np.float32)
        near = self.table.T.astype(np.float32) @ spread
        near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
        for t in np.flatnonzero(self.peak).tolist():
            docs = np.flatnonzero(self.table[t])
            starts = np.zeros(1, np.int64)
            if len(docs) > rules.block_docs:
                pivots = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // rules.block_docs)).astype(np.int64)]
                label = (near[docs] @ near[pivots].T).argmax(axis=1)
                order = np.argsort(label, kind="stable")
                docs, label = docs[order], label[order]
                starts = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1))
            coords = coordinates[t][self.peak[coordinates[t]] > 0]
            self.lists[t] = docs, starts, coords, np.maximum.reduceat(self.table[coords[:, None], docs], starts, axis=1)


class Best:
    """The best results of one query so far."""

    def __init__(self, top: int, floor: int = 1):
        self.top, self.floor = top, floor
        self.scores, self.known, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        ok = scores >= self.floor
        if not ok.any():
            return
        s, k, d = (np.concatenate(x) for x in ((self.scores, scores[ok]), (self.known, known[ok]), (self.ids, ids[ok])))
        order = np.lexsort((d, ~k, -s))[:self.top]
        self.scores, self.known, self.ids = s[order], k[order], d[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


def search(shard: Shard, numbers: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Offer ``best`` every document of the shard that may rank; returns how many were scored."""
    numbers = numbers[(shard.peak[numbers] > 0) & (weights[numbers] > 0)]
    w = weights[numbers]
    most = w * shard.peak[numbers]
    rest = np.cumsum(most[::-1])[::-1]
    seen, scored = np.zeros(len(shard.ids), bool), 0
    for i, t in enumerate(numbers.tolist()):
        if rest[i] < best.floor:
            break
        docs, starts, coords, peaks = shard.lists[t]
        at = np.minimum(np.searchsorted(coords, numbers[i:]), len(coords) - 1)
        there = coords[at] == numbers[i:]
        bounds = w[i:][there] @ peaks[at[there]].astype(np.int64) + int(most[i:][~there].sum())
        ends = np.append(starts[1:], len(docs))
        order, k, step = np.argsort(-bounds, kind="stable"), 0, 1
        while k < len(order) and bounds[order[k]] >= best.floor:
            some = order[k:k + step]
            some = some[bounds[some] >= best.floor]
            members = np.concatenate([docs[starts[b]:ends[b]] for b in some.tolist()])
            members = members[~seen[members]]
            seen[members] = True
            scored += len(members)
            best.offer(w @ shard.table[numbers[:, None], members].astype(np.int64), shard.known[members], shard.ids[members])
            k, step = k + len(some), 2 * step
    return scored


def forward(docs: DataFrame, vocabulary: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of every document with words; terms are places in ``vocabulary``."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                n, terms, tfs, ends = [], [], [], [0]
                for t in strings(part.column(1)):
                    words = terms_of(t)
                    found = np.fromiter((i for i in map(get, words) if i is not None), np.int32)
                    ids, counts = np.unique(found, return_counts=True)
                    n.append(len(words))
                    terms.append(ids)
                    tfs.append(counts)
                    ends.append(ends[-1] + len(ids))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x).astype(np.int32))) for x in (terms, tfs)]
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array([x > 0 for x in n]))

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return stage(rows.mapInArrow(cut, "doc_id long, n long, terms array<int>, tfs array<int>"), "lexical-forward")


def workload(rows: DataFrame, vocabulary: list[bytes], items: dict[int | None, set[bytes]]) -> tuple[Workload, np.ndarray]:
    """The queries with their terms' weights over all documents, and the number of each place in ``vocabulary``."""
    sums = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    holders = {r.t: r.c for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).collect()}
    place = {t: i for i, t in enumerate(vocabulary)}
    order = sorted(range(len(vocabulary)), key=lambda i: (holders.get(i, 0), vocabulary[i]))
    number = np.empty(len(vocabulary), np.int32)
    number[order] = np.arange(len(order))
    weights = np.array([weight(sums.n, holders.get(i, 0)) for i in order], np.int64)
    queries = [(k, np.sort(number[[place[t] for t in terms]])) for k, terms in items.items() if terms]
    return Workload(sums.n, sums.l, weights, queries), number


#: A posting list of a shard (``term`` >= 0): documents in block order, starts of blocks, coordinates and their maxima by
#: block. A document (``term`` = -1): its terms and their impacts, in ``docs`` and ``peaks``.
INDEX = "shard long, term int, docs array<int>, starts array<int>, coords array<int>, peaks array<int>, doc_id long"


def _ints(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)))


def index(rows: DataFrame, load: Workload, number: np.ndarray, rules: Rules = Rules()) -> DataFrame:
    """The written index of the ``forward`` rows; a shard is bounded in documents and in cells."""
    sent = rows.sparkSession.sparkContext.broadcast((load, number))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, places = sent.value
        coordinates = work.coordinates(rules.coords)
        size = max(1, min(rules.shard_docs, rules.shard_cells // max(1, len(work.weights))))
        name = TaskContext.get().partitionId() << 32

        def full(waiting: pa.Table) -> Iterator[pa.RecordBatch]:
            waiting = waiting.combine_chunks()
            terms, tfs = (waiting[c].chunk(0) for c in ("terms", "tfs"))
            sizes = np.diff(terms.offsets.to_numpy())
            at = np.repeat(np.arange(len(sizes)), sizes)
            numbers = places[terms.flatten().to_numpy()]
            values = impacts(tfs.flatten().to_numpy().astype(np.int64), waiting["n"].to_numpy()[at], work.n_docs, work.n_words)
            shard = Shard(len(work.weights), waiting["doc_id"].chunk(0), at, numbers, values)
            shard.block(work.weights, coordinates, rules)
            cuts, none = np.cumsum(sizes)[:-1], [np.zeros(0, np.int32)] * len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(sizes), pa.int64()), pa.array([-1] * len(sizes), pa.int32()), _ints(np.split(numbers, cuts)), _ints(none), _ints(none),
                 _ints(np.split(values, cuts)), waiting["doc_id"].chunk(0)], ["shard", "term", "docs", "starts", "coords", "peaks", "doc_id"])
            lists = list(shard.lists.items())
            for i in range(0, len(lists), 256):
                some = lists[i:i + 256]
                columns = [_ints([x[k].ravel() for _, x in some]) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.int64()), pa.array([t for t, _ in some], pa.int32()), *columns, pa.nulls(len(some), pa.int64())],
                    ["shard", "term", "docs", "starts", "coords", "peaks", "doc_id"])

        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - held)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                held += part.num_rows
                if held == size:
                    yield from full(pa.Table.from_batches(waiting))
                    waiting, held, name = [], 0, name + 1
        if held:
            yield from full(pa.Table.from_batches(waiting))

    return stage(rows.mapInArrow(build, INDEX), "lexical-index")


def _read(group: pa.Table, terms: int) -> Shard:
    group = group.combine_chunks()
    is_doc = group["term"].to_numpy() < 0
    docs, lists = group.filter(pa.array(is_doc)).combine_chunks(), group.filter(pa.array(~is_doc)).combine_chunks()
    numbers, values = docs["docs"].chunk(0), docs["peaks"].chunk(0)
    at = np.repeat(np.arange(len(docs)), np.diff(numbers.offsets.to_numpy()))
    shard = Shard(terms, docs["doc_id"].chunk(0), at, numbers.flatten().to_numpy(), values.flatten().to_numpy())
    if len(lists):
        columns = [lists[c].chunk(0) for c in ("docs", "starts", "coords", "peaks")]
        flat, ends = [c.flatten().to_numpy() for c in columns], [c.offsets.to_numpy() - c.offsets[0].as_py() for c in columns]
        for i, t in enumerate(lists["term"].to_pylist()):
            members, starts, coords, peaks = (x[e[i]:e[i + 1]] for x, e in zip(flat, ends))
            shard.lists[t] = members, starts, coords, peaks.reshape(len(coords), len(starts))
    return shard


def _results(rows: DataFrame, load: Workload, floors: dict[int, int], rules: Rules) -> DataFrame:
    """``(query, doc_id, score, shard, scored)``: for each shard and query the rows that may rank."""
    sent = rows.sparkSession.sparkContext.broadcast((load, floors))

    def find(key: tuple, group: pa.Table) -> pa.Table:
        work, least = sent.value
        shard, out = _read(group, len(work.weights)), []
        for q, (_, numbers) in enumerate(work.queries):
            best = Best(rules.top, least.get(q, 1))
            search(shard, numbers, work.weights, best)
            out.append((np.full(len(best.ids), q, np.int32), best.ids, best.known, best.scores))
        q, ids, known, scores = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query": q, "doc_id": pa.array(ids, mask=~known), "score": scores, "shard": pa.array([key[0].as_py()] * len(q), pa.int64())})

    return rows.groupBy("shard").applyInArrow(find, "query int, doc_id long, score long, shard long")


def _ranked(results: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _best(results: DataFrame, rules: Rules) -> DataFrame:
    """The best rows of each query, ranked in parts first, so that a query's rows never meet in one task unreduced."""
    parts = _ranked(results.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(64))), ["query", "part"], rules.top)
    return _ranked(parts.drop("rank"), ["query"], rules.top).select("query", "rank", "doc_id", "score")


def items_of(bench: DataFrame, item_id: str, text: str, rules: Rules) -> Iterator[dict[int | None, set[bytes]]]:
    """The terms of every item, a bounded block of items at a time."""
    rows = bench.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text")).distinct()
    rows = stage(rows, "lexical-items")
    blocks = max(1, -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // rules.item_chars))
    for k in range(blocks):
        items: dict[int | None, set[bytes]] = {}
        for r in rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect():
            items.setdefault(r.item_id, set()).update(terms_of(r.text))
        yield items


def rank(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
         rules: Rules = Rules()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best documents of every item, from rank 1 on."""
    spark, out = docs.sparkSession, []
    for items in items_of(bench, item_id, item_text, rules):
        vocabulary = sorted(set().union(*items.values()))
        rows = forward(docs, vocabulary, doc_id, text)
        load, number = workload(rows, vocabulary, items)
        if not load.queries:
            continue
        shards = index(rows, load, number, rules)
        early = F.pmod(F.xxhash64("shard"), F.lit(rules.first)) == 0
        first = stage(_results(shards.filter(early), load, {}, rules), "lexical-first")
        # one row per query of the block: a score that its last result reaches
        floors = {r["query"]: r.score for r in _best(first, rules).filter(F.col("rank") == rules.top).collect()}
        found = first.unionByName(_results(shards.filter(~early), load, floors, rules))
        names = spark.createDataFrame([(q, k) for q, (k, _) in enumerate(load.queries)], "query int, item_id long")
        out.append(_best(found, rules).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    return union_all(out) if out else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
