"""Removal of repeated byte strings across documents with a logarithmic family of suffix indexes.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a smaller id.

* Documents are cut into slices, files in a shared folder, so no text is ever shuffled. Of each document the
  suffixes at window minimizers are sampled: the least hash among the ``seed``-byte strings of each window of
  ``length`` bytes. Equal windows have equal minimizers, so a repeated string always meets itself there.
* A batch of slices gets its suffix array: its sampled suffixes ordered by the hash of their first ``seed``
  bytes, cut into shards by that hash. The batch is merge-scanned against itself and against every level of
  the index; suffixes found twice are reported to the slices that hold them. The batch then becomes a level,
  and levels of equal size merge, so n batches leave at most log2(n) levels and every suffix is merged at
  most log2(n) times.
* For the suffixes found, slices send out the windows around them (each distinct context once, with its least
  document), and the exact comparison of windows answers which of them a smaller document has.

Suffixes that more than ``hot_slices`` slices hold are compared window by window instead of by suffix, which
spreads them; beyond ``broadcast_rows`` of them, those of the most slices are. Windows are found by 64-bit hashes
and compared byte by byte before any is removed, copies of whole texts by their sha256.

Defined results: null and empty texts have no bytes; texts below ``length`` bytes lose nothing. Rows that
share an id do not remove each other's strings. A null id counts as larger than all others. Of exact copies
all but those of the least id are removed whole, without being indexed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stage import new_path, stage
from .common import union_all


@dataclass(frozen=True)
class Rules:
    length: int = 50
    seed: int = 20
    slice_bytes: int = 8_000_000
    batches: int = 4
    hot_slices: int = 2_000
    #: Hot suffixes, and digests of copied texts, that may be broadcast; more digests are joined.
    broadcast_rows: int = 1_000_000
    #: Most partitions that slices are dealt to; each slice is a group of its own in any case.
    slice_tasks: int = 50_000


NO_ID = (1 << 63) - 1
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


# ---- inside a task: hashes of byte strings

def _string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all strings of ``size`` bytes, by doubling."""
    now, width, step = (data.astype(np.uint64) + np.uint64(0x1234567)) * _Q, 1, int(_P)
    done, have = None, 0
    left = size
    while left:
        if left & 1:
            if done is None:
                done, have = now, width
            else:
                n = len(data) - have - width + 1
                done, have = done[:n] * np.uint64(step) + now[have:have + n], have + width
        left >>= 1
        if left:
            n = len(now) - width
            now = now[:n] * np.uint64(step) + now[width:width + n]
            width, step = 2 * width, step * step & 0xFFFFFFFFFFFFFFFF
    return (done ^ (done >> np.uint64(29))) * _P


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    n, size = len(h) - w + 1, 1
    while 2 * size <= w:
        h = np.minimum(h[:len(h) - size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[w - size:w - size + n])


def pieces(text: bytes, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, number of windows): runs of windows with the same minimizer, 31 at most."""
    if len(text) < rules.length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = _least(_string_hashes(np.frombuffer(text, np.uint8), rules.seed), rules.length - rules.seed + 1)
    start = np.concatenate(([0], np.flatnonzero(m[1:] != m[:-1]) + 1))
    count = np.diff(np.append(start, len(m)))
    if count.max() > 31:
        parts = -(-count // 31)
        first = np.repeat(np.cumsum(parts) - parts, parts)
        at = np.arange(len(first)) - first
        start, count = np.repeat(start, parts) + 31 * at, np.minimum(31, np.repeat(count, parts) - 31 * at)
    return m[start], start, count


def _ids(m: np.ndarray, shards: int) -> np.ndarray:
    """A suffix's shard in the upper and its key in the lower 32 bits."""
    return (((m >> np.uint64(32)) % np.uint64(shards)) << np.uint64(32)) | (m & np.uint64(0xFFFFFFFF))


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the ascending array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _pack(values: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), kind), dtype=kind)


# ---- slices

class Slice:
    """Documents of one file: ids, whether each is a later copy, and texts."""

    def __init__(self, uri: str):
        fs, path = pfs.FileSystem.from_uri(uri)
        with fs.open_input_file(path) as f:
            t = pa.ipc.open_file(f).read_all()
        self.doc = t["doc_id"].to_pylist()
        self.copy = t["copy"].to_pylist()
        self.text = t["text"]

    @staticmethod
    def write(uri: str, doc: list, copy: list, text: list) -> None:
        fs, path = pfs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        t = pa.table({"doc_id": pa.array(doc, pa.int64()), "copy": pa.array(copy, pa.bool_()), "text": pa.array(text, pa.large_binary())})
        with fs.open_output_stream(path) as f, pa.ipc.new_file(f, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t, max_chunksize=256)

    def contexts(self, shared: np.ndarray, hot: np.ndarray, shards: int, rules: Rules):
        """Distinct contexts of the suffixes in ``shared``: bytes -> [route, least doc]; and every document's
        places (first window, windows, context)."""
        found: dict[bytes, list] = {}
        places: dict[int, list[tuple[int, int, bytes]]] = {}
        for i, (doc, copy) in enumerate(zip(self.doc, self.copy)):
            if copy:
                continue
            text = self.text[i].as_py()
            m, start, count = pieces(text, rules)
            ids = _ids(m, shards)
            pick = np.flatnonzero(_within(ids, shared))
            if not len(pick):
                continue
            doc = NO_ID if doc is None else doc
            here = places.setdefault(i, [])
            route = (m[pick] % np.uint64(shards)).astype(np.int64)
            rows = zip(start[pick].tolist(), count[pick].tolist(), route.tolist(), _within(ids[pick], hot).tolist())
            for s, n, r, many in rows:
                for s, n in ([(s + k, 1) for k in range(n)] if many else [(s, n)]):
                    c = text[s:s + n - 1 + rules.length]
                    known = found.get(c)
                    if known is None:
                        if many:  # spread by the window itself
                            r = int(_string_hashes(np.frombuffer(c, np.uint8), rules.length)[0] % np.uint64(shards))
                        found[c] = [r, doc]
                    elif doc < known[1]:
                        known[1] = doc
                    here.append((s, n, c))
        return found, places


def _slices(folder: str, shards: int, rules: Rules):
    """Writes the slices; returns their sampled suffixes by shard, and a row for every slice (shard -1)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = ([], [], []), 0, 0

        def close() -> pa.RecordBatch:
            nonlocal number
            doc, copy, text = held
            name = TaskContext.get().taskAttemptId() << 20 | number
            number += 1
            Slice.write(f"{folder}/slice-{name}.arrow", doc, copy, text)
            keys = [np.unique(_ids(pieces(t, rules)[0], shards)) for t, c in zip(text, copy) if not c]
            keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            found, n = np.unique(keys, return_counts=True)
            shard = (found >> np.uint64(32)).astype(np.int64)
            at = np.searchsorted(shard, np.arange(shards + 1))
            rows = [(s, _pack(found[at[s]:at[s + 1]].astype(np.uint32))) for s in range(shards) if at[s] < at[s + 1]]
            rows.append((-1, _pack(found[n > 1])))  # suffixes that the slice itself holds twice
            return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.int64()), pa.array([s for s, _ in rows], pa.int32()),
                                               pa.array([k for _, k in rows], pa.binary())], ["slice", "shard", "keys"])

        for batch in batches:
            for i in range(batch.num_rows):
                text = (batch.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                for to, x in zip(held, (batch.column(0)[i].as_py(), bool(batch.column(2)[i].as_py()), text)):
                    to.append(x)
                size += len(text) + 64
                if size >= rules.slice_bytes:
                    yield close()
                    held, size = ([], [], []), 0
        if held[0]:
            yield close()
    return cut


# ---- the index family

def _scan(merge_levels: set[int], keep: bool):
    """Merge-scan of one shard: the batch's suffix array against itself and each level's."""
    def scan(batch: pa.Table) -> pa.Table:
        shard = batch["shard"][0].as_py()
        arrays: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for level, name, keys, slices in zip(*(batch[c].to_pylist() for c in ("level", "slice", "keys", "slices"))):
            k = _unpack(keys, np.uint32)
            s = np.frombuffer(zstandard.decompress(slices), np.int64) if slices is not None else np.full(len(k), name)
            arrays.setdefault(level, []).append((k, s))
        new = arrays.pop(-1, [])
        key, owner = (np.concatenate(x) for x in zip(*new)) if new else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = key[1:] == key[:-1]
        twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))[:len(key)] if len(key) else np.zeros(0, bool)
        told = []
        for parts in arrays.values():
            for k, s in parts:
                at = np.searchsorted(k, key)
                twice |= k[np.minimum(at, len(k) - 1)] == key
                at = np.searchsorted(key, k)
                hit = key[np.minimum(at, len(key) - 1)] == k if len(key) else np.zeros(len(k), bool)
                told.append((k[hit], s[hit]))
        told.append((key[twice], owner[twice]))
        k, s = (np.concatenate(x) for x in zip(*told))
        order = np.lexsort((k, s))
        k, s = k[order], s[order]
        cuts = np.concatenate(([0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)])) if len(s) else [0]
        rows = [(int(s[a]), False, _pack(np.unique(k[a:b])), None) for a, b in zip(cuts[:-1], cuts[1:])]
        if keep:
            both = [(key, owner)] + [x for level in merge_levels for x in arrays.get(level, [])]
            k, s = (np.concatenate(x) for x in zip(*both))
            if len(k):
                order = np.argsort(k, kind="stable")
                rows.append((None, True, _pack(k[order]), zstandard.compress(s[order].tobytes(), 1)))
        name, indexed, keys, slices = zip(*rows) if rows else ((), (), (), ())
        return pa.table({"slice": pa.array(name, pa.int64()), "shard": pa.array([shard] * len(rows), pa.int32()), "indexed": pa.array(indexed, pa.bool_()),
                         "keys": pa.array(keys, pa.binary()), "slices": pa.array(slices, pa.binary())})
    return scan


class IndexFamily:
    """Levels of sampled suffix arrays; a level of rank r holds 2**r batches."""

    def __init__(self, rules: Rules = Rules()):
        self.rules, self.levels = rules, []  # (rank, table of shard, keys, slices), highest rank first

    def add(self, batch: DataFrame, keep: bool = True) -> DataFrame:
        """Scan ``batch(slice, shard, keys)`` against itself and all levels, and add it; returns
        ``(slice, shard, keys)``, the suffixes found more than once. ``keep=False`` skips adding it."""
        rank, merged = 0, set()
        while self.levels and self.levels[-1 - len(merged)][0] == rank:
            merged.add(len(self.levels) - 1 - len(merged))
            rank += 1
            if len(merged) == len(self.levels):
                break
        rows = [batch.select("shard", F.lit(-1).alias("level"), "slice", "keys", F.lit(None).cast("binary").alias("slices"))]
        rows += [t.select("shard", F.lit(i).alias("level"), F.lit(None).cast("long").alias("slice"), "keys", "slices") for i, (_, t) in enumerate(self.levels)]
        out = stage(union_all(rows).groupBy("shard").applyInArrow(
            _scan(merged, keep), "slice long, shard int, indexed boolean, keys binary, slices binary"), "suffix-scan")
        if keep:
            self.levels = self.levels[:len(self.levels) - len(merged)] + [(rank, out.filter("indexed").select("shard", "keys", "slices"))]
        return out.filter("not indexed").select("slice", "shard", "keys")

    def hot(self) -> DataFrame:
        """``(id, n)`` of suffixes that more than ``hot_slices`` slices hold; call when all batches are kept."""
        most = self.rules.hot_slices

        def count(batch: pa.Table) -> pa.Table:
            keys, n = np.unique(np.concatenate([_unpack(x.as_py(), np.uint32) for x in batch["keys"]]), return_counts=True)
            return pa.table({"id": pa.array(keys[n > most].astype(np.int64) | (batch["shard"][0].as_py() << 32)), "n": pa.array(n[n > most])})

        return union_all([t for _, t in self.levels]).groupBy("shard").applyInArrow(count, "id long, n long")


# ---- contexts, answers, results

def _shared(batch: pa.Table) -> np.ndarray:
    """Ids of the suffixes reported to a slice."""
    out = [np.zeros(0, np.uint64)]
    for shard, keys in zip(batch["shard"].to_pylist(), batch["keys"].to_pylist()):
        if keys is not None:
            out.append(_unpack(keys, np.uint64) if shard < 0 else _unpack(keys, np.uint32).astype(np.uint64) | np.uint64(shard << 32))
    return np.unique(np.concatenate(out))


def _by_route(found: dict[bytes, list]) -> dict[int, list[bytes]]:
    routes: dict[int, list[bytes]] = {}
    for c, (r, _) in found.items():
        routes.setdefault(r, []).append(c)
    return routes


def _send(folder: str, hot, shards: int, rules: Rules):
    def send(batch: pa.Table) -> pa.Table:
        name = batch["slice"][0].as_py()
        found, _ = Slice(f"{folder}/slice-{name}.arrow").contexts(_shared(batch), hot.value, shards, rules)
        rows = [(r, np.array([len(c) for c in cs], np.uint8).tobytes(), np.array([found[c][1] for c in cs], np.int64).tobytes(), b"".join(cs))
                for r, cs in _by_route(found).items()]
        route, sizes, docs, data = zip(*rows) if rows else ((), (), (), ())
        return pa.table({"route": pa.array(route, pa.int32()), "slice": pa.array([name] * len(rows), pa.int64()), "sizes": pa.array(sizes, pa.binary()),
                         "docs": pa.array(docs, pa.binary()), "data": pa.array(data, pa.binary())})
    return send


def _window_classes(data: np.ndarray, at: np.ndarray, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows of ``data`` that begin ``at``, and where in it windows differ from the one before.

    Windows are ordered by their hash ``h``, and neighbours of one hash are compared by their bytes. Where a
    hash stands for several strings, its windows are ordered by their bytes.
    """
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))[:len(order)]
    every = np.lib.stride_tricks.sliding_window_view(data, size) if len(data) >= size else np.zeros((0, size), np.uint8)

    def differ(pairs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), bool)
        for i in range(0, len(pairs), 200_000):
            p = pairs[i:i + 200_000]
            out[i:i + 200_000] = (every[at[order[p]]] != every[at[order[p - 1]]]).any(axis=1)
        return out

    same = np.flatnonzero(~new)
    odd = same[differ(same)]
    if len(odd):
        group = np.cumsum(new) - 1
        for g in np.unique(group[odd]).tolist():  # one hash of several strings
            members = np.flatnonzero(group == g)
            order[members] = order[members][sorted(range(len(members)), key=lambda i: every[at[order[members[i]]]].tobytes())]
            new[members[1:]] = differ(members[1:])
    return order, new


def _answer(rules: Rules):
    """For every context a bit per window: does a document smaller than the context's least one have it?"""
    def answer(batch: pa.Table) -> pa.Table:
        hashes, docs, bit, first, cuts, places, shift = [], [], [], [], [0], [], 0
        for sizes, doc, data in zip(*(batch[c].to_pylist() for c in ("sizes", "docs", "data"))):
            sizes = np.frombuffer(sizes, np.uint8).astype(np.int64)
            windows = sizes - rules.length + 1
            h = _string_hashes(np.frombuffer(data, np.uint8), rules.length)
            ends = np.cumsum(windows)
            k = np.arange(ends[-1]) - np.repeat(ends - windows, windows)
            at = np.repeat(np.cumsum(sizes) - sizes, windows) + k
            hashes.append(h[at])
            places.append(at + shift)
            shift += len(data)
            docs.append(np.repeat(np.frombuffer(doc, np.int64), windows))
            bit.append(k.astype(np.uint32))
            first.append(cuts[-1] + ends - windows)
            cuts.append(cuts[-1] + int(ends[-1]))
        h, d = np.concatenate(hashes), np.concatenate(docs)
        text = np.frombuffer(b"".join(batch["data"].to_pylist()), np.uint8)
        order, new = _window_classes(text, np.concatenate(places), h, rules.length)
        least = np.minimum.reduceat(d[order], np.flatnonzero(new))
        smaller = np.empty(len(h), bool)
        smaller[order] = least[np.cumsum(new) - 1] < d[order]
        masks = np.bitwise_or.reduceat(smaller.astype(np.uint32) << np.concatenate(bit), np.concatenate(first))
        counts = np.cumsum([0] + [len(f) for f in first])
        return pa.table({"slice": batch["slice"], "shard": batch["route"], "keys": pa.nulls(batch.num_rows, pa.binary()),
                         "masks": pa.array([masks[a:b].tobytes() for a, b in zip(counts[:-1], counts[1:])], pa.binary())})
    return answer


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _finish(folder: str, hot, shards: int, rules: Rules, digest: bool):
    def finish(batch: pa.Table) -> pa.Table:
        part = Slice(f"{folder}/slice-{batch['slice'][0].as_py()}.arrow")
        found, places = part.contexts(_shared(batch), hot.value, shards, rules)
        routes, mask = _by_route(found), {}
        for route, masks in zip(batch["shard"].to_pylist(), batch["masks"].to_pylist()):
            if masks is not None:
                mask.update(zip(routes[route], np.frombuffer(masks, np.uint32).tolist()))
        rows = []
        for i, (doc, copy) in enumerate(zip(part.doc, part.copy)):
            text = part.text[i].as_py()
            n, gone, spans = len(text), 0, 0
            if copy and n >= rules.length:
                gone, spans, text = n, 1, b""
            elif i in places:
                own = NO_ID if doc is None else doc
                starts, counts, bits = [], [], []
                for s, k, c in places[i]:
                    b = (1 << k) - 1 if own > found[c][1] else mask[c]
                    if b:
                        starts.append(s)
                        counts.append(k)
                        bits.append(b)
                if starts:
                    counts = np.array(counts)
                    ends = np.cumsum(counts)
                    k = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
                    on = (np.repeat(np.array(bits, np.uint32), counts) >> k.astype(np.uint32)) & 1
                    change = np.zeros(n + 1, np.int32)
                    at = (np.repeat(np.array(starts), counts) + k)[on == 1]
                    np.add.at(change, at, 1)
                    np.add.at(change, at + rules.length, -1)
                    cover = np.cumsum(change[:n]) > 0
                    gone = int(cover.sum())
                    spans = int((cover & ~np.concatenate(([False], cover[:-1]))).sum())
                    text = np.frombuffer(text, np.uint8)[~cover].tobytes()
            rows.append((doc, n, gone, spans, hashlib.sha256(text).digest() if digest else text))
        doc, n, gone, spans, kept = zip(*rows)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})
    return finish


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules(), digest: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``, one row per row of ``df``; ``kept`` is what is left, as
    bytes (strings may be cut inside a character), or its sha256 with ``digest``."""
    spark = df.sparkSession
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_path(spark, "suffix-slices")
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), )
    docs = docs.withColumn("h", F.unhex(F.sha2("text", 256)))
    last = F.coalesce("doc_id", F.lit(NO_ID))
    copies = stage(docs.groupBy("h").agg(F.min(last).alias("least"), F.count("*").alias("n")).filter("n > 1").select("h", "least"), "suffix-copies")
    few = copies.count() <= rules.broadcast_rows
    marked = docs.join(F.broadcast(copies) if few else copies, "h", "left").select("doc_id", "text", (last > F.col("least")).alias("copy"))
    rows = stage(marked.mapInArrow(_slices(folder, shards, rules), "slice long, shard int, keys binary"), "suffix-batches")
    suffixes, own = rows.filter("shard >= 0"), rows.filter("shard < 0")

    family = IndexFamily(rules)
    number = F.pmod(F.xxhash64("slice"), F.lit(rules.batches))
    n = own.count()
    many = n > rules.hot_slices
    # reports are few bytes but stand for a slice's work, so every slice gets a partition of its own while there are not too many
    by_slice = lambda df: df.repartition(max(1, min(n, rules.slice_tasks)), "slice").groupBy("slice")
    reports = [family.add(suffixes.filter(number == b), keep=many or b + 1 < rules.batches) for b in range(rules.batches)]
    hot = np.zeros(0, np.uint64)
    if many:
        heaviest = stage(family.hot(), "suffix-hot").orderBy(F.desc("n"), "id").limit(rules.broadcast_rows)
        hot = heaviest.select("id").toArrow()["id"].to_numpy().astype(np.uint64)
    hot = spark.sparkContext.broadcast(np.sort(hot))

    told = union_all([own, *reports])
    sent = by_slice(told).applyInArrow(_send(folder, hot, shards, rules), "route int, slice long, sizes binary, docs binary, data binary")
    answers = sent.groupBy("route").applyInArrow(_answer(rules), "slice long, shard int, keys binary, masks binary")
    ready = told.withColumn("masks", F.lit(None).cast("binary")).unionByName(answers)
    return by_slice(ready).applyInArrow(_finish(folder, hot, shards, rules, digest), SCHEMA)
