"""Matching a filtered list of texts back to the rows it was taken from.

Texts are compared by their sha256 and fetched once at the end; everything between moves numbers and digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .ids import range_ids, running_sums

NO_SUBSET = "the filtered list is not an ordered subset of the original"


def _digest(text: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def _with_texts(matched: DataFrame, original: DataFrame) -> DataFrame:
    return matched.join(original.select("pos", "text"), "pos").select("rank", "pos", "text")


def ordered_subset(original: DataFrame, filtered: DataFrame) -> DataFrame:
    """Rows ``(rank, pos, text)`` of ``original`` that make up ``filtered``, both ordered by ``pos``.

    Valid where a text is kept at all of its positions or at none, as any rule on the text alone
    gives. The k-th kept row must then equal the k-th filtered row; anything else raises, since the
    list is no such subset. :func:`ordered_subset_greedy` takes any subset.
    """
    given = stage(filtered.select("pos", _digest("text").alias("given")), "filtered-digests")
    rows = stage(original.select("pos", _digest("text").alias("digest")), "original-digests")
    kept = range_ids(rows.join(given.select(F.col("given").alias("digest")).distinct(), "digest", "left_semi"), "pos", "rank")
    both = kept.join(range_ids(given, "pos", "rank").drop("pos"), "rank", "full")
    ok = F.col("digest").eqNullSafe(F.col("given"))
    checked = both.select("rank", F.when(ok, F.col("pos")).otherwise(F.raise_error(F.lit(NO_SUBSET)).cast("bigint")).alias("pos"))
    return _with_texts(checked, original)


# --- greedy matching ----------------------------------------------------------------------------

#: Filtered rows that one task walks at a time, and rows of the original in one step of its window.
BLOCK = 20_000


def _walk(items: np.ndarray, places: np.ndarray, texts: np.ndarray, after: int) -> np.ndarray | None:
    """For each item the first place behind the match of the item before it; None where one has none."""
    out, at = np.empty(len(items), np.int64), int(np.searchsorted(places, after, side="right"))
    wanted, there, n = items.tolist(), texts.tolist(), len(places)
    for i, x in enumerate(wanted):
        while at < n and there[at] != x:
            at += 1
        if at == n:
            return None
        out[i] = places[at]
        at += 1
    return out


def block_map(items: np.ndarray, places: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The map of a block of items: from the place of its first match to that of its last one.

    The map never falls. Of the starts that end alike only the last is kept: a walk that enters between two
    kept starts ends like the later one.
    """
    where = {x: places[texts == x] for x in np.unique(items).tolist()}
    starts = where[int(items[0])]
    ends = starts
    for x in items[1:].tolist():
        nxt = np.searchsorted(where[x], ends, side="right")
        fits = nxt < len(where[x])
        starts, ends = starts[fits], where[x][nxt[fits]]
        last = np.append(ends[1:] != ends[:-1], True)[:len(ends)]
        starts, ends = starts[last], ends[last]
    return starts, ends


def _pieces(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Items (order, text) and places (place, text) of a group, both in order; texts as numbers."""
    codes = table["digest"].combine_chunks().dictionary_encode().indices.to_numpy()
    at, item = table["at"].to_numpy(), table["item"].to_numpy(zero_copy_only=False)
    order = np.argsort(at, kind="stable")
    at, codes, item = at[order], codes[order], item[order]
    return at[item], codes[item], at[~item], codes[~item]


def _short(rows: DataFrame) -> DataFrame:
    """``(at, place)`` of the items of short segments; many segments are walked in one group."""
    def walk(batch: pa.Table) -> pa.Table:
        segment = batch["segment"].to_numpy()
        order = np.argsort(segment, kind="stable")
        cuts = np.flatnonzero(np.diff(segment[order])) + 1
        batch = batch.take(pa.array(order))
        found = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
            items, texts, places, there = _pieces(batch.slice(lo, hi - lo))
            got = _walk(texts, places, there, -1)
            if got is None:
                raise ValueError(NO_SUBSET)
            found.append((items, got))
        return pa.table({"at": np.concatenate([x for x, _ in found]), "place": np.concatenate([x for _, x in found])})

    return rows.groupBy("chunk").applyInArrow(walk, "at long, place long")


def _windows(items: DataFrame, places: DataFrame, block: int) -> DataFrame:
    """Items of long segments by block, and with each block the places that its items can match."""
    ends = items.groupBy("segment", "block").agg(F.min_by("low", "at").alias("low"), F.max_by("high", "at").alias("high"))
    step = lambda c: F.floor(c / F.lit(block))
    spans = ends.withColumn("bucket", F.explode(F.sequence(step(F.col("low")), step(F.col("high")))))
    near = places.withColumn("bucket", step(F.col("at"))).join(spans, ["segment", "bucket"]).filter("at between low and high")
    return items.select("segment", "block", "at", "digest", F.lit(True).alias("item")).unionByName(
        near.select("segment", "block", "at", "digest", F.lit(False).alias("item")))


def _compose(left: DataFrame, right: DataFrame) -> DataFrame:
    """Maps of neighbouring blocks, one after the other; a left map without a right one stays."""
    def join(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows:
            return a
        a = a.sort_by("start")
        if b.num_rows:
            b = b.sort_by("start")
            starts, after = b["start"].to_numpy(), b["end"].to_numpy()
            nxt = np.searchsorted(starts, a["end"].to_numpy(), side="right")
            fits = nxt < len(starts)
            a = a.filter(pa.array(fits))
            ends = after[nxt[fits]]
            last = np.append(ends[1:] != ends[:-1], True)[:len(ends)]
            a = a.set_column(a.column_names.index("end"), "end", pa.array(ends)).filter(pa.array(last))
        return a.select(["segment", "block", "start", "end"])

    return left.groupBy("segment", "block").cogroup(right.groupBy("segment", "block")).applyInArrow(join, "segment long, block long, start long, end long")


def _entries(maps: DataFrame, segments: DataFrame) -> DataFrame:
    """``(segment, block, after)``: the place behind which each block's walk begins.

    Maps are composed in pairs up to one per segment; on the way down a left half begins where both
    begin, a right half where the left one's map ends.
    """
    levels = [maps]
    most = segments.agg(F.max("blocks")).first()[0]
    while (1 << len(levels) - 1) < most:
        here = levels[-1]
        half = lambda side: here.filter(F.col("block") % 2 == side).withColumn("block", F.floor(F.col("block") / 2))  # noqa: B023, E731
        levels.append(stage(_compose(half(0), half(1)), "align-maps"))
    begin = segments.select("segment", F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("after"))
    for level in reversed(levels[:-1]):
        left = begin.select("segment", (F.col("block") * 2).alias("block"), "after")
        passed = left.join(level, ["segment", "block"]).filter("start > after").groupBy("segment", "block").agg(F.min_by("end", "start").alias("after"))
        right = passed.select("segment", (F.col("block") + 1).alias("block"), "after")
        begin = stage(left.unionByName(right), "align-entries")
    return begin


def _long(items: DataFrame, places: DataFrame, block: int) -> DataFrame:
    """``(at, place)`` of the items of long segments: maps by block, then every block from its own start."""
    blocks = stage(items.select("segment", "at", "digest", "low", "high", F.floor(F.col("number") / F.lit(block)).alias("block")), "align-blocks")
    rows = stage(_windows(blocks, places, block), "align-windows")

    def to_map(key: tuple, group: pa.Table) -> pa.Table:
        _, texts, where, there = _pieces(group)
        starts, ends = block_map(texts, where, there)
        of = lambda i: np.full(len(starts), key[i].as_py(), np.int64)
        return pa.table({"segment": of(0), "block": of(1), "start": starts, "end": ends})

    maps = stage(rows.groupBy("segment", "block").applyInArrow(to_map, "segment long, block long, start long, end long"), "align-maps")
    segments = stage(blocks.groupBy("segment").agg((F.max("block") + 1).alias("blocks")), "align-segments")
    begin = _entries(maps, segments)

    def solve(group: pa.Table) -> pa.Table:
        after = group["after"].drop_null()
        items, texts, where, there = _pieces(group)
        got = _walk(texts, where, there, after[0].as_py()) if len(after) and len(items) else None
        if got is None and len(items):
            raise ValueError(NO_SUBSET)
        return pa.table({"at": items, "place": got if got is not None else items})

    # left: a block that no walk enters means that the list does not fit
    return rows.join(begin, ["segment", "block"], "left").groupBy("segment", "block").applyInArrow(solve, "at long, place long")


def _segments(spots: DataFrame, anchors: DataFrame, name: str) -> DataFrame:
    """``spots(pos, ...)`` with the number of anchors before them, and ``at``, their place among themselves."""
    blank = [c for c in spots.columns if c != "pos"]
    marks = anchors.select("pos", *[F.lit(None).cast(spots.schema[c].dataType).alias(c) for c in blank], F.lit(1).alias("mark"))
    rows = spots.withColumn("mark", F.lit(0)).unionByName(marks)
    counted = running_sums(rows, "pos", {"segment": F.col("mark"), "upto": 1 - F.col("mark")})
    return stage(counted.filter("mark = 0").select(*spots.columns, "segment", (F.col("upto") - 1).alias("at")), name)


def ordered_subset_greedy(original: DataFrame, filtered: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows ``(rank, pos, text)`` of ``original`` that a greedy walk matches to ``filtered``, both ordered by unique ``pos``.

    Every filtered row takes the first row of its text behind the match of the row before it. A text may be
    kept at any of its places; a list that does not fit raises. Null texts equal each other.

    A text that is kept at all of its places has no choice: its k-th filtered row is its k-th row. These
    anchors cut both lists into segments, which are walked apart from each other. A long segment is cut into
    blocks of items; each block gives the map from its first match to its last one, and as such maps compose,
    pairs of blocks, pairs of pairs and so on say where every block starts. The k-th of F kept rows among O
    lies between the k-th and the (k + O - F)-th, so a block needs the rows of its own window only.
    """
    rows = stage(original.select("pos", _digest("text").alias("digest")), "original-digests")
    given = stage(filtered.select("pos", _digest("text").alias("digest")), "filtered-digests")
    sizes = given.groupBy("digest").agg(F.count("*").alias("f")).join(rows.groupBy("digest").agg(F.count("*").alias("o")), "digest", "left")
    stop = F.raise_error(F.lit(NO_SUBSET)).cast("bigint")
    sizes = stage(sizes.select("digest", F.when(F.coalesce("o", F.lit(0)) >= F.col("f"), F.col("o") - F.col("f")).otherwise(stop).alias("spare")), "align-sizes")
    seen = stage(range_ids(rows.join(sizes, "digest"), "pos", "k", ["digest"]), "align-original")
    kept = stage(range_ids(given.join(sizes, "digest"), "pos", "k", ["digest"]), "align-filtered")

    sure = kept.filter("spare = 0").select("digest", "k", F.col("pos").alias("line"))
    anchors = stage(sure.join(seen.filter("spare = 0").select("digest", "k", "pos"), ["digest", "k"]).select("line", "pos"), "align-anchors")
    # anchors must rise together in both lists
    by_line, by_pos = range_ids(anchors, "line", "a").select("line", "pos", "a"), range_ids(anchors.select("pos"), "pos", "b")
    fixed = by_line.join(by_pos, "pos").select("line", F.when(F.col("a") == F.col("b"), F.col("pos")).otherwise(stop).alias("pos"))

    if sizes.filter("spare > 0").isEmpty():
        return _with_texts(range_ids(stage(fixed, "align-matched"), "line", "rank").select("rank", "pos"), original)
    places = _segments(seen.filter("spare > 0").select("pos", "digest", "k"), anchors.select("pos"), "align-places")
    lines = _segments(kept.filter("spare > 0").select("pos", "digest", "k", "spare"), anchors.select(F.col("line").alias("pos")), "align-lines")
    # a line's window, from its k-th to its (k + spare)-th place, cut to its segment
    spot = lambda k, at: places.select("digest", F.col("k").alias(k), F.col("at").alias(at))
    windows = lines.withColumn("k2", F.col("k") + F.col("spare")).join(spot("k", "low"), ["digest", "k"]).join(spot("k2", "high"), ["digest", "k2"])
    edges = stage(places.groupBy("segment").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n_places")), "align-edges")
    counts = lines.groupBy("segment").agg(F.count("*").alias("n_lines"), F.min("at").alias("first_line"))
    known = stage(counts.join(edges, "segment", "left").withColumn(
        "long", (F.col("n_lines") > block) | (F.coalesce("n_places", F.lit(0)) > 4 * block)), "align-segments")
    items = stage(windows.join(known, "segment").select(
        "segment", "pos", "at", "digest", "long", "first", (F.col("at") - F.col("first_line")).alias("number"), F.col("first_line"),
        F.greatest("low", "first").alias("low"), F.least("high", "last").alias("high")), "align-items")

    # short segments that begin in one stretch of places share a group, which is thereby bounded
    chunk = F.floor(F.coalesce("first", "first_line") / F.lit(4 * block)).alias("chunk")
    lists = places.join(known, "segment")
    here = lambda df, item: df.filter("not long").select("segment", chunk, "at", "digest", F.lit(item).alias("item"))
    matched = _short(here(items, True).unionByName(here(lists, False)))
    if not known.filter("long").isEmpty():
        matched = matched.unionByName(_long(items.filter("long"), lists.filter("long").select("segment", "at", "digest"), block))
    free = matched.join(items.select("at", F.col("pos").alias("line")), "at").join(places.select(F.col("at").alias("place"), "pos"), "place").select("line", "pos")
    every = stage(fixed.unionByName(free), "align-matched")
    return _with_texts(range_ids(every, "line", "rank").select("rank", "pos"), original)
