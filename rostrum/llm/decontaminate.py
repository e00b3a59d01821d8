"""Benchmark decontamination as a prefix-filtered containment join.

Every benchmark item is cut into windows of ``width`` consecutive words (a shorter item is one window).
A document contains a window only if it contains all of its words, so for exact containment a prefix of
one token is necessary: the window's rarest word, by its document frequency over the whole corpus. The
join is driven by those words. An occurrence of one fixes where the window would have to start (position
bound) and it must fit into the document (length bound); what is left is compared word by word.

The windows are indexed by their prefix word and sent to the tasks in blocks of at most ``block_chars``
characters of items: one block is the usual case and needs no shuffle of documents; more blocks each pass
over the documents, return the matched rows only, and are merged by document.

Defined results: null, empty and word-free texts have no words and no hits; items without words or without
an id match nothing; rows that repeat an item id count as one item; repeated document rows give repeated
results. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import fresh, strings, union_all


@dataclass(frozen=True)
class Rules:
    width: int = 13
    #: A document is contaminated if at least one word in ``one_in`` is hit.
    one_in: int = 20
    block_chars: int = 4_000_000


#: Words are runs of 0-9, a-z and everything beyond ASCII, after A-Z are lowered; on UTF-8 bytes.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
              for c in range(256))

Index = dict[bytes, list[tuple[int, int, list[bytes], tuple[int, ...]]]]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def rarity(docs: DataFrame, text: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Document frequency of the words of one block of items."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in strings(batch.column(0)):
                seen.update(known.value.intersection(words_of(t)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    found = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in found.collect()}


def build(items: list[tuple[int, list[bytes]]], counts: dict[bytes, int], width: int) -> Index:
    """prefix word -> (its offset in the window, the window's start in the item, the item's words, item ids)."""
    owners: dict[tuple[bytes, ...], tuple[int, list[bytes], list[int]]] = {}
    for item_id, words in items:
        for s in range(max(len(words) - width, 0) + 1):
            window = tuple(words[s:s + width])
            owners.setdefault(window, (s, words, []))[2].append(item_id)
    index: Index = defaultdict(list)
    for window, (s, words, ids) in owners.items():
        offset = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i], i))
        if counts.get(window[offset], 0):  # a word that no document has: the window occurs nowhere
            index[window[offset]].append((offset, s, words, tuple(sorted(set(ids)))))
    return dict(index)


def scan(words: list[bytes], index: Index, width: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Hit spans (start, end) in order of their prefix word, and the ids of the items found."""
    spans, items = [], set()
    for i in [i for i, w in enumerate(words) if w in index]:
        for offset, s, item, ids in index[words[i]]:
            start, size = i - offset, min(width, len(item))
            if start >= 0 and start + size <= len(words) and words[start:start + size] == item[s:s + size]:
                spans.append((start, start + size))
                items.update(ids)
    return spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _blocks(docs: DataFrame, text: str, bench: DataFrame, rules: Rules) -> Iterator[object]:
    """Broadcast indexes of the benchmark, one bounded block of items at a time."""
    items = bench.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // rules.block_chars))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = [(r.item_id, w) for r in part.distinct().collect() if (w := words_of(r.text))]
        counts = rarity(docs, text, {w for _, words in rows for w in words}) if rows else {}
        yield docs.sparkSession.sparkContext.broadcast(build(rows, counts, rules.width))


def _matches(text: Column, index, rules: Rules) -> Column:
    @F.arrow_udf("n_words long, n_hit long, items array<long>, spans array<long>")
    def match(column: pa.Array) -> pa.Array:
        n, hit, items, spans = [], [], [], []
        for t in strings(column):
            words = words_of(t)
            s, ids = scan(words, index.value, rules.width)
            n.append(len(words))
            hit.append(covered(s))
            items.append(sorted(ids))
            spans.append([x for pair in s for x in pair])
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(spans, pa.list_(pa.int64()))],
            ["n_words", "n_hit", "items", "spans"])

    return match(text.cast("string"))


def _covered_column(spans: Column) -> Column:
    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        return pa.array([covered(list(zip(x[::2], x[1::2]))) for x in column.to_pylist()], pa.int64())

    return count(spans)


def with_hits(df: DataFrame, bench: DataFrame, out: str = "hits", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``df`` with the struct ``out(n_words, n_hit, items, contaminated)``; ``out`` must be a new name.

    ``bench`` has ``item_id`` and ``text``.
    """
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already")
    source = F.col(f"`{text}`")
    found = fresh(df, f"{out}_found")
    indexes = list(_blocks(df, text, bench, rules))
    if len(indexes) == 1:
        matched = df.select("*", _matches(source, indexes[0], rules).alias(found))
    else:  # equal texts have equal results, so rows meet their matches by text
        key, clean, of = (fresh(df, f"{out}_{x}") for x in ("key", "clean", "of"))
        hashed = F.sha2(source.cast("string"), 256)
        parts = [df.select(hashed.alias(key), _matches(source, x, rules).alias(found)).filter(F.size(f"{found}.items") > 0) for x in indexes]
        merged = union_all(parts).distinct().groupBy(key).agg(
            F.max(f"{found}.n_words").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{found}.items")))).alias("i"),
            F.flatten(F.collect_list(f"{found}.spans")).alias("s"))
        merged = stage(merged.select(F.col(key).alias(of), F.struct(
            F.col("n").alias("n_words"), _covered_column(F.col("s")).alias("n_hit"), F.col("i").alias("items"), F.col("s").alias("spans")).alias(found)),
            "benchmark-matches")
        none = _matches(source, df.sparkSession.sparkContext.broadcast({}), rules)
        matched = df.select("*", hashed.alias(key), none.alias(clean)).join(merged, F.col(key) == F.col(of), "left")
        matched = matched.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col(found), F.col(clean)).alias(found))
    n_words, n_hit = F.col(f"{found}.n_words"), F.col(f"{found}.n_hit")
    verdict = (n_hit > 0) & (F.lit(rules.one_in) * n_hit >= n_words)
    return matched.select(*[F.col(f"`{c}`") for c in df.columns], F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"), F.col(f"{found}.items").alias("items"), verdict.alias("contaminated")).alias(out))


def items_digest(items: Column) -> Column:
    """sha256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)
