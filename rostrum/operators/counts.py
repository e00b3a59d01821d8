"""Document-term counts and the removal of n-gram double counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grams as G
from ..functions.text import SECOND_PASS_PATTERN, class_bits, word_class
from .vocabulary import _known_hashes, _schema, known_grams, with_tokens

#: Characters of text whose counts one task holds: a few hundred thousand rows.
PART_CHARS = 4_000_000
#: Terms of a vocabulary, and n-grams with terms inside, that a task holds; more are joined.
MAX_HELD = 500_000


def text_parts(docs: DataFrame) -> int:
    """Partitions for the counts of ``docs``, by the length of the texts; those of few texts use the cores."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-chars // PART_CHARS), min(cores, chars // (PART_CHARS // 16)))


def document_term_counts(docs: DataFrame, vocab: DataFrame, n_max: int = 3, group: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, term_id, n, cnt)`` of the vocabulary terms, by the counting analyser.

    Rows are placed by document once; everything that follows per document (counting, de-overlap,
    sums, packing) keeps that placement and needs no further shuffle while the vocabulary is
    broadcast. The number of partitions follows the length of the texts, not the shuffled bytes: counts pack
    so well that few bytes are many rows, and all those sums hold them at once.
    """
    held, keys = _held(vocab, group), [*group, "doc_id"]
    known = _known_hashes(vocab) if held is not None else None
    if known is not None:
        cls, least = word_class(SECOND_PASS_PATTERN)
        bits = class_bits(docs.sparkSession, cls)
        rows = docs.select(*keys, F.lower("text").alias("text"))
        out = _schema("", rows, keys, "terms array<int>, counts array<int>")
        placed = rows.mapInArrow(lambda batches: G.count_words(batches, keys, G.table_of(bits), least, n_max, known, held), out)
        placed = placed.repartition(text_parts(docs), "doc_id")
        return placed.mapInArrow(lambda batches: G.merge_counts(batches, keys, held), _schema("", rows, keys, "term_id bigint, n int, cnt bigint"))
    tokens = with_tokens(docs.select(*group, "doc_id", "text"), SECOND_PASS_PATTERN)
    rows = known_grams(tokens, [*group, "doc_id"], (1, n_max), vocab)
    hits = rows.join(vocab.select(*group, "term", "term_id", "n"), [*group, "term"])
    placed = hits.select(*group, "doc_id", "term_id", "n", "cnt").repartition(text_parts(docs), "doc_id")
    return placed.groupBy(*group, "doc_id", "term_id", "n").agg(F.sum("cnt").alias("cnt"))


def _held(vocab: DataFrame, group: Sequence[str]) -> G.Vocabulary | None:
    """The vocabulary for tasks to hold; None where it is too large, or lists a term twice."""
    rows = vocab.select(*group, "term", F.col("term_id").cast("bigint").alias("term_id"), "n").filter("term is not null").limit(MAX_HELD + 1).toArrow()
    if len(rows) > MAX_HELD:
        return None
    held = G.Vocabulary(rows, list(group))
    return held if held.unique else None


def overlap_map(vocab: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(term_id, n, sub_id, sub_n, before)``: which vocabulary terms lie inside an n-gram.

    A term of 2+ tokens holds its distinct tokens; one of 3+ tokens also its distinct adjacent pairs.
    ``before`` tells whether the n-gram precedes the sub-term in vocabulary order.
    """
    big = vocab.filter("n > 1").withColumn("tok", F.split("term", " "))
    tail = F.slice("tok", 2, F.size("tok"))
    pairs = F.array_compact(F.zip_with("tok", tail, lambda a, b: F.concat(a, F.lit(" "), b)))
    subs = F.when(F.col("n") > 2, F.concat("tok", pairs)).otherwise(F.col("tok"))
    rows = big.select(*group, "term_id", "n", F.explode(F.array_distinct(subs)).alias("sub"))
    inner = vocab.select(*group, F.col("term").alias("sub"), F.col("term_id").alias("sub_id"), F.col("n").alias("sub_n"))
    return (rows.join(inner, [*group, "sub"])
            .select(*group, "term_id", "n", "sub_id", "sub_n", (F.col("term_id") < F.col("sub_id")).alias("before")))


def pack_overlaps(overlaps: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per n-gram with the arrays of its sub-pairs and sub-tokens (at most 2n-1 entries)."""
    sub = F.struct("sub_id", "before")
    return overlaps.groupBy(*group, "term_id").agg(
        F.collect_list(F.when((F.col("sub_n") == 2) & (F.col("n") > 2), sub)).alias("pairs"),
        F.collect_list(F.when(F.col("sub_n") == 1, F.struct("sub_id"))).alias("singles"))


def deoverlap(counts: DataFrame, packed: DataFrame, group: Sequence[str] = (), placed: bool = False) -> DataFrame:
    """Counts with each n-gram's occurrences taken off the terms inside it, clamped at zero.

    n-grams are applied in vocabulary order, each with its current value. Terms of 3+ tokens never
    change, so two sweeps give the result: pairs first, where ``eff`` is a pair's value at its own
    turn, then tokens. Each row sends its share to its sub-terms by an in-place explode and a sum per
    document and term.

    ``placed`` says that ``counts`` are just those of :func:`document_term_counts`, where all rows of a document lie in one
    bounded partition: tasks that can hold the overlaps then do both sweeps there.
    """
    g = list(group)
    keys = [*g, "doc_id"]
    if placed:
        found = packed.select(*g, "term_id", "pairs", "singles").limit(MAX_HELD + 1).toArrow()
        if len(found) <= MAX_HELD:
            held, rows = G.Overlaps(found, g), counts.select(*keys, "term_id", "n", "cnt")
            return rows.mapInArrow(lambda batches: G.take_off(batches, keys, held), _schema("", rows, keys, "term_id bigint, n int, cnt bigint"))
    joined = counts.join(packed, [*g, "term_id"], "left")
    none = F.array().cast("array<struct<id:bigint,n:int,c:bigint,all:bigint,before:bigint>>")
    zero = F.lit(0).cast("bigint")
    own = F.array(F.struct(F.col("term_id").alias("id"), F.col("n").cast("int").alias("n"), F.col("cnt").alias("c"),
                           zero.alias("all"), zero.alias("before")))
    to_pairs = F.transform("pairs", lambda s: F.struct(
        s["sub_id"].alias("id"), F.lit(2).alias("n"), zero.alias("c"), F.col("cnt").alias("all"),
        F.when(s["before"], F.col("cnt")).otherwise(zero).alias("before")))
    sent = joined.select(*keys, F.explode(F.concat(own, F.coalesce(to_pairs, none))).alias("r")).select(*keys, "r.*")
    after_pairs = sent.groupBy(*keys, "id", "n").agg(
        F.sum("c").alias("c"), F.sum("all").alias("off"), F.sum("before").alias("early"))
    cur = after_pairs.filter("c > 0").select(
        *keys, F.col("id").alias("term_id"), "n", (F.col("c") - F.col("off")).alias("left"),
        (F.col("c") - F.col("early")).alias("eff"))
    joined2 = cur.join(packed.select(*g, "term_id", "singles"), [*g, "term_id"], "left")
    none2 = F.array().cast("array<struct<id:bigint,n:int,c:bigint>>")
    own2 = F.array(F.struct(F.col("term_id").alias("id"), F.col("n").alias("n"), F.col("left").alias("c")))
    to_singles = F.transform("singles", lambda s: F.struct(
        s["sub_id"].alias("id"), F.lit(1).alias("n"), (-F.col("eff")).alias("c")))
    sent2 = joined2.select(*keys, F.explode(F.concat(own2, F.coalesce(to_singles, none2))).alias("r")).select(*keys, "r.*")
    final = sent2.groupBy(*keys, "id", "n").agg(F.greatest(F.sum("c"), zero).alias("cnt"))
    return final.filter("cnt > 0").select(*keys, F.col("id").alias("term_id"), "n", "cnt")


def nonempty_docs(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, total)`` of the documents that keep any count."""
    return counts.groupBy(*group, "doc_id").agg(F.sum("cnt").alias("total")).filter("total > 0")


def packed_docs(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per document: sorted term ids and their counts (bounded by the document's length)."""
    pairs = F.sort_array(F.collect_list(F.struct("term_id", F.col("cnt").cast("double").alias("cnt"))))
    p = counts.groupBy(*group, "doc_id").agg(pairs.alias("p"))
    return p.select(*group, "doc_id", F.transform("p", lambda x: x["term_id"].cast("int")).alias("idx"),
                    F.transform("p", lambda x: x["cnt"]).alias("val"))


def incidence(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Binary document-term rows."""
    return counts.filter("cnt > 0").select(*group, "doc_id", "term_id")
