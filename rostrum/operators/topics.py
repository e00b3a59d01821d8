"""Topic term lists and the quality metrics over them.

A topic list is ``(topic_id, rank, term_id)`` with ranks 0..n-1, best first. All tables here have at
most K*n rows except the incidence rows of :func:`term_patterns`, which are combined per document
and topic before they leave a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """The n heaviest terms of each topic; equal weights go by term id."""
    w = Window.partitionBy("topic_id").orderBy(F.desc("weight"), "term_id")
    # filtered in this form, each task keeps its own n best before terms are shuffled by topic
    ranked = weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.select("topic_id", (F.col("rank") - 1).alias("rank"), "term_id", "weight")


def topic_terms(topics: DataFrame, vocab: DataFrame) -> DataFrame:
    """Topic lists with their term strings."""
    return topics.join(vocab.select("term_id", "term"), "term_id").select("topic_id", "rank", "term_id", "term")


def topic_lines(named: DataFrame, n: int = 50) -> DataFrame:
    """One text line per topic: its first n terms, best first."""
    terms = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return (named.filter(F.col("rank") < n).groupBy("topic_id").agg(terms.alias("t"))
            .select("topic_id", F.array_join(F.transform("t", lambda x: x["term"]), " ").alias("line")))


# --- overlap between topics -------------------------------------------------------------------

def topic_overlap(topics: DataFrame, n: int = 10) -> DataFrame:
    """``(topic_i, topic_j, overlap)`` for i < j with at least one shared top-n term."""
    t = topics.filter(F.col("rank") < n).select("topic_id", "term_id").distinct()
    a = t.select(F.col("topic_id").alias("topic_i"), "term_id")
    b = t.select(F.col("topic_id").alias("topic_j"), "term_id")
    return (a.join(b, "term_id").filter("topic_i < topic_j")
            .groupBy("topic_i", "topic_j").agg(F.count(F.lit(1)).alias("overlap")))


def _holders(topics: DataFrame, n: int) -> DataFrame:
    t = topics.filter(F.col("rank") < n).select("topic_id", "term_id")
    c = t.groupBy("term_id").agg(F.count_distinct("topic_id").alias("holders"))
    return t.join(c, "term_id")


def topic_uniqueness(topics: DataFrame, n: int = 10) -> DataFrame:
    """Mean over a topic's terms of 1 / number of topics that hold the term."""
    return _holders(topics, n).groupBy("topic_id").agg((F.sum(F.lit(1.0) / F.col("holders")) / n).alias("tu"))


def topic_redundancy(topics: DataFrame, num_topics: int, n: int = 10) -> DataFrame:
    """Sum over a topic's terms of the other topics that hold it, over K - 1."""
    return _holders(topics, n).groupBy("topic_id").agg((F.sum(F.col("holders") - 1) / F.lit(float(num_topics - 1))).alias("tr"))


def overlap_edges(topics: DataFrame, n: int = 10, compat: bool = False) -> DataFrame:
    """De-duplicated overlap edges ``(pos_i, pos_j, size)``.

    Topics take positions by total overlap, largest first (ties: larger topic id). Each topic visits
    the later topics by overlap (ties: later position) and keeps an edge when none of its shared
    terms was used by an edge it kept before. ``compat=True`` checks the terms shared by the topics
    whose *ids* equal the two positions, as the original implementation does.
    """
    t = topics.filter(F.col("rank") < n).select("topic_id", "term_id").distinct()
    lists = t.groupBy("topic_id").agg(F.collect_list("term_id").alias("terms"))
    ov = topic_overlap(topics, n)
    both = ov.select(F.col("topic_i").alias("topic_id"), "overlap").unionAll(ov.select(F.col("topic_j").alias("topic_id"), "overlap"))
    total = lists.join(both.groupBy("topic_id").agg(F.sum("overlap").alias("o")), "topic_id", "left")
    pos = total.select("topic_id", "terms", (F.row_number().over(
        Window.orderBy(F.desc(F.coalesce("o", F.lit(0))), F.desc("topic_id"))) - 1).alias("pos"))
    # Only topic pairs that share a term can form an edge.
    p = pos.select("topic_id", "pos")
    edges = (ov.join(p.select(F.col("topic_id").alias("topic_i"), F.col("pos").alias("p1")), "topic_i")
             .join(p.select(F.col("topic_id").alias("topic_j"), F.col("pos").alias("p2")), "topic_j")
             .select(F.least("p1", "p2").alias("pos_i"), F.greatest("p1", "p2").alias("pos_j"), "overlap"))
    key = "topic_id" if compat else "pos"
    left = pos.select(F.col(key).alias("pos_i"), F.col("terms").alias("ti"))
    right = pos.select(F.col(key).alias("pos_j"), F.col("terms").alias("tj"))
    edges = edges.join(left, "pos_i").join(right, "pos_j").withColumn("words", F.array_intersect("ti", "tj"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("overlap")).alias("a"), (-F.col("pos_j")).alias("b"), "words")))
    rows = edges.groupBy("pos_i").agg(order.alias("e"))
    start = F.struct(F.array().cast("array<bigint>").alias("used"), F.array().cast("array<struct<j:bigint,s:bigint>>").alias("kept"))

    def visit(acc: Column, e: Column) -> Column:
        words = e["words"].cast("array<bigint>")
        kept = F.array(F.struct((-e["b"]).cast("bigint").alias("j"), (-e["a"]).cast("bigint").alias("s")))
        take = F.struct(F.concat(acc["used"], words).alias("used"), F.concat(acc["kept"], kept).alias("kept"))
        return F.when(F.arrays_overlap(acc["used"], words), acc).otherwise(take)

    kept = rows.select(F.col("pos_i").cast("bigint").alias("pos_i"), F.explode(F.aggregate("e", start, visit)["kept"]).alias("k"))
    return kept.select("pos_i", F.col("k.j").alias("pos_j"), F.col("k.s").alias("size"))


def overlap_score(topics: DataFrame, num_topics: int, n: int = 10, multiplier: float = 2.0, compat: bool = False) -> DataFrame:
    """``(to, entire_overlaps)``: edge sizes weighted from 1/multiplier up to n, over n (K - 1)."""
    e = overlap_edges(topics, n, compat)
    first = 1.0 / multiplier
    step = (n - first) / (n - 1) if n > 1 else 0.0
    weight = F.lit(first) + (F.col("size") - 1) * F.lit(step)
    return e.agg((F.coalesce(F.sum(weight), F.lit(0.0)) / F.lit(float(n * (num_topics - 1)))).alias("to"),
                 F.count_if(F.col("size") == n).alias("entire_overlaps"))


# --- coherence --------------------------------------------------------------------------------

def term_patterns(inc: DataFrame, topics: DataFrame, n: int = 10) -> DataFrame:
    """``(topic_id, present, docs)``: how many documents hold exactly this subset of a topic's top terms.

    Grouping documents by subset replaces pairing terms inside every document: pairs are later read
    off the distinct subsets.
    """
    t = topics.filter(F.col("rank") < n).select("topic_id", "rank", "term_id")
    hits = inc.select("doc_id", "term_id").join(t, "term_id")
    per_doc = hits.groupBy("doc_id", "topic_id").agg(F.array_sort(F.collect_set("rank")).alias("present"))
    return per_doc.groupBy("topic_id", "present").agg(F.count(F.lit(1)).alias("docs"))


def _pair_list(topics: DataFrame, n: int) -> DataFrame:
    """The n(n-1)/2 rank pairs of each topic, which define the metric."""
    t = topics.filter(F.col("rank") < n)
    terms = F.sort_array(F.collect_list(F.struct("rank", "term_id")))
    per = t.groupBy("topic_id").agg(terms.alias("t"))
    i = per.select("topic_id", "t", F.posexplode("t").alias("i", "a"))
    later = F.slice("t", F.col("i") + 2, F.size("t"))
    return i.select("topic_id", "a", F.explode(later).alias("b")).select(
        "topic_id", F.col("a.rank").alias("rank_i"), F.col("b.rank").alias("rank_j"),
        F.col("a.term_id").alias("term_i"), F.col("b.term_id").alias("term_j"))


def pair_cooccurrence(inc: DataFrame, topics: DataFrame, n: int = 10) -> DataFrame:
    """Document counts per top-n pair of each topic: ``c_i``, ``c_j`` and ``c_ij``.

    Every pattern emits the pairs it holds with its number of documents; all joins are on at most
    n(n+1)/2 sums per topic.
    """
    seen = lambda a: F.transform(F.filter("present", lambda b: b >= a), lambda b: F.struct(a.alias("i"), b.alias("j")))
    found = term_patterns(inc, topics, n).select("topic_id", "docs", F.explode(F.flatten(F.transform("present", seen))).alias("p"))
    counted = found.groupBy("topic_id", "p.i", "p.j").agg(F.sum("docs").alias("c"))
    of = lambda i, j, c: counted.select("topic_id", F.col("i").alias(i), F.col("j").alias(j), F.col("c").alias(c))
    single = lambda rank, c: counted.filter("i = j").select("topic_id", F.col("i").alias(rank), F.col("c").alias(c))
    pairs = (_pair_list(topics, n).join(single("rank_i", "c_i"), ["topic_id", "rank_i"], "left")
             .join(single("rank_j", "c_j"), ["topic_id", "rank_j"], "left")
             .join(of("rank_i", "rank_j", "c_ij"), ["topic_id", "rank_i", "rank_j"], "left"))
    none = F.lit(0).cast("bigint")
    return pairs.select("topic_id", "rank_i", "rank_j", "term_i", "term_j", *[F.coalesce(c, none).alias(c) for c in ("c_i", "c_j", "c_ij")])


def npmi(pairs: DataFrame, num_docs: Column) -> DataFrame:
    """Mean normalised pointwise mutual information of each topic's pairs.

    0 for a pair never seen together; NaN for a pair present in every document.
    """
    n, c = num_docs.cast("double"), F.col("c_ij").cast("double")
    value = F.when(F.col("c_ij") == 0, F.lit(0.0)).when(c == n, F.lit(float("nan"))).otherwise(
        (F.ln(n) + F.ln(c) - F.ln(F.col("c_i").cast("double")) - F.ln(F.col("c_j").cast("double"))) / (F.ln(n) - F.ln(c)))
    return pairs.withColumn("npmi", value).groupBy("topic_id").agg(F.avg("npmi").alias("npmi"))


def topic_metrics(inc: DataFrame, topics: DataFrame, num_docs: Column, num_topics: int, n: int = 10, compat: bool = False) -> DataFrame:
    """One row: ``npmi_mean``, ``tu_mean``, ``to``, ``entire_overlaps``."""
    np_ = npmi(pair_cooccurrence(inc, topics, n), num_docs).agg(F.avg("npmi").alias("npmi_mean"))
    tu = topic_uniqueness(topics, n).agg(F.avg("tu").alias("tu_mean"))
    return overlap_score(topics, num_topics, n, compat=compat).select(
        np_.scalar().alias("npmi_mean"), tu.scalar().alias("tu_mean"), "to", "entire_overlaps")


# --- runs -------------------------------------------------------------------------------------

def run_summary(metrics: DataFrame, column: str = "npmi_mean") -> DataFrame:
    """Mean and sample standard deviation of a metric over runs."""
    return metrics.agg(F.count(F.lit(1)).alias("n_runs"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def best_run(metrics: DataFrame, score: Column) -> DataFrame:
    """The run with the highest score; equal scores go to the smaller seed."""
    s = metrics.withColumn("score", score)
    return s.agg(F.max_by("seed", F.struct("score", -F.col("seed"))).alias("seed"), F.max("score").alias("score"))


def snapshot_scores(inc: DataFrame, snapshots: DataFrame, num_docs: Column, n: int = 10) -> DataFrame:
    """``(step, score)``: mean coherence of the topics of every step of a fit.

    ``snapshots(step, topic_id, rank, term_id)``. Lists that occur at several steps are scored once, and all of
    them in one pass over the incidence rows.
    """
    lists = snapshots.filter(F.col("rank") < n).groupBy("step", "topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term_id"))).alias("terms"))
    span = F.lit(snapshots.agg(F.max("topic_id")).first()[0] or 0).cast("bigint") + 1
    distinct = lists.groupBy("terms").agg(F.min(F.col("step") * span + F.col("topic_id")).alias("list_id"))
    topics = distinct.select(F.col("list_id").alias("topic_id"), F.explode("terms").alias("t")).select("topic_id", "t.rank", "t.term_id")
    scores = npmi(pair_cooccurrence(inc, topics, n), num_docs).withColumnRenamed("topic_id", "list_id")
    return lists.join(distinct, "terms").join(scores, "list_id").groupBy("step").agg(F.avg("npmi").alias("score"))


def best_snapshot(snapshots: DataFrame, scores: DataFrame) -> DataFrame:
    """The topics ``(step, score, topic_id, rank, term_id)`` of the step with the highest score, the first of equal ones."""
    best = scores.agg(F.max_by("step", F.struct("score", -F.col("step"))).alias("step"), F.max("score").alias("score"))
    return snapshots.join(F.broadcast(best), "step").select("step", "score", "topic_id", "rank", "term_id")


def eval_split(docs: DataFrame, share: float, seed: int = 42) -> DataFrame:
    """Add ``is_eval``: a random but repeatable share of the documents, by a hash of seed and id."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id")).cast("binary"))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
    return docs.withColumn("is_eval", u < F.lit(share))
