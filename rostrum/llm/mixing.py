"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of shuffled documents, repeated up to ``repeats`` times. A document's virtual
finish time is its source's cumulative tokens divided by the source's target; serving documents by
finish time serves each source in proportion to its target. The mix is the order by finish time, cut
where the total budget is reached.

Targets share ``budget`` times all tokens by weight, none above ``repeats`` times its source's size; the
excess goes to the other sources by weight (water filling, solved in closed form over the sorted ratios).

Cumulative sums are two-level, so a hot source is never summed in one task: the shuffle key is a uniform
hash whose prefix is the bucket, sums run inside (source, bucket), and bucket totals give the offsets.
The budget cut is found the same way: tokens per range of finish time, then an order inside the one range
that holds the cut. Tables of sources, buckets and ranges are small by construction; no text is shuffled.

Defined results: sizes are words; null texts have size 0 and are never taken; a null source is a source
of its own, last in order. Repeated rows are queued once each. If all sizes are 0, targets are 0.
Same rows, same seed: same mix, on any partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import fresh


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources in code point order, repeated as often as needed.
    weights: tuple[int, ...] = (3, 1, 2)
    budget: float = 1.5
    repeats: int = 2
    seed: int = 17
    #: Rows that a bucket of one source, or a range of finish times, should hold.
    bucket_rows: int = 20_000


#: Runs of characters other than the white space x20, x09-x0D.
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Never null; null sorts last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def _shuffle_key(doc_id: Column, text: Column, seed: int) -> Column:
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), blank(doc_id), F.lit(":"), F.md5(blank(text))))


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``(src, n_rows, source_size, weight, target, budget)`` from ``sizes(src, size)``; one row per source."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    everywhere = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, mix.weights)),
                          (F.pmod(F.row_number().over(everywhere.orderBy("src")) - 1, F.lit(len(mix.weights))) + 1).cast("int"))
    cap = F.col("source_size") * mix.repeats
    filled = everywhere.orderBy(F.col("cap") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("weight") * ((F.col("budget") - F.col("caps_before")) / F.col("weight_left"))
    capped, free = F.when(F.col("capped"), F.col("cap")).otherwise(0), F.when(~F.col("capped"), F.col("weight"))
    rest = F.try_divide(F.col("budget") - F.sum(capped).over(everywhere), F.sum(free).over(everywhere))
    return (per.withColumn("weight", weight).withColumn("cap", cap)
            .withColumn("budget", F.lit(mix.budget) * F.sum("source_size").over(everywhere))
            .withColumn("caps_before", F.sum("cap").over(filled) - F.col("cap"))
            .withColumn("weight_left", F.sum("weight").over(everywhere) - F.sum("weight").over(filled) + F.col("weight"))
            .withColumn("capped", F.col("cap") <= share)
            .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * rest))
            .select("src", "n_rows", "source_size", "weight", "target", "budget"))


def plan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix()) -> DataFrame:
    """One row per row of ``df``: ``doc_id, src, h, size, source_size, target, finish`` (of the first
    round) and ``takes``, how often the mix takes the document."""
    c = lambda name: F.col(f"`{name}`")
    rows = stage(df.select(c(doc_id).alias("doc_id"), _source_key(c(source)).alias("src"), size_of(c(text)).alias("size"),
                           _shuffle_key(c(doc_id), c(text), mix.seed).alias("h")), "mix-rows")
    goals = stage(targets(rows, mix), "mix-targets")
    most, n, budget = goals.agg(F.max("n_rows"), F.sum("n_rows"), F.max("budget")).first()
    if n is None:
        return rows.select("doc_id", "src", "h", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"),
                           F.lit(0.0).alias("finish"), F.lit(0).alias("takes"))
    digits = max(1, math.ceil(math.log(max(most / mix.bucket_rows, 1), 16)))
    rows = rows.withColumn("bucket", F.substring("h", 1, digits))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(rows.groupBy("src", "bucket").agg(F.sum("size").alias("s"))
                    .select("src", "bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset")).join(goals, "src"), "mix-offsets")
    inside = Window.partitionBy("src", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("local", F.sum("size").over(inside))
    queued = stage(local.join(offsets, ["src", "bucket"]).select(
        "doc_id", "src", "h", "size", "source_size", "target", (F.col("offset") + F.col("local")).alias("cum")), "mix-queue")

    ranges = max(64, math.ceil(mix.repeats * n / mix.bucket_rows))
    position = lambda k: F.col("cum") + F.lit(k) * F.col("source_size")
    finish = lambda k: F.try_divide(position(k), F.col("target"))  # noqa: E731  (an empty source has target 0)
    at = lambda f: F.least(F.floor(f * ranges), F.lit(2 * ranges))
    served = queued.filter("size > 0").select("src", "size", F.explode(F.array(*[
        F.struct(finish(k).alias("f"), position(k).alias("pos")) for k in range(mix.repeats)])).alias("x")).select(
        "src", "size", "x.f", "x.pos", at(F.col("x.f")).alias("range"))
    runs = served.groupBy("range").agg(F.sum("size").alias("s")).withColumn(
        "upto", F.sum("s").over(Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, 0)))
    cut = runs.filter(F.col("upto") > budget).orderBy("range").select("range", F.col("upto") - F.col("s")).first()
    if cut is None:  # the budget covers every repeat
        took = [F.lit(1)] * mix.repeats
    else:
        order = Window.partitionBy("range").orderBy("f", "src", "pos").rowsBetween(Window.unboundedPreceding, 0)
        last = (served.filter(F.col("range") == cut[0]).withColumn("run", F.sum("size").over(order) + F.lit(cut[1]))
                .filter(F.col("run") <= budget).agg(F.max(F.struct("f", "src", "pos"))).first()[0])
        took = []
        for k in range(mix.repeats):
            early = at(finish(k)) < cut[0]
            if last is not None:
                edge = F.struct(finish(k).alias("f"), F.col("src"), position(k).alias("pos"))
                early = early | ((at(finish(k)) == cut[0]) & (edge <= F.struct(F.lit(last.f).alias("f"), F.lit(last.src).alias("src"), F.lit(last.pos).cast("long").alias("pos"))))
            took.append(early.cast("int"))
    takes = F.when(F.col("size") > 0, sum(took[1:], took[0])).otherwise(0)
    return queued.select("doc_id", "src", "h", "size", "source_size", "target", finish(0).alias("finish"), takes.alias("takes"))


def take(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix(), ordered: bool = True) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as the plan takes it; with ``ordered`` range-sorted by
    virtual finish time. Rows that agree in id, source and text share their takes evenly. A text moves once,
    to number such rows."""
    h, src, rank, t, hr, sr = (fresh(df, x) for x in ("mix_h", "mix_src", "mix_rank", "mix_take", "mix_plan_h", "mix_plan_src"))
    c = lambda name: F.col(f"`{name}`")
    keyed = df.select("*", _shuffle_key(c(doc_id), c(text), mix.seed).alias(h), _source_key(c(source)).alias(src))
    right = plan(df, doc_id, text, source, mix).groupBy(F.col("h").alias(hr), F.col("src").alias(sr)).agg(
        F.sum("takes").alias("n_takes"), F.count("*").alias("n_rows"), F.first("finish").alias("finish"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    right = right.filter("n_takes > 0").select(hr, sr, F.struct("n_takes", "n_rows", "finish", "source_size", "target").alias(t))
    both = keyed.join(right, (F.col(h) == F.col(hr)) & (F.col(src) == F.col(sr)))
    both = both.withColumn(rank, F.row_number().over(Window.partitionBy(h, src).orderBy(F.xxhash64(*[c(x) for x in df.columns]))))
    own = F.floor(F.col(f"{t}.n_takes") / F.col(f"{t}.n_rows")) + (F.col(rank) <= F.pmod(F.col(f"{t}.n_takes"), F.col(f"{t}.n_rows"))).cast("int")
    out = both.withColumn(rank, own.cast("int")).filter(F.col(rank) > 0).withColumn(rank, F.explode(F.sequence(F.lit(0), F.col(rank) - 1)))
    if ordered:
        out = out.orderBy(F.col(f"{t}.finish") + F.try_divide(F.col(rank) * F.col(f"{t}.source_size"), F.col(f"{t}.target")), src, h)
    return out.select(*[c(x) for x in df.columns])
