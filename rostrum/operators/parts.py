"""Documents in parts, and the rows of a term table that each part needs.

Iterative models keep one table by document and one by term. Documents are dealt to parts of bounded size
once. In every step a part gets the rows of its own terms, works on both in one Arrow group, and sends back
sums by term; no table of all terms is ever in one place. Parts belong to batches, which steps may take one
at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import new_path, stage
from .counts import packed_docs

#: Non-zero counts that a part holds on average.
PART_CELLS = 1_000_000


def hash32(key: Column) -> Column:
    """32 bits of the md5 of a value as text: the same in every engine."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


@dataclass(frozen=True)
class Parts:
    """``docs(part, doc_id, idx, val, batch)`` and ``terms(part, term_id, batch)``, both written, in folders by batch."""

    docs: DataFrame
    terms: DataFrame
    per_batch: int
    batches: int

    def tasks(self) -> int:
        return max(self.per_batch, self.docs.sparkSession.sparkContext.defaultParallelism)

    def meet(self, docs: DataFrame, by_term: DataFrame, work: Callable, schema: str, batch: int | None = None) -> DataFrame:
        """``work(docs, rows)`` for each part of ``docs``: its documents, and the rows of ``by_term(term_id, ...)`` of its terms."""
        wanted = self.terms if batch is None else self.terms.filter(F.col("batch") == batch)
        rows = wanted.drop("batch").join(by_term, "term_id")
        return docs.repartition(self.tasks(), "part").groupBy("part").cogroup(
            rows.repartition(self.tasks(), "part").groupBy("part")).applyInArrow(work, schema)


def in_parts(counts: DataFrame, part_cells: int = PART_CELLS, batches: int = 1) -> Parts:
    """Deal the documents of ``counts(doc_id, term_id, cnt)`` to batches and parts by a hash of their id."""
    spark = counts.sparkSession
    packed = stage(packed_docs(counts).select("doc_id", F.col("idx").cast("array<int>").alias("idx"), "val"), "packed")
    cells = packed.agg(F.sum(F.size("idx"))).first()[0] or 0
    n = max(1, spark.sparkContext.defaultParallelism, -(-cells // (part_cells * batches)))
    h, b = hash32(F.col("doc_id")), F.lit(batches)
    dealt = packed.withColumn("batch", (h % b).cast("int")).withColumn("part", (F.col("batch") + b * (F.floor(h / b) % F.lit(n))).cast("int"))

    def by_batch(df: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        df.write.partitionBy("batch").parquet(path)
        return spark.read.schema(df.select(*[c for c in df.columns if c != "batch"], "batch").schema).parquet(path)

    docs = by_batch(dealt, "parts")
    # occurrences of a term in one part are combined within each task before the shuffle
    return Parts(docs, by_batch(docs.select("part", F.explode("idx").alias("term_id"), "batch").distinct(), "part-terms"), n, batches)
