"""Dense integer ids by sorted value, without one global sort in a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage


def dense_ids(df: DataFrame, key: str, bucket: Column, out: str, group: Sequence[str] = (), bucket_rows: int = 1_000_000) -> DataFrame:
    """Add ``out`` = 0-based rank of the unique ``key`` within ``group``.

    ``bucket`` must rise with ``key`` (a prefix of a string, the high part of a number). Rows are
    ranked inside each bucket; the offsets come from a running sum over one row per bucket. Where one
    bucket holds more than ``bucket_rows`` (ids with one prefix), keys are ranked in sampled ranges
    instead. ``df`` is read for the sizes and for the ranks, so stage it first when it is costly.
    """
    g = list(group)
    b = "__bucket"
    sizes = stage(df.withColumn(b, bucket).groupBy(*g, b).agg(F.count(F.lit(1)).alias("__n")), "bucket-sizes")
    if (sizes.agg(F.max("__n")).first()[0] or 0) > bucket_rows:
        return range_ids(df, key, out, group)
    df = df.withColumn(b, bucket)
    before = Window.partitionBy(*g).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*g, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*g, b).orderBy(key)) - 1)
    return (ranked.join(offsets, [*g, b])
            .withColumn(out, (F.col("__off") + F.col("__rn")).cast("bigint"))
            .drop(b, "__off", "__rn"))


def string_bucket(key: str, length: int = 4) -> Column:
    """Leading characters: they order like the string itself."""
    return F.substring(key, 1, length)


def range_ids(df: DataFrame, key: str, out: str, group: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` = 0-based rank of the unique ``key`` within ``group``, for keys of any distribution.

    Only the keys are sorted: into ranges that Spark samples, so outliers and dense spots fill no task.
    They are written with their place in their task; running sums over one row per task (and per
    group) give the ranks, which go back to the rows by key.
    """
    g, low = list(group), (1 << 33) - 1
    keys = df.select(*g, key)
    if set(df.columns) == {*g, key}:  # nothing but keys: they are worked out once for the sample, the ranges and the join
        df = keys = stage(keys, "keys")
    keys = keys.repartitionByRange(*g, key).sortWithinPartitions(*g, key)
    placed = stage(keys.withColumn("_place", F.monotonically_increasing_id()), "key-ranges").withColumn("_task", F.shiftright("_place", 33))
    before = Window.partitionBy().orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n")).select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.join(stage(starts, "range-starts"), "_task").select(*g, key, (F.col("_start") + F.col("_place").bitwiseAND(low)).alias(out))
    if g:
        firsts = stage(ranked.groupBy(*g).agg(F.min(out).alias("_first")), "group-starts")
        ranked = ranked.join(firsts, g).withColumn(out, F.col(out) - F.col("_first")).drop("_first")
    return df.join(ranked, [*g, key])


def author_dimension(docs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct speakers with ids 0..A-1."""
    authors = docs.select(*group, "speaker").distinct()
    return dense_ids(authors, "speaker", string_bucket("speaker"), "author_id", group)


def author_ids(docs: DataFrame, authors: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return docs.join(authors, [*group, "speaker"])


def export_ids(docs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """0-based row number in document order, for positional exports."""
    return range_ids(docs, "doc_id", "row_id", group)


def running_sums(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Add, for each name in ``values``, the sum of its column over the rows up to and with this one, by the unique ``key``.

    Rows are sorted into ranges that Spark samples and written with their place; one row per task gives
    what comes before it, and a window runs over the rows of one task.
    """
    rows = df.withColumns({f"_{n}": c for n, c in values.items()}).repartitionByRange(key).sortWithinPartitions(key)
    placed = stage(rows.withColumn("_place", F.monotonically_increasing_id()), "running-ranges").withColumn("_task", F.shiftright("_place", 33))
    before = Window.partitionBy().orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    held = placed.groupBy("_task").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in values])
    starts = held.select("_task", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in values])
    upto = Window.partitionBy("_task").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(stage(starts, "running-starts"), "_task").select(
        *df.columns, *[(F.col(f"_{n}_before") + F.sum(f"_{n}").over(upto)).alias(n) for n in values])
