"""One large CSV file in many tasks, with line breaks inside quoted fields.

Spark splits a text file into blocks of bytes and reads whole lines from each, so a block may begin inside a
quoted field. A first pass counts the quotes of every block; running parities over the blocks of a file (one
row each) then tell which blocks begin inside quotes, and with them where records begin. Lines that continue
a record are brought to its first line; all other records stay where they are read. Records are parsed by the
engine's own CSV expression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.stage import stage
from .tables import require_columns

#: A line, its number in its block, whether the quotes of the block before it are odd, and the last line up to
#: it that begins a record if the block begins outside quotes (``even``) and inside (``odd``).
_LINES = "file string, block long, line long, value string, inside int, even long, odd long, quotes long"


def _scan(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, line, parity, last = None, 0, 0, [-1, -1]
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(files) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                key = part.column(0)[0].as_py(), part.column(1)[0].as_py()
                if key != at:
                    at, line, parity, last = key, 0, 0, [-1, -1]
                quotes = pc.count_substring(part.column(2), '"').to_numpy(zero_copy_only=False).astype(np.int64)
                before = (parity + np.cumsum(quotes) - quotes) % 2
                numbers = line + np.arange(len(quotes))
                firsts = []
                for kind in (0, 1):
                    seen = np.maximum.accumulate(np.where(before == kind, numbers, -1))
                    firsts.append(np.maximum(seen, last[kind]))
                    last[kind] = int(firsts[-1][-1])
                parity, line = int((before[-1] + quotes[-1]) % 2), line + len(quotes)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(numbers), part.column(2), pa.array(before.astype(np.int32)),
                                                  *[pa.array(x) for x in firsts], pa.array(quotes)], ["file", "block", "line", "value", "inside", "even", "odd", "quotes"])

    return lines.mapInArrow(number, _LINES)


def block_starts(lines: DataFrame) -> DataFrame:
    """For each block: whether it begins inside quotes, its records, the records before it in its file, and
    where the record begins that its first lines may continue."""
    sums = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.max("even").alias("even"), F.max("odd").alias("odd"),
                                              F.count_if(F.col("inside") == 0).alias("n0"), F.count_if(F.col("inside") == 1).alias("n1"))
    # one row per block of a file
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.withColumn("entry", (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).cast("int"))
    own = F.when(F.col("entry") == 0, F.col("even")).otherwise(F.col("odd"))
    known = known.withColumn("last", F.when(own >= 0, F.struct("block", own.alias("line"))))
    records = F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1"))
    return known.select("file", "block", "entry", records.alias("records"), F.coalesce(F.sum(records).over(before), F.lit(0)).alias("records_before"),
                        F.last("last", ignorenulls=True).over(before).alias("carried"))


def read_csv_blocks(spark: SparkSession, path: str, schema: str, required: Sequence[str] = ()) -> DataFrame:
    """``(file, block, line, columns...)``: the records of header CSV files, every file in as many tasks as it has blocks.

    ``block`` and ``line`` are the place where a record begins. Quotes inside fields are doubled; a file's first
    record is its header and must name the columns of ``schema`` in order. Missing-value strings become null.
    """
    # the columns' order is that of the files: the first record of any one of them tells it
    named = spark.read.option("header", True).option("multiLine", False).option("lineSep", "\n").csv(path).columns
    wanted = spark.createDataFrame([], schema)
    found = spark.createDataFrame([], ", ".join(f"`{c.strip()}` string" for c in named))
    require_columns(found, [*wanted.columns, *required])
    types = dict(wanted.dtypes)
    layout = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in found.columns)

    lines = _scan(spark, path)
    blocks = stage(block_starts(lines), "csv-blocks")
    placed = lines.join(blocks, ["file", "block"])
    starts = F.col("inside") == F.col("entry")
    own = F.when(F.col("entry") == 0, F.col("even")).otherwise(F.col("odd"))
    first = F.when(own >= 0, F.struct("block", own.alias("line"))).otherwise(F.col("carried"))
    # a record of one line ends on that line: it begins there and its quotes are even
    single = starts & (F.col("quotes") % 2 == 0)
    whole = placed.filter(single).select("file", "block", "line", "value")
    pieces = placed.filter(~single).select("file", first.alias("first"), F.struct("block", "line", "value").alias("piece"))
    joined = pieces.groupBy("file", "first").agg(F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["value"]), "\n").alias("value"))
    records = whole.unionByName(joined.select("file", "first.block", "first.line", "value"))
    records = records.filter("not (block = 0 and line = 0)").withColumn("value", F.regexp_replace("value", "\r$", "")).filter("value != ''")
    parsed = records.select("file", "block", "line", F.from_csv("value", layout, {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\u0001", "maxCharsPerColumn": "-1"}).alias("r"))
    column = lambda c: T.na_to_null(F.col(f"r.`{c}`")).alias(c) if types[c] == "string" else F.col(f"r.`{c}`")
    return parsed.select("file", "block", "line", *[column(c) for c in wanted.columns])


def chunk_totals(rows: DataFrame, label: str) -> DataFrame:
    """Rows of every block by ``label``, and the running total of the label up to the block, in file order."""
    counted = rows.groupBy(label, "file", "block").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy(label).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("total", F.sum("rows").over(upto))
