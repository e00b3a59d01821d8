"""Incremental split of arriving speech files by chamber."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.speeches import CHAMBERS, split_chamber
from ..functions import text as T
from ..sources.tables import require_columns


def one_table(path: str) -> str:
    """A glob that matches ``path`` alone, be the table one file or a folder of files; streams take no single file."""
    return f"{path[:-1]}[{path[-1]}]"


def speech_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", pattern: str | None = None,
                  required: tuple[str, ...] | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of speech files; the schema is checked for the needed columns before it starts."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(path)
    require_columns(df, required) if required else require_columns(df)
    return df


def start_split(stream: DataFrame, out: str, checkpoint: str, body: str = "Legislative Body", fmt: str = "parquet") -> StreamingQuery:
    """Append each micro-batch to one folder per chamber, taking all files that are there.

    The file sink commits a batch once, so a restart from ``checkpoint`` neither loses nor repeats rows.
    """
    writer = (split_chamber(stream, body).writeStream.format(fmt).partitionBy("chamber")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    return writer.start(out)


def start_totals(stream: DataFrame, out: str, checkpoint: str, body: str = "Legislative Body") -> StreamingQuery:
    """Running row totals per chamber (``other`` = dropped rows), rewritten after every micro-batch."""
    b = T.normalize_body(F.col(f"`{body}`"))
    label = F.when(b.isin(*CHAMBERS), b).otherwise(F.lit("other"))
    totals = stream.groupBy(label.alias("chamber")).agg(F.count(F.lit(1)).alias("rows"))
    return (totals.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out))
            .trigger(availableNow=True).start())


def read_split(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The split so far; folders of chambers without rows are simply absent."""
    return spark.read.schema(schema.add("chamber", "string") if "chamber" not in schema.fieldNames() else schema).parquet(out)
