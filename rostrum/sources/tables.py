"""Delimited and line-oriented inputs: speeches, word lists, classifier weights, topics, runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .transcripts import SPEECH_COLUMNS


def require_columns(df: DataFrame, required: Iterable[str] = SPEECH_COLUMNS) -> None:
    """Fail before any job runs when a needed column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the table lacks: {', '.join(missing)}")


def require_paths(spark: SparkSession, *paths: str) -> None:
    """Fail before any job runs when a stage input is absent."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError("Required input missing: " + ", ".join(missing))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Header CSV with quoted line breaks and doubled quotes; missing-value strings become null."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*[T.na_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                       for c, t in df.dtypes])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_no)``: lines in the order of file names and of places within each file. Numbers rise
    but leave gaps; the small table is one row per block read."""
    place = F.monotonically_increasing_id()
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    lines = spark.read.text(path).select("value", at.alias("at"), place.alias("place"))
    blocks = lines.groupBy("at").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("at").alias("block"), (F.row_number().over(Window.partitionBy().orderBy(F.split("at.f", "/"), "at.b")) - 1).alias("k"))
    number = F.shiftleft(F.col("k").cast("bigint"), 33) + F.col("place").bitwiseAND((1 << 33) - 1)
    return lines.join(blocks, F.col("at") == F.col("block")).select("value", number.alias("line_no"))


def read_words(spark: SparkSession, path: str, drop_blank: bool = True) -> DataFrame:
    """``(word, line_no)``: one trimmed entry per line, in file order. Also reads vocabularies."""
    lines = _lines(spark, path)
    if not drop_blank:
        return lines.select(F.col("value").alias("word"), "line_no")
    return lines.select(T.trim_ws(F.col("value")).alias("word"), "line_no").filter(F.length("word") > 0)


def union_words(*lists: DataFrame) -> DataFrame:
    """Ordered union of word lists ``(word, line_no)``; the first occurrence of a word wins."""
    tagged = None
    for i, words in enumerate(lists):
        part = words.select(F.lit(i).alias("src_no"), F.col("line_no").cast("bigint"), T.trim_ws(F.col("word")).alias("word"))
        tagged = part if tagged is None else tagged.unionByName(part)
    first = (tagged.filter(F.length("word") > 0).groupBy("word")
             .agg(F.min(F.struct("src_no", "line_no")).alias("at")))
    return first.select("word", "at.src_no", "at.line_no")


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """Classifier weights ``(line_no, term, weight)`` from a TSV with a header line."""
    lines = _lines(spark, path).filter(F.length(T.trim_ws(F.col("value"))) > 0)
    # The header is the first line that is not blank.
    header = lines.agg(F.min("line_no").alias("n")).scalar()
    parts = F.split("value", "\t")
    return (lines.filter((F.col("line_no") > header) & (F.size(parts) >= 2))
            .select("line_no", parts[0].alias("term"), T.trim_ws(parts[1]).cast("double").alias("weight")))


def split_model(weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(terms, bias)``: the first row's weight is the bias, the rest are term weights."""
    bias = weights.agg(F.min_by("weight", "line_no").alias("bias"), F.min("line_no").alias("line_no"))
    terms = weights.filter(F.col("line_no") > bias.select("line_no").scalar()).select("term", "weight")
    return terms, bias.select("bias")


def check_model(weights: DataFrame) -> None:
    """Raise for a model without terms or with a term listed twice."""
    terms, _ = split_model(weights)
    row = terms.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("term").alias("d")).first()
    if row.n == 0:
        raise ValueError("no terms in the classifier model")
    if row.n != row.d:
        raise ValueError(f"the classifier model lists {row.n - row.d} term(s) twice")


def parse_doc_topics(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(name, theta)`` from lines ``index \\t name \\t p0 \\t p1 ...``."""
    parts = F.split(T.trim_ws(F.col(column)), "\t")
    theta = F.transform(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), lambda p: p.cast("double"))
    return lines.select(F.get(parts, F.lit(1)).alias("name"), theta.alias("theta"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``(table_name, num_topics, seed)`` of every row that ``sinks.write_factors`` left below ``path``."""
    return spark.read.parquet(path).select("table_name", "num_topics", "seed")


def read_factors(spark: SparkSession, path: str, num_topics: int, seeds: list[int]) -> tuple[DataFrame, DataFrame]:
    """``(theta, beta)`` of the given runs; raises unless all of them are complete."""
    check_runs(discover_runs(read_runs(spark, path), num_topics, seeds), seeds)
    read = lambda name: (spark.read.parquet(f"{path}/table_name={name}")
                         .filter((F.col("num_topics") == num_topics) & F.col("seed").isin(seeds)).drop("num_topics"))
    return read("theta"), read("beta")


def discover_runs(factors: DataFrame, num_topics: int, seeds: list[int], tables: tuple[str, ...] = ("theta", "beta")) -> DataFrame:
    """Runs ``(num_topics, seed)`` found, in order, with a flag telling that every table is there.

    ``factors`` holds one row set per ``(num_topics, seed, table_name)``, as partition columns give it.
    """
    wanted = factors.filter((F.col("num_topics") == num_topics) & F.col("seed").isin(seeds))
    found = wanted.groupBy("num_topics", "seed").agg(F.count_distinct("table_name").alias("n_tables"))
    return found.withColumn("complete", F.col("n_tables") == len(tables)).orderBy("seed")


def check_runs(runs: DataFrame, seeds: list[int]) -> None:
    """Raise when no run, or not every requested run, is complete. One row per requested seed."""
    done = {r.seed for r in runs.filter("complete").collect()}
    missing = sorted(set(seeds) - done)
    if missing:
        raise FileNotFoundError(f"no complete factorisation run for seed(s) {missing}")
