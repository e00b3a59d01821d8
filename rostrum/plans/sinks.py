"""Writers for every artifact. Parquet is the native format; text, CSV and JSON serve other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..operators import vocabulary as V
from ..operators.ids import export_ids
from ..operators.speeches import CHAMBERS, split_chamber
from .prepare import CorpusTables
from .topic_init import TopicInit
from .versions import Version, Versions


def _by(df: DataFrame, *columns: str) -> DataFrameWriter:
    """Replaces the partitions that ``df`` holds, and no others."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; quotes inside a field are doubled and line breaks stay inside quotes."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_speeches(rows: DataFrame, path: str, csv: bool = False) -> None:
    if csv:
        write_csv(rows, path)
    else:
        rows.write.mode("overwrite").parquet(path)


def write_failures(bad: DataFrame, path: str) -> bool:
    """One ``path#record: reason`` line per bad record; nothing is written when there is none."""
    if bad.isEmpty():
        return False
    place = F.concat_ws("#", *[c for c in ("file_path", "record") if c in bad.columns])
    bad.select(F.concat_ws(": ", place, "reason").alias("value")).write.mode("overwrite").text(path)
    return True


def write_split(df: DataFrame, path: str, csv: bool = False) -> None:
    """One folder per chamber; chambers that ``df`` does not hold keep what was written before."""
    w = _by(df, "chamber")
    if csv:
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.parquet(path)


def publish_split(df: DataFrame, path: str, csv: bool = False) -> Version:
    """Both chambers of one run as a version of their own (see :mod:`.versions`); a side without rows is an empty
    table, a CSV of a header only, and nothing of an earlier run is left in it."""
    parts = split_chamber(df) if "chamber" not in df.columns else df
    sides = {c: parts.filter(F.col("chamber") == c).drop("chamber") for c in CHAMBERS}
    return Versions(df.sparkSession, path).publish(sides, {"what": "split"}, "csv" if csv else "parquet")


def publish_corpus(t: CorpusTables, path: str) -> Version:
    """The artifacts of :func:`write_corpus` as one version: a reader never sees counts of one run and terms of another."""
    rows = export_ids(t.docs.select("chamber", "doc_id", "speaker", "author_id", "text"), ["chamber"])
    return Versions(t.docs.sparkSession, path).publish({
        "counts": t.counts.withColumn("cnt", F.col("cnt").cast("float")), "author_indices": rows.select("chamber", "row_id", "doc_id", "author_id"),
        "documents": rows.select("chamber", "row_id", "doc_id", "speaker", "text"), "vocabulary": t.vocab, "author_map": t.authors}, {"what": "corpus"})


def publish_topics(t: TopicInit, path: str) -> Version:
    """Topics, mixtures, metrics and the scaled tables of one initialisation as one version."""
    tables = {"beta": t.weights, "train_theta": t.theta, "topics": t.topics, "metrics": t.metrics, "beta_scaled": t.beta_scaled,
              "theta_scaled": t.theta_scaled, "topic_word": t.topic_word, "doc_topic": t.theta_scaled}
    if t.eval_theta is not None:
        tables["eval_theta"] = t.eval_theta
    return Versions(t.weights.sparkSession, path).publish(tables, {"what": "topics"})


def write_texts(df: DataFrame, path: str, column: str = "text", order: tuple[str, ...] = ()) -> None:
    """One text per line; ordered lists are range-sorted, so part files read in order."""
    out = df.orderBy(*order) if order else df
    out.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_corpus(t: CorpusTables, path: str) -> None:
    """Counts (float), author ids, vocabulary, author map, texts and kept rows, with positional row ids."""
    rows = export_ids(t.docs.select("chamber", "doc_id", "speaker", "author_id", "text"), ["chamber"])
    by = lambda df, name: _by(df, "chamber").parquet(f"{path}/{name}")
    by(t.counts.withColumn("cnt", F.col("cnt").cast("float")), "counts")
    by(rows.select("chamber", "row_id", "doc_id", "author_id"), "author_indices")
    by(rows.select("chamber", "row_id", "doc_id", "speaker", "text"), "documents")
    by(t.vocab, "vocabulary")
    by(t.authors, "author_map")


def write_vocab_json(vocab: DataFrame, path: str) -> None:
    V.vocab_json(vocab).write.mode("overwrite").text(path)


def vocab_json_lines(vocab: DataFrame) -> DataFrame:
    """``(place, value)``: the vocabulary as the lines of one JSON object, in id order."""
    ends = vocab.agg(F.min("term_id").alias("first"), F.max("term_id").alias("last")).first()
    first, last = (ends["first"], ends["last"]) if ends["first"] is not None else (0, 0)
    quoted = F.to_json(F.array("term"))  # ["..."]
    entry = F.concat(F.lit("  "), F.expr("substring(q, 2, length(q) - 2)"), F.lit(": "), F.col("term_id").cast("string"), F.when(F.col("term_id") < last, ",").otherwise(""))
    lines = vocab.withColumn("q", quoted).select(F.col("term_id").alias("place"), entry.alias("value"))
    edges = vocab.sparkSession.createDataFrame([(first - 1, "{"), (last + 1, "}")], "place bigint, value string")
    return lines.unionByName(edges)


def write_vocab_json_parts(vocab: DataFrame, path: str) -> None:
    """The vocabulary as JSON in part files: sorted ranges, which together, in the order of their names, are one object."""
    vocab_json_lines(vocab).orderBy("place").select("value").write.mode("overwrite").text(path)


def write_factors(theta: DataFrame, beta: DataFrame, num_topics: int, path: str) -> None:
    """Factorisation state, one folder per table, number of topics and seed; other runs stay as they are.

    ``sources.tables.read_runs`` lists them and ``read_factors`` reads one of the tables.
    """
    for name, df in (("theta", theta), ("beta", beta)):
        run = df.withColumn("table_name", F.lit(name)).withColumn("num_topics", F.lit(num_topics))
        _by(run, "table_name", "num_topics", "seed").parquet(path)


def write_lda(weights: DataFrame, train_theta: DataFrame, path: str, eval_theta: DataFrame | None = None) -> None:
    """Topic weights, training mixtures and, for another evaluation set, its mixtures."""
    weights.write.mode("overwrite").parquet(f"{path}/beta")
    train_theta.write.mode("overwrite").parquet(f"{path}/train_theta")
    if eval_theta is not None:
        eval_theta.write.mode("overwrite").parquet(f"{path}/eval_theta")


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def write_results(runs: DataFrame, path: str) -> None:
    write_csv(runs, path)


def write_scaled(beta_scaled: DataFrame, theta_scaled: DataFrame, topic_word: DataFrame, path: str) -> None:
    """Scaled topics and mixtures, and the two tables the training stage reads."""
    beta_scaled.write.mode("overwrite").parquet(f"{path}/beta_scaled")
    theta_scaled.write.mode("overwrite").parquet(f"{path}/theta_scaled")
    topic_word.write.mode("overwrite").parquet(f"{path}/topic_word")
    theta_scaled.write.mode("overwrite").parquet(f"{path}/doc_topic")
