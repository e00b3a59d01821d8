"""Toxicity: a linear classifier on character n-grams, each scaled by its naive Bayes log-count ratio.

Features are hashed n-grams inside words (with the word's edges), counted once per document. One pass over
all labelled training rows gives each feature's document counts by class, and from them the log-count
ratio r = log(p(f|1) / p(f|0)). Every feature whose ratio is significant (``least_z`` of its standard
deviations; no number of features is set) is used, every document becomes the sparse vector of r over the
features it has, and logistic regression is fitted on all training rows by Spark's distributed optimizer.
Scoring is one Arrow pass with a table of weight * r per hash.

What goes through the driver is bounded by the number of buckets, ``2 ** hash_bits`` counts and weights.
Labels join the texts by broadcast while they are few (``broadcast_labels`` rows, counted first) and by shuffle beyond that.

Defined results: null and empty texts have no features and get the score of the intercept. Rows without a
label are only scored. If a document has several labels the highest counts; repeated rows count repeatedly.
Without a training row of each class, or without a significant feature, every score is the smoothed share of class 1. Texts of any length are
read whole, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.stage import new_path, stage
from .common import strings


@dataclass(frozen=True)
class Rules:
    orders: tuple[int, ...] = (3, 4, 5)
    hash_bits: int = 20
    #: A feature is used where its log-count ratio is at least so many of its standard deviations.
    least_z: float = 2.0
    reg: float = 1e-4
    steps: int = 60
    folds: int = 5
    broadcast_labels: int = 1_000_000


@dataclass(frozen=True)
class Model:
    rules: Rules
    hashes: np.ndarray   # of the features kept, ascending
    weights: np.ndarray  # weight * ratio
    intercept: float


_SLICE = 1 << 20


def features_of(text: str, rules: Rules, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashes of a text's n-grams; only those marked in ``wanted`` if it is given."""
    found = []
    longest = max(rules.orders)
    text = f" {text.lower()} "
    for at in range(0, max(1, len(text) - longest + 1), _SLICE):
        part = np.frombuffer(text[at:at + _SLICE + longest - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        part[part <= 32] = 32
        space = part == 32
        code = part.copy()
        crossed = np.zeros(len(part), bool)
        for n in range(2, longest + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            code = code[:m] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:]
            if n > 2:
                crossed = crossed[:m] | space[n - 2:n - 2 + m]  # white space inside, edges aside
            else:
                crossed = crossed[:m]
            if n in rules.orders:
                h = ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)) >> np.uint64(64 - rules.hash_bits)
                keep = ~crossed if wanted is None else ~crossed & wanted[h]
                found.append(h[keep])
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


def held_out(doc_id: Column, rules: Rules = Rules()) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % rules.folds == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """``(text, label)`` of the labelled rows outside the held-out fold."""
    known = stage(labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id"), rules))
                  .groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("label")), "toxicity-labels")
    few = known.count() <= rules.broadcast_labels
    return docs.select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id").select("text", "label")


def _counts(train: DataFrame, rules: Rules) -> DataFrame:
    """``(feature, n1, n0)``: documents of each class that have the feature; feature -1 counts the documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (1 << rules.hash_bits) + 1), np.int64)
        for batch in batches:
            for text, label in zip(strings(batch.column(0)), batch.column(1).to_pylist()):
                row = total[int(label)]
                row[features_of(text, rules)] += 1
                row[-1] += 1
        used = np.flatnonzero(total.any(0))
        ids = np.where(used == 1 << rules.hash_bits, -1, used)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[1, used]), pa.array(total[0, used])], ["feature", "n1", "n0"])

    return train.mapInArrow(count, "feature long, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _vectors(train: DataFrame, hashes: np.ndarray, ratios: np.ndarray, rules: Rules) -> DataFrame:
    """``(label, x)``: each row's features scaled by their ratios; written, since the optimizer reads them often.

    A sparse vector is stored as (type 0, size, indices, values); rows are written in that layout and read back
    under the vector type, so none of them is built by itself in Python.
    """
    from pyspark.ml.linalg import VectorUDT

    spark = train.sparkSession
    known = spark.sparkContext.broadcast((hashes, ratios))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, scale = known.value
        wanted = np.zeros(1 << rules.hash_bits, bool)
        wanted[used] = True
        for batch in batches:
            has = [np.searchsorted(used, features_of(t, rules, wanted)).astype(np.int32) for t in strings(batch.column(0))]
            ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in has]))).astype(np.int32))
            flat = np.concatenate([np.zeros(0, np.int32), *has])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(ends, pa.array(flat)), pa.ListArray.from_arrays(ends, pa.array(scale[flat]))],
                                             ["label", "indices", "values"])

    layout = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(len(hashes)).alias("size"), "indices", "values")
    path = new_path(spark, "toxicity-features")
    train.mapInArrow(index, "label double, indices array<int>, values array<double>").select("label", layout.alias("x")).write.parquet(path)
    rows = spark.read.schema(T.StructType([T.StructField("label", T.DoubleType()), T.StructField("x", VectorUDT())])).parquet(path)
    # every step of the optimizer sends one gradient of all features per partition, so there are no more of them than cores
    return rows.coalesce(spark.sparkContext.defaultParallelism)


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> Model:
    """``docs(doc_id, text)``, ``labels(doc_id, toxic)``."""
    from pyspark.ml.classification import LogisticRegression

    train = _training(docs, labels, rules)
    counts = stage(_counts(train, rules), "toxicity-counts")
    total = counts.filter("feature = -1").first()
    if total is None or not total.n1 or not total.n0:
        n1, n0 = (total.n1, total.n0) if total else (0, 0)
        return Model(rules, np.zeros(0, np.int64), np.zeros(0), float(np.log((n1 + 1) / (n0 + 1))))
    ratio = F.log((F.col("n1") + 1) / F.lit(total.n1 + 2)) - F.log((F.col("n0") + 1) / F.lit(total.n0 + 2))
    noise = F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1))
    # of 2 ** hash_bits buckets at most
    used = counts.filter("feature >= 0").select("feature", ratio.alias("r")).filter(F.abs(ratio / noise) >= rules.least_z).orderBy("feature").toArrow()
    hashes, ratios = (used[c].to_numpy().copy() for c in ("feature", "r"))
    if not len(hashes):
        return Model(rules, hashes, ratios, float(np.log((total.n1 + 1) / (total.n0 + 1))))
    vectors = _vectors(train, hashes, ratios, rules)
    model = LogisticRegression(maxIter=rules.steps, regParam=rules.reg, standardization=False, featuresCol="x", labelCol="label").fit(vectors)
    return Model(rules, hashes, np.asarray(model.coefficients.toArray()) * ratios, float(model.intercept))


def score(text: Column, model: Model, spark) -> Column:
    """Probability of label 1."""
    known = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judge(column: pa.Array) -> pa.Array:
        m = known.value
        wanted = np.zeros(1 << m.rules.hash_bits, bool)
        wanted[m.hashes] = True
        table = np.zeros(1 << m.rules.hash_bits)
        table[m.hashes] = m.weights
        sums = np.array([m.intercept + table[features_of(t, m.rules, wanted)].sum() for t in strings(column)])
        return pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))), pa.float64())

    return judge(text.cast("string"))
