"""Latent Dirichlet allocation on the count table, with ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.stage import by_key, new_path
from .counts import packed_docs


def vectors(counts: DataFrame, num_terms: int) -> DataFrame:
    """``(doc_id, features)``: one sparse vector per document, as a written table.

    A sparse vector is stored as (type 0, size, indices, values); the packed arrays are written in
    that layout and read back under the vector type, so no row passes through Python. The fit, which
    scans its input once per iteration, then reads this table.
    """
    spark = counts.sparkSession
    layout = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(num_terms).cast("int").alias("size"),
                      F.col("idx").alias("indices"), F.col("val").alias("values"))
    path = new_path(spark, "features")
    packed_docs(by_key(counts, "doc_id")).select("doc_id", layout.alias("features")).write.parquet(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def fit_online(features: DataFrame, num_topics: int, seed: int = 42, alpha: float | str = "symmetric",
               eta: float | str = "symmetric", decay: float = 0.5, passes: int = 1,
               subsampling_rate: float = 0.05) -> LDAModel:
    """Online variational Bayes. Priors: a number, ``symmetric`` (1/K), for alpha also ``auto`` (learned)
    and ``asymmetric`` (falling with the topic's number). The optimizer cannot learn eta.

    One pass over the corpus is 1/subsampling_rate mini-batches; the inner iterations per document
    follow the optimizer's own convergence rule.
    """
    falling = [1.0 / (i + num_topics ** 0.5) for i in range(num_topics)]
    named = {"symmetric": [1.0 / num_topics], "auto": [1.0 / num_topics], "asymmetric": [x / sum(falling) for x in falling]}
    if isinstance(alpha, str) and alpha not in named or isinstance(eta, str) and eta != "symmetric":
        raise ValueError(f"priors not supported: alpha={alpha!r}, eta={eta!r}")
    lda = (LDA(k=num_topics, seed=seed, optimizer="online", learningDecay=max(decay, 0.5 + 1e-9),
               subsamplingRate=subsampling_rate, maxIter=max(1, round(passes / subsampling_rate)))
           .setOptimizeDocConcentration(alpha == "auto")
           .setDocConcentration(named[alpha] if isinstance(alpha, str) else [float(alpha)])
           .setTopicConcentration(1.0 / num_topics if isinstance(eta, str) else float(eta)))
    return lda.fit(features)


def fit_em(features: DataFrame, num_topics: int, seed: int = 42, iterations: int = 50,
           alpha: float | None = None, beta: float | None = None, checkpoint_interval: int = 10) -> LDAModel:
    """Expectation-maximisation, in place of a Gibbs sampler.

    ``alpha`` is the sum over topics and ``beta`` the per-term prior, as Gibbs samplers take them. The
    optimiser needs priors above 1; smaller ones are shifted by 1 as its smoothing expects.
    """
    lda = LDA(k=num_topics, seed=seed, optimizer="em", maxIter=iterations, checkpointInterval=checkpoint_interval)
    if alpha is not None:
        lda = lda.setDocConcentration([1.0 + alpha / num_topics])
    if beta is not None:
        lda = lda.setTopicConcentration(1.0 + beta)
    return lda.fit(features)


def topic_weights(model: LDAModel, vocab_size: int) -> DataFrame:
    """``(topic_id, term_id, weight)`` for every topic and term; each topic's weights sum to one.

    Terms without any count get weight 0 where the optimiser leaves them out.
    """
    d = model.describeTopics(vocab_size)
    rows = d.select(F.col("topic").cast("int").alias("topic_id"),
                    F.explode(F.arrays_zip("termIndices", "termWeights")).alias("x"))
    w = rows.select("topic_id", F.col("x.termIndices").cast("bigint").alias("term_id"), F.col("x.termWeights").alias("w"))
    total = w.groupBy("topic_id").agg(F.sum("w").alias("s"))
    share = w.join(total, "topic_id").select("topic_id", "term_id", (F.col("w") / F.col("s")).alias("weight"))
    every = (d.sparkSession.range(vocab_size).withColumnRenamed("id", "term_id")
             .withColumn("topic_id", F.explode(F.sequence(F.lit(0), F.lit(model.getK() - 1)))))
    return every.join(share, ["topic_id", "term_id"], "left").select(
        "topic_id", "term_id", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def doc_topics(model: LDAModel, features: DataFrame) -> DataFrame:
    """``(doc_id, theta array)`` inferred for every document."""
    return model.transform(features).select("doc_id", vector_to_array("topicDistribution").alias("theta"))


def train_and_eval(features: DataFrame, is_eval: Column) -> tuple[DataFrame, DataFrame]:
    return features.filter(~is_eval), features.filter(is_eval)
