"""Rescaling LDA factors by the mean totals of factorisation runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.special import array_sum, gamma_mean

TOPIC_WORD_OFFSET = 1e-6


def scale_factors(theta: DataFrame, beta: DataFrame) -> DataFrame:
    """One row ``(bm, tm)`` over all runs.

    ``bm``: mean over seeds and topics of the topic's total expected weight; ``tm``: mean over seeds
    and documents of the document's total. Runs have equal sizes, so a mean of means is one mean.
    """
    doc_total = theta.agg(F.avg(array_sum(gamma_mean(F.col("shape"), F.col("rate")))).alias("tm"))
    mean = beta.select("seed", F.posexplode(gamma_mean(F.col("shape"), F.col("rate"))).alias("topic_id", "e"))
    topic_total = mean.groupBy("seed", "topic_id").agg(F.sum("e").alias("s")).agg(F.avg("s").alias("bm"))
    return topic_total.select("bm", doc_total.scalar().alias("tm"))


def _or_size(mean: Column, size: Column) -> Column:
    return F.when(mean == 0, size.cast("double")).otherwise(mean)


def scaled_beta(beta: DataFrame, factors: DataFrame, num_terms: Column) -> DataFrame:
    """``beta (topic_id, term_id, weight)`` times bm; a zero bm is replaced by the vocabulary size."""
    return beta.withColumn("weight", F.col("weight") * _or_size(factors.select("bm").scalar(), num_terms))


def scaled_theta(theta: DataFrame, factors: DataFrame) -> DataFrame:
    """``theta (…, theta array)`` times tm; a zero tm is replaced by the number of topics."""
    tm = factors.select("tm").scalar()
    return (theta.withColumn("__m", _or_size(tm, F.size("theta")))
            .withColumn("theta", F.transform("theta", lambda v: v * F.col("__m"))).drop("__m"))


def topic_word(scaled: DataFrame, num_terms: Column, drop_last_term: bool = True) -> DataFrame:
    """Scaled topics plus a small offset. The last vocabulary column is dropped, as the model reader expects."""
    kept = scaled.filter(F.col("term_id") < num_terms - 1) if drop_last_term else scaled
    return kept.withColumn("weight", F.col("weight") + F.lit(TOPIC_WORD_OFFSET))
