"""A training-data pipeline of the operators in ``rostrum.llm``; each stage's rows are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import decontaminate, mixing, quality, simhash, tokens
from rostrum.llm.common import fresh, table
from rostrum.llm.queries import byte_bpe
from rostrum.plans.stage import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    q = fresh(docs, "quality")
    return quality.with_verdict(docs, q).filter(F.col(f"{q}.kept")).drop(q)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    hits = fresh(docs, "hits")
    return decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), hits).filter(f"not {hits}.contaminated").drop(hits)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document's row as often as the mix takes it. The next stage orders by id."""
    return mixing.take(docs, ordered=False)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's token ids, read back from the files written."""
    return tokens.digests(tokens.write(docs, byte_bpe()), byte_bpe()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: The stages need compression, hashing and a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
