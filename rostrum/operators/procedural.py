"""Finding and removing procedural boilerplate with a linear n-gram classifier."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .vocabulary import doc_total, with_ngrams


# Characters that never count towards the simplified length: punctuation and every white-space character
# (lower-casing only ever adds characters, so what is left is a lower bound).
_DROPPED = string.punctuation + "".join(c for c in map(chr, range(0x3001)) if re.fullmatch(T.WS, c))


def candidates(docs: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Documents of three or more words and more than 15 characters, with ``simple`` text.

    The text goes through one array chain, so it is simplified once per row, and only where the
    characters that remain in any case stay below ``max_chars``; long texts show that by their beginning. A plain
    filter on ``simple`` would be pushed down and repeat the expression for each of its conditions.
    """
    one = F.array("text")
    if max_chars is not None:
        few = lambda t: F.length(F.translate(t, _DROPPED, "")) < max_chars
        one = F.filter(F.filter(one, lambda t: few(F.substring(t, 1, 2 * max_chars))), few)

    def fits(s: Column) -> Column:
        ok = (F.length(s) > 15) & (F.length(s) - F.length(F.translate(s, " ", "")) > 1)
        return ok & (F.length(s) < max_chars) if max_chars is not None else ok

    return docs.select("*", F.explode(F.filter(F.transform(one, T.simplify_text), fits)).alias("simple"))


def short_candidates(docs: DataFrame, max_chars: int = 400) -> DataFrame:
    """Candidates of fewer than ``max_chars`` simplified characters."""
    return candidates(docs, max_chars)


def underscored_ngrams(short: DataFrame, n_max: int = 3) -> DataFrame:
    """Add ``grams``: all 1..n-grams of the simplified text, joined by ``_``."""
    toks = short.withColumn("tokens", F.split("simple", " "))
    return with_ngrams(toks, n_max, sep="_").drop("tokens")


def score(short: DataFrame, model: DataFrame, bias: Column, n_max: int = 3, group: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, score, matched)``: bias plus the weights of the distinct matched n-grams.

    The outer explode and outer lookup keep documents without a match; all rows of a document sit in
    one partition, so they are combined before the only shuffle. ``matched`` is bounded by the length
    limit of short texts.
    """
    keyed = short.select(*group, "doc_id", "simple")
    rows = underscored_ngrams(keyed, n_max).select(*group, "doc_id", F.explode_outer(F.array_compact(F.array_distinct("grams"))).alias("term"))
    hit = rows.join(model, "term", "left")
    found = F.when(F.col("weight").isNotNull(), F.col("term"))
    s = hit.groupBy(*group, "doc_id").agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w"), F.collect_list(found).alias("matched"))
    return s.select(*group, "doc_id", (F.col("w") + bias).alias("score"), "matched")


def procedural_docs(scored: DataFrame) -> DataFrame:
    """Documents scored strictly above zero."""
    return scored.filter("score > 0")


def procedural_stopwords(scored: DataFrame, threshold: float = 0.1, group: Sequence[str] = ()) -> DataFrame:
    """``(term, share)`` of model terms held by more than ``threshold`` of the procedural documents."""
    proc = procedural_docs(scored)
    per_term = proc.select(*group, F.explode("matched").alias("term")).groupBy(*group, "term").agg(F.count(F.lit(1)).alias("d"))
    share = F.col("d") / doc_total(proc, group)
    return (per_term.select(*group, "term", share.alias("share")).filter(F.col("share") > threshold)
            .orderBy(*group, F.desc("share"), "term"))


def without_procedural(docs: DataFrame, scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return docs.join(procedural_docs(scored).select(*group, "doc_id"), [*group, "doc_id"], "left_anti")
