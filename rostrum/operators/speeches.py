"""Row filters over speeches: chamber, speaker activity, null rules, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

CHAMBERS = ("house", "senate")


def split_chamber(df: DataFrame, body: str = "Legislative Body", chambers: Sequence[str] = CHAMBERS) -> DataFrame:
    """Add ``chamber`` from the body label and drop rows of any other body."""
    return df.withColumn("chamber", T.normalize_body(F.col(f"`{body}`"))).filter(F.col("chamber").isin(*chambers))


def speaker_counts(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Rows per speaker; null is a speaker of its own."""
    return df.groupBy(*group, "speaker").agg(F.count(F.lit(1)).alias("n_speeches"))


def active_speaker_list(df: DataFrame, minimum: int, group: Sequence[str] = ()) -> DataFrame:
    return speaker_counts(df, group).filter(F.col("n_speeches") >= minimum).select(*group, "speaker")


def active_speakers(df: DataFrame, minimum: int = 25, group: Sequence[str] = (), keep: DataFrame | None = None) -> DataFrame:
    """Rows whose speaker has at least ``minimum`` rows.

    Counts are combined before the shuffle and only the short speaker list is joined back, so one
    dominant speaker never gathers in a task. Pass a staged ``keep`` list to avoid moving the texts.
    """
    k = (keep if keep is not None else active_speaker_list(df, minimum, group)).alias("k")
    d = df.alias("d")
    cond = F.col("d.speaker").eqNullSafe(F.col("k.speaker"))
    for g in group:
        cond = cond & (F.col(f"d.{g}") == F.col(f"k.{g}"))
    return d.join(k, cond, "left_semi")


def fill_nulls(df: DataFrame) -> DataFrame:
    """Unknown label for a missing speaker, empty text for a missing text."""
    return df.na.fill({"speaker": T.UNKNOWN_SPEAKER, "text": ""})


def clean_speakers(df: DataFrame) -> DataFrame:
    return df.withColumn("speaker", T.clean_speaker(F.col("speaker")))


def drop_missing_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(F.length(text) > 0)


def stage_counts(df: DataFrame, body: str = "Legislative Body") -> DataFrame:
    """Row totals of the split: all, per chamber, dropped."""
    b = T.normalize_body(F.col(f"`{body}`"))
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(b == "house").alias("house_rows"),
                  F.count_if(b == "senate").alias("senate_rows"),
                  F.count_if(~b.isin(*CHAMBERS)).alias("dropped_rows"))
