"""Corpus preparation: speeches to document-term counts, in two passes around boilerplate removal.

All chambers are prepared in the same jobs, with ``chamber`` as a key of every statistic. The small
results that later steps look up (speaker list, vocabulary, overlap table, procedural documents) are
written first, so the optimizer knows their size when it chooses between broadcast and shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import counts as C
from ..operators import ids, procedural, speeches
from ..operators import vocabulary as V
from .stage import stage

GROUP = ("chamber",)


@dataclass(frozen=True)
class PrepareConfig:
    min_speeches_per_speaker: int = 25
    min_df: float = 0.001
    max_df: float = 0.75
    min_authors_per_word: int = 50
    ngram_max: int = 3
    token_pattern: str = T.FIRST_PASS_PATTERN
    short_speech_max_chars: int = 400
    incidence_threshold: float = 0.1
    level_wise: bool = True
    stage_corpus: bool = True


@dataclass
class CorpusTables:
    """One pass's result. ``docs`` holds the documents that keep any count, with ``author_id``."""

    docs: DataFrame
    authors: DataFrame
    vocab: DataFrame
    counts: DataFrame


@dataclass
class Prepared:
    first: CorpusTables
    procedural: DataFrame
    stopwords: DataFrame
    final: CorpusTables


def corpus_from_rows(rows: DataFrame, csv_na: bool = True) -> DataFrame:
    """``(chamber, doc_id, speaker, text)`` from ingested speech rows (with ``doc_id``).

    ``csv_na`` applies the missing-value strings a CSV hop between the stages would turn to null.
    """
    na = T.na_to_null if csv_na else (lambda c: c)
    split = speeches.split_chamber(rows)
    return split.select("chamber", "doc_id", na(F.col("Speaker_Bioguide_ID")).alias("speaker"), na(F.col("Text")).alias("text"))


def corpus_tables(docs: DataFrame, stopwords: V.Words, cfg: PrepareConfig) -> CorpusTables:
    """Vocabulary, counts and kept documents of ``docs (chamber, doc_id, speaker, text)``."""
    g = list(GROUP)
    speakers = stage(speeches.speaker_counts(docs, g), "speakers")
    authors = stage(ids.author_dimension(speakers, g), "authors")
    total = V.total_of(speakers, g, "n_speeches")
    stats = V.build_stats(docs, stopwords, cfg.ngram_max, cfg.token_pattern, cfg.min_df, cfg.min_authors_per_word, g,
                          stage if cfg.level_wise else None, total)
    chosen = V.author_spread(V.df_band(stats, total, cfg.min_df, cfg.max_df), cfg.min_authors_per_word)
    vocab = stage(V.select_vocabulary(chosen, g), "vocab")
    if vocab.isEmpty():
        raise ValueError("no term lies within the document-frequency and speaker bounds")
    overlaps = stage(C.pack_overlaps(C.overlap_map(vocab, g), g), "overlaps")
    counts = stage(C.deoverlap(C.document_term_counts(docs, vocab, cfg.ngram_max, g), overlaps, g, placed=True), "counts")
    # Few documents end up empty: list those and leave the texts of all others where they are.
    empty = docs.select(*g, "doc_id").join(C.nonempty_docs(counts, g), [*g, "doc_id"], "left_anti")
    kept = docs.join(stage(empty, "empty"), [*g, "doc_id"], "left_anti")
    return CorpusTables(ids.author_ids(kept, authors, g), authors, vocab, counts)


def _per_chamber(base: Sequence[str], extra: DataFrame) -> Mapping[str, list[str]]:
    """Base words plus each chamber's own; ``extra`` is bounded by the classifier's vocabulary."""
    rows = extra.select("chamber", "term").limit(T.MAX_INLINE_WORDS + 1).collect()
    if len(rows) > T.MAX_INLINE_WORDS:
        raise ValueError("more procedural stopwords than a stop list can hold")
    out = {c: list(base) for c in speeches.CHAMBERS}
    for r in rows:
        if r.term not in out[r.chamber]:
            out[r.chamber].append(r.term)
    return out


def prepare(corpus: DataFrame, stopwords: Sequence[str], model: DataFrame, bias: Column, cfg: PrepareConfig = PrepareConfig()) -> Prepared:
    """Both passes over ``corpus (chamber, doc_id, speaker, text)``.

    The corpus is scanned about ten times; ``stage_corpus`` writes its cleaned rows once, so that
    parsing and cleaning are not repeated. Set it off where ``corpus`` already is a plain table scan.

    ``model (term, weight)`` and ``bias`` are the boilerplate classifier. The second pass counts
    document frequencies over the documents it keeps and takes speaker labels as they are.
    """
    g = list(GROUP)
    repeated = model.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()
    if repeated:
        raise ValueError(f"the classifier model lists {repeated} term(s) more than once")
    active = stage(speeches.active_speaker_list(corpus, cfg.min_speeches_per_speaker, g), "active")
    filled = speeches.fill_nulls(speeches.active_speakers(corpus, cfg.min_speeches_per_speaker, g, active))
    labelled = speeches.clean_speakers(filled.withColumn("raw_speaker", F.col("speaker")))
    if cfg.stage_corpus:
        labelled = stage(labelled, "corpus")
    first = corpus_tables(labelled, stopwords, cfg)
    raw = first.docs.select(*g, "doc_id", F.col("raw_speaker").alias("speaker"), T.flatten_newlines(F.col("text")).alias("text"))
    short = procedural.short_candidates(raw, cfg.short_speech_max_chars)
    proc = stage(procedural.procedural_docs(procedural.score(short, model, bias, cfg.ngram_max, g)), "procedural")
    words = stage(procedural.procedural_stopwords(proc, cfg.incidence_threshold, g), "stopwords")
    final = corpus_tables(procedural.without_procedural(raw, proc, g), _per_chamber(stopwords, words), cfg)
    return Prepared(first, proc, words, final)
