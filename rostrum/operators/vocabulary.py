"""Tokens, n-grams, term statistics and vocabulary selection.

``group`` names optional key columns (the chamber): every statistic is then kept per group in the
same job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from ..functions import grams as G
from ..functions import text as T
from .ids import dense_ids, string_bucket

# Workers get the helpers inside the task closure, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(G)

#: Column of :func:`first_pass` with the tokens of its n-grams.
FIRST_TOKENS = "__first_tokens"
#: Characters of text whose n-grams one task sums: some two million rows of authors and terms.
PART_CHARS = 4_000_000
#: Where the texts are not at hand: characters of text for each n-gram of one to three tokens.
PARTS_CHARS_A_GRAM = 2
#: Hashes of terms that a task holds; with more terms n-grams are not looked up before they leave the task.
MAX_KNOWN = 4_000_000

Words = Sequence[str] | Mapping[str, Sequence[str]]


def with_tokens(docs: DataFrame, pattern: str, words: Words = (), out: str = "tokens", by: str = "chamber") -> DataFrame:
    """Token array of each text; the words of a stop list are taken out before n-grams form.

    ``words`` is one list, or a list per value of the ``by`` column.
    """
    docs = docs.withColumn(out, T.token_array(F.col("text"), pattern))
    if not isinstance(words, Mapping):
        return docs.withColumn(out, T.without_words(F.col(out), words))
    kept = F.col(out)
    for value, w in words.items():
        kept = F.when(F.col(by) == value, T.without_words(F.col(out), w)).otherwise(kept)
    return docs.withColumn(out, kept)


def with_ngrams(df: DataFrame, n_max: int, sep: str = " ", tokens: str = "tokens", out: str = "grams") -> DataFrame:
    """Array of all contiguous 1..n-grams, with null slots where none starts; see :func:`explode_grams`."""
    cols = [tokens]
    for n in range(2, n_max + 1):
        name = f"__g{n}"
        df = df.withColumn(name, T.join_next(F.col(cols[-1]), F.col(tokens), n, sep))
        cols.append(name)
    made = {"ngrams": {"of": tokens, "n_max": n_max, "sep": sep}}
    return df.withColumn(out, F.concat(*cols).alias(out, metadata=made)).drop(*cols[1:])


def explode_grams(df: DataFrame, keep: Sequence[str], distinct: bool = False, grams: str = "grams") -> DataFrame:
    """One row per n-gram, or per distinct n-gram of the row.

    The generator takes an expression, not a bare column: for a column the optimizer would add a
    non-empty test and evaluate the whole token expression again below it.
    """
    a = F.array_distinct(grams) if distinct else F.col(grams)
    return df.select(*keep, F.explode(F.array_compact(a)).alias("term"))


def first_pass(docs: DataFrame, stopwords: Words = (), n_max: int = 3, pattern: str = T.FIRST_PASS_PATTERN) -> DataFrame:
    """Vocabulary-building analyser: stopwords go first, so n-grams bridge removed words.

    ``FIRST_TOKENS`` stays beside ``grams``: statistics form the same n-grams from it in their batches, at less cost
    than moving them there. A plan that does not read it does not make it.
    """
    return with_ngrams(with_tokens(docs, pattern, stopwords, FIRST_TOKENS), n_max, tokens=FIRST_TOKENS)


def second_pass(docs: DataFrame, n_max: int = 3) -> DataFrame:
    """Counting analyser: words of two or more characters, no stop list."""
    return with_ngrams(with_tokens(docs, T.SECOND_PASS_PATTERN), n_max).drop("tokens")


def remove_words(docs: DataFrame, words: DataFrame, pattern: str = T.FIRST_PASS_PATTERN) -> DataFrame:
    """Anti-join of exploded tokens ``(doc_id, pos, token)`` with a stop table of any length."""
    toks = docs.select("doc_id", F.posexplode(T.token_array(F.col("text"), pattern)).alias("pos", "token"))
    return toks.join(words.select(F.col("word").alias("token")), "token", "left_anti").select("doc_id", "pos", "token")


def ngrams_from_rows(tokens: DataFrame, n_max: int, sep: str = " ") -> DataFrame:
    """1..n-grams of token rows by ``lead`` within a document; used after :func:`remove_words`."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    cols: list[Column] = [F.col("token")]
    for n in range(1, n_max):
        cols.append(F.concat(cols[-1], F.lit(sep), F.lead("token", n).over(w)))
    return explode_grams(tokens.select("doc_id", F.array(*cols).alias("grams")), ["doc_id"])


def _placed(grams: DataFrame, group: Sequence[str], distinct: bool) -> DataFrame:
    """Counts by author and term, combined in each batch of rows and placed by the term: the one shuffle of the statistics.

    Rows are ``(part, *group, speaker, terms, sizes, counts)``. The number of partitions follows the length of the texts, so
    what a task holds does not grow with the corpus.
    """
    keys = [*group, "speaker"]
    size = F.length("text") if "text" in grams.columns else F.size("grams") * PARTS_CHARS_A_GRAM
    chars = grams.agg(F.sum(size)).first()[0] or 0
    parts = max(grams.sparkSession.sparkContext.defaultParallelism if chars > PART_CHARS else 1, -(-chars // PART_CHARS))
    made = grams.schema["grams"].metadata.get("ngrams") or {}
    made = made if made.get("of") == FIRST_TOKENS and FIRST_TOKENS in grams.columns else {}
    n_max, sep = made.get("n_max", 1), made.get("sep", " ")
    rows = grams.select(*keys, FIRST_TOKENS if made else "grams")
    out = _schema("part int", rows, keys, "terms string, sizes array<int>, counts array<int>")
    return rows.mapInArrow(lambda batches: G.combine(batches, keys, distinct, parts, n_max, sep), out).repartition(parts, "part")


def _schema(before: str, df: DataFrame, columns: Sequence[str], after: str) -> types.StructType:
    fields = lambda ddl: types.StructType.fromDDL(ddl).fields if ddl else []
    return types.StructType([*fields(before), *[df.schema[c] for c in columns], *fields(after)])


def known_grams(docs: DataFrame, keys: Sequence[str], lengths: tuple[int, int], terms: DataFrame, parts: bool = False) -> DataFrame:
    """``(*keys, term, cnt)`` of the n-grams in ``tokens`` that can be among ``terms``, or with ``parts`` made of two of them.

    Tasks hold eight bytes of hash for each term. Where there are more than ``MAX_KNOWN`` terms nothing is left out here;
    the result then is larger and what follows, which compares terms, the same.
    """
    keys, known = list(keys), _known_hashes(terms)
    rows = docs.select(*keys, "tokens")
    return rows.mapInArrow(lambda batches: G.known_grams(batches, keys, lengths, known, parts), _schema("", rows, keys, "term string, cnt bigint"))


def _known_hashes(terms: DataFrame) -> G.np.ndarray | None:
    """Sorted hashes of the terms; None for more than ``MAX_KNOWN``."""
    found = terms.select("term").mapInArrow(G.term_hashes, "h bigint").distinct().limit(MAX_KNOWN + 1).toArrow()
    return None if len(found) > MAX_KNOWN else G.np.sort(found["h"].to_numpy().view("uint64"))


def text_parts(docs: DataFrame) -> int:
    """Partitions for the statistics of ``docs``, by the length of the texts."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism if chars > PART_CHARS else 1, -(-chars // PART_CHARS))


def author_term_counts(grams: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Occurrences per author and term (long form)."""
    placed, keys = _placed(grams, group, False), [*group, "speaker"]
    return placed.mapInArrow(lambda batches: G.by_author(batches, keys), _schema("", placed, keys, "term string, cnt bigint"))


def _stats(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    per_author = rows.groupBy(*group, "speaker", "term").agg(F.count(F.lit(1)).alias("d"))
    return per_author.groupBy(*group, "term").agg(F.sum("d").alias("df"), F.count(F.lit(1)).alias("n_authors"))


def term_stats(grams: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(term, df, n_authors)``.

    Terms are made distinct inside each row. One shuffle carries them in arrays, with one count per author and
    term of a batch of rows; documents and authors of a term are summed where it lies.
    """
    placed, group = _placed(grams, group, True), list(group)
    return placed.mapInArrow(lambda batches: G.by_term(batches, group, "speaker"), _schema("", placed, group, "term string, df bigint, n_authors bigint"))


def total_of(sizes: DataFrame, group: Sequence[str] = (), column: str = "n") -> Column:
    """Sum of ``column`` (per value of ``group``) as a scalar subquery, usable in any expression."""
    if not group:
        return sizes.agg(F.sum(column).alias("n")).scalar()
    key = F.concat_ws("\u0001", *group)
    per = sizes.groupBy(key.alias("k")).agg(F.sum(column).alias("n"))
    return F.try_element_at(per.agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m")).scalar(), key)


def doc_total(docs: DataFrame, group: Sequence[str] = ()) -> Column:
    """Number of documents (of the row's group)."""
    return total_of(docs.select(*group, F.lit(1).alias("n")), group)


def df_band(stats: DataFrame, total: Column, min_df: float, max_df: float) -> DataFrame:
    """Terms with min_df*N <= df <= max_df*N, both ends included."""
    if max_df < min_df:
        raise ValueError("max_df is below min_df")
    df, n = F.col("df").cast("double"), total.cast("double")
    return stats.filter((df >= n * F.lit(float(min_df))) & (df <= n * F.lit(float(max_df))))


def author_spread(stats: DataFrame, min_authors: int) -> DataFrame:
    return stats.filter(F.col("n_authors") >= min_authors)


def select_vocabulary(stats: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(term_id, term, n)``: ids by sorted term, n = tokens in the term."""
    v = stats.select(*group, "term", T.term_length(F.col("term")).alias("n"))
    return dense_ids(v, "term", string_bucket("term"), "term_id", group)


def build_stats(docs: DataFrame, stopwords: Words, n_max: int, pattern: str, min_df: float,
                min_authors: int, group: Sequence[str] = (), stage: Callable[[DataFrame, str], DataFrame] | None = None,
                total: Column | None = None) -> DataFrame:
    """Term statistics of every term that can pass ``min_df`` and ``min_authors``.

    Without ``stage`` it is one pass over all n-grams. With ``stage`` (a function that writes a small
    table) it goes length by length: an n-gram is counted only where both of its (n-1)-grams passed,
    since neither its document frequency nor its author spread can be larger than theirs. The surviving
    terms are few (at most distinct terms per document / min_df), so tasks look up their hashes, and the
    wide n-gram shuffle of rare terms never happens. Hashes may be equal by chance; bounds are then tested on counts.
    """
    if stage is None or " " in "".join(re.findall(pattern, "a b")):
        return term_stats(first_pass(docs, stopwords, n_max, pattern), group)
    total = doc_total(docs, group) if total is None else total
    keep = lambda s: author_spread(df_band(s, total, min_df, float("inf")), min_authors)
    in_batches = T.word_class(pattern) is not None and (not isinstance(stopwords, Mapping) or "chamber" in group)
    parts = text_parts(docs) if in_batches else 0
    df = None if in_batches else with_tokens(docs.select(*group, "speaker", "text"), pattern, stopwords)
    level = out = None
    for n in range(1, n_max + 1):
        # An n-gram's two (n-1)-grams: all but the last token, and all but the first.
        known = _known_hashes(level) if level is not None and in_batches else None
        if in_batches and (n == 1 or known is not None):
            stats = _word_stats(docs, stopwords, pattern, n, known, parts, group)
        else:
            df = with_tokens(docs.select(*group, "speaker", "text"), pattern, stopwords) if df is None else df
            stats = term_stats(df.withColumnRenamed("tokens", "grams"), group) if n == 1 else _stats(known_grams(df, [*group, "speaker"], (n, n), level, parts=True), group)
        level = stage(keep(stats), f"terms{n}")
        out = level if out is None else out.unionByName(level)
    return out


def _word_stats(docs: DataFrame, stopwords: Words, pattern: str, n: int, known: G.np.ndarray | None, parts: int, group: Sequence[str]) -> DataFrame:
    """:func:`term_stats` of the n-grams of ``n`` words: texts are split in the batches, where their n-grams are counted."""
    cls, least = T.word_class(pattern)
    bits, keys, group = T.class_bits(docs.sparkSession, cls), [*group, "speaker"], list(group)
    words = {k: list(v) for k, v in stopwords.items()} if isinstance(stopwords, Mapping) else list(stopwords)
    rows = docs.select(*keys, F.lower("text").alias("text"))
    out = _schema("part int", rows, keys, "terms string, sizes array<int>, counts array<int>")
    placed = rows.mapInArrow(lambda batches: G.word_stats(batches, keys, words, "chamber", G.table_of(bits), least, n, known, parts), out).repartition(parts, "part")
    return placed.mapInArrow(lambda batches: G.by_term(batches, group, "speaker"), _schema("", placed, group, "term string, df bigint, n_authors bigint"))


def vocab_json(vocab: DataFrame) -> DataFrame:
    """The vocabulary as one JSON object term -> id, in id order. One bounded row."""
    pairs = F.sort_array(F.collect_list(F.struct("term_id", "term")))
    entries = F.transform(pairs, lambda p: F.struct(p["term"].alias("key"), p["term_id"].alias("value")))
    return vocab.agg(F.to_json(F.map_from_entries(entries)).alias("vocab_json"))


def vocab_duplicates(words: DataFrame) -> DataFrame:
    """Entries listed more than once."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_vocabulary(words: DataFrame, allow_duplicates: bool = False) -> None:
    row = words.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("word").alias("d")).first()
    if row.n == 0:
        raise ValueError("the vocabulary has no entries")
    if row.n > row.d and not allow_duplicates:
        raise ValueError(f"{row.n - row.d} vocabulary entries repeat another one")
