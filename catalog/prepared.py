"""Whole preparation and topic initialisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.operators import speeches as S
from rostrum.plans.prepare import PrepareConfig, corpus_from_rows, prepare
from rostrum.plans.stage import new_path, stage
from rostrum.plans.topic_init import TopicConfig, init_topics_by_group
from rostrum.sources import transcripts

from . import fixtures, terms
from .fixtures import BIAS, MIN_SPEECHES, MODEL, PASS1, PASS2, SPEECHES, STOP, speeches, sql_deoverlap, sql_grams, sql_safe, sql_simple, sql_tokens, sql_trim, sql_ws
from .registry import query, with_ctes

CFG = PrepareConfig(min_speeches_per_speaker=MIN_SPEECHES, min_df=0.02, max_df=0.75, min_authors_per_word=3)


def prepared(spark, sf):
    corpus = S.split_chamber(speeches(spark, sf), "body").select("chamber", "doc_id", "speaker", "text")
    return prepare(corpus, STOP, stage(terms.model(spark, sf), "model"), F.lit(BIAS), CFG)


def _corpus(p: str, src: str, stop_table: str | None = None) -> list[str]:
    """CTEs of one pass over ``src (chamber, doc_id, speaker, text)``; results are ``p_final`` and ``p_vocab``."""
    anti = f" WHERE NOT EXISTS (SELECT 1 FROM {stop_table} s WHERE s.chamber = t.chamber AND s.term = t.tok)" if stop_table else ""
    return [sql_tokens(f"{p}_raw", src, PASS1, "chamber, doc_id, speaker"), f"{p}_tok AS (SELECT * FROM {p}_raw t{anti})",
            sql_grams(f"{p}_g1", f"{p}_tok", "chamber, doc_id, speaker"), f"""{p}_n AS (SELECT chamber, count(*) AS n FROM {src} GROUP BY chamber),
{p}_stats AS (SELECT chamber, term, count(DISTINCT doc_id) AS df, count(DISTINCT speaker) AS n_authors FROM {p}_g1 GROUP BY ALL),
{p}_vocab AS (SELECT chamber, term, len(string_split(term, ' ')) AS n, row_number() OVER (PARTITION BY chamber ORDER BY term) - 1 AS term_id
 FROM {p}_stats s JOIN (SELECT chamber, n AS total FROM {p}_n) USING (chamber)
 WHERE n_authors >= {CFG.min_authors_per_word} AND df >= {CFG.min_df} * total AND df <= {CFG.max_df} * total)""",
            sql_tokens(f"{p}_tok2", src, PASS2, "chamber, doc_id"), sql_grams(f"{p}_g2", f"{p}_tok2", "chamber, doc_id"),
            f"{p}_dtm AS (SELECT g.chamber, doc_id, term_id, v.n AS n, count(*) AS cnt FROM {p}_g2 g JOIN {p}_vocab v ON g.term = v.term AND g.chamber = v.chamber GROUP BY ALL)",
            f"""{p}_big AS (SELECT chamber, term_id, n, string_split(term, ' ') AS tok FROM {p}_vocab WHERE n > 1),
{p}_subs AS (SELECT DISTINCT chamber, term_id, n, unnest(tok) AS sub FROM {p}_big
 UNION SELECT chamber, term_id, n, tok[1] || ' ' || tok[2] FROM {p}_big WHERE n > 2 UNION SELECT chamber, term_id, n, tok[2] || ' ' || tok[3] FROM {p}_big WHERE n > 2),
{p}_overlap AS (SELECT s.chamber, s.term_id, s.n, v.term_id AS sub_id, v.n AS sub_n, s.term_id < v.term_id AS before
 FROM {p}_subs s JOIN {p}_vocab v ON s.sub = v.term AND s.chamber = v.chamber)""",
            sql_deoverlap(f"{p}_dtm", f"{p}_overlap", f"{p}_final", "chamber, doc_id", "chamber, ")]


PREPARED = [SPEECHES, *MODEL, f"""chambered AS (SELECT doc_id, speaker, text, lower({sql_trim("coalesce(body, '')")}) AS chamber FROM speeches),
corpus AS (SELECT * FROM chambered WHERE chamber IN ('house', 'senate')),
active AS (SELECT chamber, speaker FROM corpus GROUP BY ALL HAVING count(*) >= {MIN_SPEECHES}),
filled AS (SELECT c.chamber, doc_id, coalesce(c.speaker, 'UNKNOWN_SPEAKER') AS raw_speaker, coalesce(text, '') AS text
 FROM corpus c JOIN active a ON c.chamber = a.chamber AND c.speaker IS NOT DISTINCT FROM a.speaker),
one AS (SELECT chamber, doc_id, coalesce(nullif({sql_trim('raw_speaker')}, ''), 'UNKNOWN_SPEAKER') AS speaker, text FROM filled)""",
            *_corpus("a", "one"), f"""raw AS (SELECT chamber, doc_id, raw_speaker AS speaker, replace(text, chr(10), ' ') AS text FROM filled
 WHERE (chamber, doc_id) IN (SELECT chamber, doc_id FROM a_final)),
p_simple AS (SELECT chamber, doc_id, {sql_simple('text')} AS simple FROM raw),
p_short AS (SELECT * FROM p_simple WHERE length(simple) > 15 AND length(simple) < 400 AND length(simple) - length(replace(simple, ' ', '')) > 1)""",
            sql_tokens("p_tok", "p_short", "string_split(simple, ' ')", "chamber, doc_id"), sql_grams("p_gram", "p_tok", "chamber, doc_id", "_"),
            f"""p_hit AS (SELECT DISTINCT chamber, doc_id, term, weight FROM p_gram JOIN model USING (term)),
proc AS (SELECT chamber, doc_id FROM p_short LEFT JOIN p_hit USING (chamber, doc_id) GROUP BY ALL HAVING {BIAS} + coalesce(sum(weight), 0) > 0),
sw AS (SELECT chamber, term FROM p_hit JOIN proc USING (chamber, doc_id) JOIN (SELECT chamber, count(*) AS np FROM proc GROUP BY chamber) USING (chamber)
 GROUP BY chamber, term, np HAVING count(*) / np > {CFG.incidence_threshold}),
two AS (SELECT * FROM raw WHERE (chamber, doc_id) NOT IN (SELECT chamber, doc_id FROM proc))""",
            *_corpus("b", "two", "sw"),
            "b_auth AS (SELECT chamber, speaker, row_number() OVER (PARTITION BY chamber ORDER BY speaker) - 1 AS author_id FROM (SELECT DISTINCT chamber, speaker FROM two))"]


@query("prepare_tables", with_ctes(*PREPARED, select="""SELECT chamber, doc_id, author_id, term_id, term, cnt FROM b_final
 JOIN b_vocab USING (chamber, term_id) JOIN two USING (chamber, doc_id) JOIN b_auth USING (chamber, speaker)"""))
def prepare_tables(spark, sf):
    t = prepared(spark, sf).final
    placed = t.counts.select("chamber", "doc_id", "term_id", "cnt").join(t.docs.select("chamber", "doc_id", "author_id"), ["chamber", "doc_id"])
    return placed.join(t.vocab.select("chamber", "term_id", "term"), ["chamber", "term_id"]).select(
        "chamber", "doc_id", "author_id", "term_id", "term", "cnt")


# Ingestion drops rows without text, trims labels and makes one blank of white space.
_INGESTED = f"""spoken AS (SELECT doc_id, {fixtures._SPEAKER} AS s, {fixtures._BODY} AS body, {fixtures._TEXT} AS t FROM documents),
speeches AS (SELECT doc_id, {sql_safe('s')} AS speaker, body, {sql_ws('t')} AS text FROM spoken WHERE {sql_safe('t')} IS NOT NULL)"""


@query("ingest_prepare", with_ctes(_INGESTED, *PREPARED[1:], select="""SELECT chamber, term, count(DISTINCT doc_id) AS n_docs, CAST(sum(cnt) AS BIGINT) AS cnt
 FROM b_final JOIN b_vocab USING (chamber, term_id) GROUP BY ALL"""))
def ingest_prepare(spark, sf):
    """From JSON lines with many documents to a file, through ids, to prepared counts."""
    path = new_path(spark, "transcripts")
    item = F.struct(F.lit("speech").alias("kind"), F.lit("x").alias("speaker"), F.col("speaker").alias("speaker_bioguide"), "text")
    doc = F.struct(F.struct(F.lit(2000).alias("year"), F.lit("May").alias("month"), F.lit(3).alias("day"), F.col("body").alias("chamber")).alias("header"),
                   F.array(item).alias("content"))
    speeches(spark, sf).select(F.to_json(doc).alias("value")).write.text(path)
    rows = transcripts.with_doc_id(transcripts.speech_rows(transcripts.scan_json(spark, path, "*.txt", lines=True)))
    t = prepare(corpus_from_rows(rows), STOP, stage(terms.model(spark, sf), "model"), F.lit(BIAS), CFG).final
    named = t.counts.join(t.vocab.select("chamber", "term_id", "term"), ["chamber", "term_id"])
    return named.groupBy("chamber", "term").agg(F.count_distinct("doc_id").alias("n_docs"), F.sum("cnt").cast("bigint").alias("cnt"))


@query("topic_init", with_ctes(*PREPARED, select="""SELECT chamber, topic_id, CAST(least(10, n) AS BIGINT) AS n_top, TRUE AS ranked, TRUE AS scaled
 FROM (SELECT chamber, count(*) AS n FROM b_vocab GROUP BY chamber) AS c, range(5) AS t(topic_id)"""))
def topic_init(spark, sf):
    """Both chambers; per topic its number of top terms, whether their weights fall, and whether scaling kept their order."""
    t = prepared(spark, sf).final
    cfg = TopicConfig(num_topics=5, seeds=(22, 194), pf_steps=10, lda_iterations=10, drop_last_term=False)
    rows = None
    for chamber, out in init_topics_by_group(t.counts, t.vocab, S.CHAMBERS, cfg).items():
        top = out.topics.join(out.weights.select("topic_id", "term_id", "weight"), ["topic_id", "term_id"]) \
            .join(out.topic_word.select("topic_id", "term_id", F.col("weight").alias("scaled_weight")), ["topic_id", "term_id"])
        part = top.select(F.lit(chamber).alias("chamber"), "topic_id", "rank", "weight", "scaled_weight")
        rows = part if rows is None else rows.unionByName(part)
    seq = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("rank", c))), lambda x: x[c])
    falls = lambda a: F.coalesce(a == F.reverse(F.array_sort(a)), F.lit(False))
    got = rows.groupBy("chamber", "topic_id").agg(F.count("*").alias("n_top"), seq("weight").alias("w"), seq("scaled_weight").alias("s"))
    return got.select("chamber", F.col("topic_id").cast("bigint").alias("topic_id"), "n_top", falls(F.col("w")).alias("ranked"), falls(F.col("s")).alias("scaled"))
