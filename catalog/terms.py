"""n-grams, vocabulary, counts, de-overlap and boilerplate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as T
from rostrum.operators import align, counts as C, ids, procedural as P, vocabulary as V
from rostrum.plans import sinks
from rostrum.plans.stage import new_path, stage
from rostrum.sources import tables

from .fixtures import (BIAS, COUNTS, DOCS, GRAMS1, HASH, MAX_DF, MIN_AUTHORS, MIN_DF, MODEL, OVERLAP, PASS2, SHORT, STATS, STOP, VOCAB,
                       docs, hash_unit, sql_deoverlap, sql_grams, sql_tokens, table)
from .registry import query, r, with_ctes

# --- analysers: all n-grams of a document as one digest ----------------------------------------

_DIGEST_SQL = "SELECT doc_id, count(*) AS n_grams, count(DISTINCT term) AS n_distinct, md5(string_agg(term, '|' ORDER BY n, pos)) AS digest FROM {} GROUP BY doc_id"


def _digest(df):
    some = F.filter(F.array(F.array_compact("grams")), lambda g: F.size(g) > 0)
    return df.select("doc_id", F.explode(some).alias("g")).select(
        "doc_id", F.size("g").cast("bigint").alias("n_grams"), F.size(F.array_distinct("g")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("g", "|").cast("binary")).alias("digest"))


@query("ngrams_pass1", with_ctes(*GRAMS1, select=_DIGEST_SQL.format("gram1")))
def ngrams_pass1(spark, sf):
    return _digest(V.first_pass(docs(spark, sf), STOP))


@query("ngrams_pass2", with_ctes(DOCS, sql_tokens("tok2", "docs", PASS2, "doc_id"), sql_grams("gram2", "tok2", "doc_id"),
                                 select=_DIGEST_SQL.format("gram2")))
def ngrams_pass2(spark, sf):
    return _digest(V.second_pass(docs(spark, sf)))


@query("ngrams_underscore", with_ctes(*SHORT, select=_DIGEST_SQL.format("sgram")))
def ngrams_underscore(spark, sf):
    return _digest(P.underscored_ngrams(P.short_candidates(docs(spark, sf))))


# --- vocabulary --------------------------------------------------------------------------------

def vocabulary(d, staged=False):
    """Vocabulary of the documents under the catalog's thresholds."""
    stats = V.build_stats(d, STOP, 3, T.FIRST_PASS_PATTERN, MIN_DF, MIN_AUTHORS, stage=stage)
    chosen = V.author_spread(V.df_band(stats, V.doc_total(d), MIN_DF, MAX_DF), MIN_AUTHORS)
    v = V.select_vocabulary(chosen)
    return stage(v, "vocab") if staged else v


@query("term_stats", with_ctes(*STATS, select="SELECT term, df, n_authors FROM stats"))
def term_stats(spark, sf):
    return V.term_stats(V.first_pass(docs(spark, sf), STOP)).select("term", "df", "n_authors")


@query("author_term_counts", with_ctes(*GRAMS1, select="SELECT speaker, term, count(*) AS cnt FROM gram1 GROUP BY ALL"))
def author_term_counts(spark, sf):
    return V.author_term_counts(V.first_pass(docs(spark, sf), STOP)).select("speaker", "term", "cnt")


@query("df_band", with_ctes(*STATS, select=f"""SELECT term, df FROM stats WHERE df >= {MIN_DF} * (SELECT count(*) FROM docs)
 AND df <= {MAX_DF} * (SELECT count(*) FROM docs)"""))
def df_band(spark, sf):
    d = docs(spark, sf)
    return V.df_band(V.term_stats(V.first_pass(d, STOP)), V.doc_total(d), MIN_DF, MAX_DF).select("term", "df")


@query("author_spread", with_ctes(*STATS, select="SELECT term, n_authors FROM stats WHERE n_authors >= 5"))
def author_spread(spark, sf):
    return V.author_spread(V.term_stats(V.first_pass(docs(spark, sf), STOP)), 5).select("term", "n_authors")


@query("vocab_ids", with_ctes(*VOCAB, select="SELECT term_id, term, CAST(n AS INT) AS n FROM vocab"))
def vocab_ids(spark, sf):
    return vocabulary(docs(spark, sf, write=True)).select("term_id", "term", "n")


@query("vocab_json", with_ctes(*VOCAB, select="""SELECT '{' || string_agg('"' || term || '":' || term_id, ',' ORDER BY term_id) || '}' AS vocab_json FROM vocab"""))
def vocab_json(spark, sf):
    return V.vocab_json(vocabulary(docs(spark, sf, write=True)))


@query("vocab_json_parts", with_ctes(*VOCAB, select="""SELECT '{' AS line, -1 AS place UNION ALL
 SELECT '  "' || term || '": ' || term_id || CASE WHEN term_id < (SELECT max(term_id) FROM vocab) THEN ',' ELSE '' END, term_id FROM vocab
 UNION ALL SELECT '}', max(term_id) + 1 FROM vocab"""))
def vocab_json_parts(spark, sf):
    """The JSON lines in the order of the part files, numbered by their place in them."""
    path = new_path(spark, "vocab-json")
    sinks.write_vocab_json_parts(vocabulary(docs(spark, sf, write=True), staged=True), path)
    lines = tables._lines(spark, path).withColumnRenamed("line_no", "at")
    return ids.range_ids(lines, "at", "place").select(F.col("value").alias("line"), (F.col("place") - 1).alias("place"))


@query("overlap_map", with_ctes(*VOCAB, OVERLAP, select="SELECT term_id, CAST(n AS INT) AS n, sub_id, CAST(sub_n AS INT) AS sub_n, before FROM overlap"))
def overlap_map(spark, sf):
    return C.overlap_map(vocabulary(docs(spark, sf, write=True), staged=True)).select("term_id", "n", "sub_id", "sub_n", "before")


# --- counts ------------------------------------------------------------------------------------

@query("dtm_counts", with_ctes(*COUNTS, select="SELECT doc_id, term_id, cnt FROM dtm"))
def dtm_counts(spark, sf):
    d = docs(spark, sf, write=True)
    return C.document_term_counts(d, vocabulary(d, staged=True)).select("doc_id", "term_id", "cnt")


def final_counts(d):
    v = vocabulary(d, staged=True)
    packed = stage(C.pack_overlaps(C.overlap_map(v)), "overlaps")
    return C.deoverlap(C.document_term_counts(d, v), packed)


FINAL = [*COUNTS, OVERLAP, sql_deoverlap("dtm", "overlap", "final")]


@query("deoverlap", with_ctes(*FINAL, select="SELECT doc_id, term_id, cnt FROM final"))
def deoverlap(spark, sf):
    return final_counts(docs(spark, sf, write=True)).select("doc_id", "term_id", "cnt")


@query("nonempty_docs", with_ctes(*FINAL, select="SELECT doc_id, CAST(sum(cnt) AS BIGINT) AS total FROM final GROUP BY doc_id"))
def nonempty_docs(spark, sf):
    return C.nonempty_docs(final_counts(docs(spark, sf, write=True))).select("doc_id", "total")


@query("packed_docs", with_ctes(*FINAL, select="""SELECT doc_id, count(*) AS n_terms, string_agg(term_id || ':' || cnt, ' ' ORDER BY term_id) AS packed FROM final GROUP BY doc_id"""))
def packed_docs(spark, sf):
    pairs = F.zip_with("idx", "val", lambda i, v: F.concat_ws(":", i, v.cast("bigint")))
    return C.packed_docs(final_counts(docs(spark, sf, write=True))).select("doc_id", F.size("idx").cast("bigint").alias("n_terms"),
                                                        F.array_join(pairs, " ").alias("packed"))


@query("finalized_docs", with_ctes(*FINAL, "a AS (SELECT speaker, row_number() OVER (ORDER BY speaker) - 1 AS author_id FROM (SELECT DISTINCT speaker FROM docs))",
                                   select="""SELECT doc_id, speaker, author_id, replace(text, chr(10), ' ') AS text FROM docs JOIN a USING (speaker)
 WHERE doc_id IN (SELECT doc_id FROM final)"""))
def finalized_docs(spark, sf):
    d = docs(spark, sf, write=True)
    kept = d.join(C.nonempty_docs(final_counts(d)), "doc_id", "left_semi")
    return ids.author_ids(kept, ids.author_dimension(d)).select("doc_id", "speaker", "author_id", T.flatten_newlines(F.col("text")).alias("text"))


@query("doc_export_ids", with_ctes(*FINAL, select="SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM (SELECT DISTINCT doc_id FROM final)"))
def doc_export_ids(spark, sf):
    return ids.export_ids(C.nonempty_docs(final_counts(docs(spark, sf, write=True))).select("doc_id")).select("doc_id", "row_id")


# --- boilerplate -------------------------------------------------------------------------------

def model(spark, sf):
    """Weights of the 50 most frequent n-grams of short documents."""
    g = P.underscored_ngrams(P.short_candidates(docs(spark, sf)))
    top = V.explode_grams(g, []).groupBy("term").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "term").limit(50)
    return top.select("term", F.round(F.lit(2) * hash_unit(F.col("term")) - 1, 6).alias("weight"))


def scored(spark, sf):
    return P.score(P.short_candidates(docs(spark, sf)), model(spark, sf), F.lit(BIAS))


SCORED = [*MODEL, f"""hit AS (SELECT DISTINCT doc_id, term, weight FROM sgram JOIN model USING (term)),
scored AS (SELECT doc_id, {BIAS} + coalesce(sum(weight), 0) AS score FROM short LEFT JOIN hit USING (doc_id) GROUP BY doc_id)"""]


@query("candidates", with_ctes(*SHORT[:3], select="SELECT doc_id, simple FROM cand"))
def candidates(spark, sf):
    return P.candidates(docs(spark, sf)).select("doc_id", "simple")


@query("short_candidates", with_ctes(*SHORT[:4], select="SELECT doc_id, simple FROM short"))
def short_candidates(spark, sf):
    return P.short_candidates(docs(spark, sf)).select("doc_id", "simple")


@query("model_scan", with_ctes(*MODEL, select="""SELECT term, weight, (SELECT arg_min(weight, term) FROM model) AS bias FROM model
 WHERE term > (SELECT min(term) FROM model)"""))
def model_scan(spark, sf):
    from rostrum.plans import sinks
    from rostrum.plans.stage import new_path
    from rostrum.sources import tables

    path = new_path(spark, "model")
    m = model(spark, sf)
    body = m.select(F.concat_ws("\t", "term", "weight").alias("text"), F.lit(1).alias("part"), "term")
    head = spark.range(1).select(F.lit("feature\tweight").alias("text"), F.lit(0).alias("part"), F.lit("").alias("term"))
    sinks.write_texts(head.unionByName(body), path, order=("part", "term"))
    terms, bias = tables.split_model(tables.read_weights(spark, path))
    return terms.select("term", "weight", bias.scalar().alias("bias"))


@query("procedural_score", with_ctes(*SCORED, select="SELECT doc_id, round(score, 6) + 0.0::DOUBLE AS score FROM scored"))
def procedural_score(spark, sf):
    return scored(spark, sf).select("doc_id", r(F.col("score")).alias("score"))


@query("procedural_docs", with_ctes(*SCORED, select="SELECT doc_id FROM scored WHERE score > 0"))
def procedural_docs(spark, sf):
    return P.procedural_docs(scored(spark, sf)).select("doc_id")


@query("procedural_stopwords", with_ctes(*SCORED, "proc AS (SELECT doc_id FROM scored WHERE score > 0)",
                                         select="""SELECT term, round(count(*) / (SELECT count(*) FROM proc), 6) AS share FROM hit JOIN proc USING (doc_id)
 GROUP BY term HAVING count(*) / (SELECT count(*) FROM proc) > 0.1"""))
def procedural_stopwords(spark, sf):
    return P.procedural_stopwords(stage(scored(spark, sf), "scored")).select("term", r(F.col("share")).alias("share"))


@query("without_procedural", with_ctes(*SCORED, select="SELECT doc_id, text FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM scored WHERE score > 0)"))
def without_procedural(spark, sf):
    return P.without_procedural(docs(spark, sf), scored(spark, sf)).select("doc_id", "text")


@query("ordered_subset", with_ctes(*SCORED, "kept AS (SELECT doc_id, text FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM scored WHERE score > 0))",
                                   select="SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rank, doc_id AS pos, text FROM kept"))
def ordered_subset(spark, sf):
    d = docs(spark, sf, write=True)
    kept = stage(P.without_procedural(d, scored(spark, sf)), "kept")
    # The filtered list has its own positions, as lines of a second file have.
    lines = stage(ids.export_ids(kept.select("doc_id", "text")).select(F.col("row_id").alias("pos"), "text"), "lines")
    return align.ordered_subset(d.select(F.col("doc_id").alias("pos"), "text"), lines)


#: Short documents say one of a few things, and a hash of their id, not their text, says which of them stay.
_SAID = "said AS (SELECT doc_id, CASE WHEN n_chars < 600 THEN lang ELSE text END AS text FROM documents)"
_SOME = f"given AS (SELECT text, row_number() OVER (ORDER BY doc_id) AS j FROM said WHERE {HASH('CAST(doc_id AS VARCHAR)')} < 0.6)"


@query("ordered_subset_greedy", "WITH RECURSIVE " + _SAID + ",\n" + _SOME + """,
walk(j, pos, text) AS (SELECT j, pos, text FROM (SELECT g.j, min(s.doc_id) AS pos, g.text FROM given g JOIN said s USING (text) WHERE g.j = 1 GROUP BY g.j, g.text)
 UNION ALL SELECT g.j, min(s.doc_id), g.text FROM walk w JOIN given g ON g.j = w.j + 1 JOIN said s ON s.text = g.text AND s.doc_id > w.pos GROUP BY g.j, g.text)
SELECT j - 1 AS rank, pos, text FROM walk""")
def ordered_subset_greedy(spark, sf):
    d = table(spark, sf, "documents")
    said = stage(d.select("doc_id", F.expr("CASE WHEN n_chars < 600 THEN lang ELSE text END").alias("text")), "said")
    some = ids.export_ids(said.filter(hash_unit(F.col("doc_id").cast("string")) < 0.6)).select(F.col("row_id").alias("pos"), "text")
    return align.ordered_subset_greedy(said.select(F.col("doc_id").alias("pos"), "text"), stage(some, "lines"))
