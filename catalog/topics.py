"""Topic lists, their metrics, run selection and LDA."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as T
from rostrum.operators import counts as C, em, lda, topics as M, variational as VB, vocabulary as V
from rostrum.plans.stage import stage

from .fixtures import DOCS, HASH, PASS1, PASS2, STOP, docs, hash_unit, sql_tokens, table
from .registry import query, r, with_ctes

K, N = 5, 10

# --- unigram vocabulary and counts ---------------------------------------------------------------

UNI = [DOCS, sql_tokens("tok1", "docs", PASS1, "doc_id, speaker"),
       "ustats AS (SELECT tok AS term, count(DISTINCT doc_id) AS df, count(DISTINCT speaker) AS n_authors FROM tok1 GROUP BY tok)",
       """uvocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM ustats
 WHERE n_authors >= 5 AND df >= 0.05 * (SELECT count(*) FROM docs) AND df <= 0.75 * (SELECT count(*) FROM docs))""",
       sql_tokens("tok2", "docs", PASS2, "doc_id"),
       "uc AS (SELECT doc_id, term_id, count(*) AS cnt FROM tok2 JOIN uvocab ON tok = term GROUP BY ALL)"]


def uni_vocab(spark, sf, d=None):
    d = docs(spark, sf) if d is None else d
    chosen = V.author_spread(V.df_band(V.term_stats(V.first_pass(d, STOP, 1)), V.doc_total(d), 0.05, 0.75), 5)
    return stage(V.select_vocabulary(stage(chosen, "chosen")), "vocab")


def uni_tables(spark, sf):
    """Vocabulary and written counts, as the preparation leaves them for the models."""
    d = docs(spark, sf, write=True)
    v = uni_vocab(spark, sf, d)
    return v, stage(C.document_term_counts(d, v, 1), "counts")


# --- topic lists ---------------------------------------------------------------------------------

_SHARED = HASH("term")
WEIGHTS = [*UNI, f"""weights AS (SELECT topic_id, term_id, term, {HASH("concat_ws(':', topic_id, term)")} + 2 * {_SHARED} AS weight FROM
 uvocab, (SELECT unnest(range({K}))::INT AS topic_id))"""]
TOPICS = [*WEIGHTS, f"""topics AS (SELECT topic_id, rank, term_id, term, weight FROM (SELECT *, CAST(row_number() OVER
 (PARTITION BY topic_id ORDER BY weight DESC, term_id) - 1 AS INT) AS rank FROM weights) WHERE rank < {N})"""]


def weights(vocab):
    t = vocab.withColumn("topic_id", F.explode(F.array(*[F.lit(i) for i in range(K)])))
    w = hash_unit(F.concat_ws(":", "topic_id", "term")) + F.lit(2) * hash_unit(F.col("term"))
    return t.select("topic_id", "term_id", "term", w.alias("weight"))


def topic_list(vocab):
    return stage(M.top_terms(weights(vocab), N), "topics")


@query("topic_top_terms", with_ctes(*TOPICS, select="SELECT topic_id, rank, term_id, round(weight, 6) AS weight FROM topics"))
def topic_top_terms(spark, sf):
    return M.top_terms(weights(uni_vocab(spark, sf)), N).withColumn("weight", r(F.col("weight")))


@query("topic_terms", with_ctes(*TOPICS, select="SELECT topic_id, rank, term_id, term FROM topics"))
def topic_terms(spark, sf):
    v = uni_vocab(spark, sf)
    return M.topic_terms(topic_list(v), v)


@query("topic_lines", with_ctes(*TOPICS, select="SELECT topic_id, string_agg(term, ' ' ORDER BY rank) AS line FROM topics WHERE rank < 8 GROUP BY topic_id"))
def topic_lines(spark, sf):
    v = uni_vocab(spark, sf)
    return M.topic_lines(M.topic_terms(topic_list(v), v), 8)


@query("topic_overlap", with_ctes(*TOPICS, select="""SELECT a.topic_id AS topic_i, b.topic_id AS topic_j, count(*) AS overlap
 FROM topics a JOIN topics b ON a.term_id = b.term_id AND a.topic_id < b.topic_id GROUP BY ALL"""))
def topic_overlap(spark, sf):
    return M.topic_overlap(topic_list(uni_vocab(spark, sf)), N)


_HOLD = "held AS (SELECT topic_id, count(*) OVER (PARTITION BY term_id) AS h FROM topics)"


@query("topic_uniqueness", with_ctes(*TOPICS, _HOLD, select=f"SELECT topic_id, round(sum(1.0::DOUBLE / h) / {N}, 6) AS tu FROM held GROUP BY topic_id"))
def topic_uniqueness(spark, sf):
    return M.topic_uniqueness(topic_list(uni_vocab(spark, sf)), N).withColumn("tu", r(F.col("tu")))


@query("topic_redundancy", with_ctes(*TOPICS, _HOLD, select=f"SELECT topic_id, round(sum(h - 1)::DOUBLE / {K - 1}, 6) AS tr FROM held GROUP BY topic_id"))
def topic_redundancy(spark, sf):
    return M.topic_redundancy(topic_list(uni_vocab(spark, sf)), K, N).withColumn("tr", r(F.col("tr")))


# Edges by position: topics in order of total overlap, then a walk over the later topics of each.
_EDGES = """ov AS (SELECT a.topic_id AS i, b.topic_id AS j, count(*) AS o, list(a.term_id) AS words FROM topics a JOIN topics b
 ON a.term_id = b.term_id AND a.topic_id <> b.topic_id GROUP BY ALL),
pos AS (SELECT t.topic_id, row_number() OVER (ORDER BY coalesce(sum(o), 0) DESC, t.topic_id DESC) - 1 AS p
 FROM (SELECT DISTINCT topic_id FROM topics) t LEFT JOIN ov ON ov.i = t.topic_id GROUP BY t.topic_id),
cand AS (SELECT a.p AS pi, b.p AS pj, o, words, row_number() OVER (PARTITION BY a.p ORDER BY o DESC, b.p DESC) AS s
 FROM ov JOIN pos a ON ov.i = a.topic_id JOIN pos b ON ov.j = b.topic_id WHERE a.p < b.p)"""
_WALK = """walk(pi, s, used, size) AS (SELECT pi, s, words, o FROM cand WHERE s = 1
 UNION ALL SELECT c.pi, c.s, CASE WHEN len(list_intersect(w.used, c.words)) = 0 THEN list_concat(w.used, c.words) ELSE w.used END,
 CASE WHEN len(list_intersect(w.used, c.words)) = 0 THEN c.o ELSE 0 END FROM walk w JOIN cand c ON c.pi = w.pi AND c.s = w.s + 1)"""
_SCORE = f"round(coalesce(sum(0.5 + (size - 1) * {N - 0.5} / {N - 1}) FILTER (size > 0), 0)::DOUBLE / ({N} * ({K} - 1)), 6)"


@query("topic_overlap_score", "WITH RECURSIVE " + ",\n".join([*TOPICS, _EDGES, _WALK]) +
       f"\nSELECT {_SCORE} AS \"to\", count(*) FILTER (size = {N}) AS entire_overlaps FROM walk")
def topic_overlap_score(spark, sf):
    return M.overlap_score(topic_list(uni_vocab(spark, sf)), K, N).withColumn("to", r(F.col("to")))


# The same walk, with the shared terms looked up by position among the topic ids.
_COMPAT = _EDGES.replace("SELECT a.p AS pi, b.p AS pj, o, words,", "SELECT a.p AS pi, b.p AS pj, ov.o AS o, coalesce(x.words, []) AS words,") \
    .replace("(PARTITION BY a.p ORDER BY o DESC", "(PARTITION BY a.p ORDER BY ov.o DESC") \
    .replace(" WHERE a.p < b.p)", " LEFT JOIN ov x ON x.i = a.p AND x.j = b.p WHERE a.p < b.p)")


@query("topic_overlap_score_compat", "WITH RECURSIVE " + ",\n".join([*TOPICS, _COMPAT, _WALK]) +
       f"\nSELECT {_SCORE} AS \"to\", count(*) FILTER (size = {N}) AS entire_overlaps FROM walk")
def topic_overlap_score_compat(spark, sf):
    return M.overlap_score(topic_list(uni_vocab(spark, sf)), K, N, compat=True).withColumn("to", r(F.col("to")))


# --- coherence -----------------------------------------------------------------------------------

_PAIRS = """seen AS (SELECT DISTINCT doc_id, term_id FROM uc WHERE term_id IN (SELECT term_id FROM topics)),
single AS (SELECT term_id, count(*) AS c FROM seen GROUP BY term_id),
pairs AS (SELECT a.topic_id, a.rank AS rank_i, b.rank AS rank_j, a.term_id AS term_i, b.term_id AS term_j
 FROM topics a JOIN topics b ON a.topic_id = b.topic_id AND a.rank < b.rank),
together AS (SELECT x.term_id AS term_i, y.term_id AS term_j, count(*) AS c FROM seen x JOIN seen y ON x.doc_id = y.doc_id GROUP BY ALL),
cooc AS (SELECT p.*, coalesce(i.c, 0) AS c_i, coalesce(j.c, 0) AS c_j, coalesce(t.c, 0) AS c_ij FROM pairs p
 LEFT JOIN single i ON i.term_id = term_i LEFT JOIN single j ON j.term_id = term_j LEFT JOIN together t USING (term_i, term_j))"""
_NPMI = """npmi AS (SELECT topic_id, avg(CASE WHEN c_ij = 0 THEN 0.0::DOUBLE WHEN c_ij = nd THEN 'NaN'::DOUBLE ELSE
 (ln(nd) + ln(c_ij) - ln(c_i) - ln(c_j)) / (ln(nd) - ln(c_ij)) END) AS npmi FROM cooc, (SELECT count(*) AS nd FROM docs) GROUP BY topic_id)"""


@query("pair_cooccurrence", with_ctes(*TOPICS, _PAIRS, select="SELECT topic_id, rank_i, rank_j, term_i, term_j, c_i, c_j, c_ij FROM cooc"))
def pair_cooccurrence(spark, sf):
    v, counts = uni_tables(spark, sf)
    return M.pair_cooccurrence(C.incidence(counts), topic_list(v), N)


def _n_docs(spark, sf):
    return table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()


@query("npmi", with_ctes(*TOPICS, _PAIRS, _NPMI, select="SELECT topic_id, round(npmi, 6) + 0.0::DOUBLE AS npmi FROM npmi"))
def npmi(spark, sf):
    v, counts = uni_tables(spark, sf)
    pairs = M.pair_cooccurrence(C.incidence(counts), topic_list(v), N)
    return M.npmi(pairs, _n_docs(spark, sf)).withColumn("npmi", r(F.col("npmi")))


@query("topic_metrics", "WITH RECURSIVE " + ",\n".join([*TOPICS, _PAIRS, _NPMI, _HOLD, _EDGES, _WALK]) +
       f"\nSELECT (SELECT round(avg(npmi), 6) + 0.0::DOUBLE FROM npmi) AS npmi_mean, (SELECT round(sum(1.0::DOUBLE / h) / {N * K}, 6) FROM held) AS tu_mean,"
       f" {_SCORE} AS \"to\", count(*) FILTER (size = {N}) AS entire_overlaps FROM walk")
def topic_metrics(spark, sf):
    v, counts = uni_tables(spark, sf)
    m = M.topic_metrics(C.incidence(counts), topic_list(v), _n_docs(spark, sf), K, N)
    return m.select(*[r(F.col(c)).alias(c) for c in ("npmi_mean", "tu_mean", "to")], "entire_overlaps")


# --- runs ----------------------------------------------------------------------------------------

RUNS = """runs AS (SELECT CAST(substr(source, 4) AS INT) AS seed, avg(n_chars) / 10000 AS npmi_mean, max(n_chars) / 50000.0::DOUBLE AS tu_mean
 FROM documents GROUP BY source)"""


def runs(spark, sf):
    return table(spark, sf, "documents").groupBy(F.substring("source", 4, 9).cast("int").alias("seed")).agg(
        (F.avg("n_chars") / 10000).alias("npmi_mean"), (F.max("n_chars") / F.lit(50000.0)).alias("tu_mean"))


@query("run_summary", with_ctes(RUNS, select="SELECT count(*) AS n_runs, round(avg(npmi_mean), 6) AS mean, round(stddev_samp(npmi_mean), 6) AS std FROM runs"))
def run_summary(spark, sf):
    return M.run_summary(runs(spark, sf)).select("n_runs", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"))


@query("best_run", with_ctes(RUNS, select="SELECT seed, round(npmi_mean + tu_mean, 6) AS score FROM runs ORDER BY npmi_mean + tu_mean DESC, seed LIMIT 1"))
def best_run(spark, sf):
    return M.best_run(runs(spark, sf), F.col("npmi_mean") + F.col("tu_mean")).select("seed", r(F.col("score")).alias("score"))


@query("eval_split", """SELECT doc_id, CAST('0x' || substr(md5(concat_ws(':', 42, doc_id)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.2 AS is_eval FROM documents""")
def eval_split(spark, sf):
    return M.eval_split(table(spark, sf, "documents").select("doc_id"), 0.2, 42)


# --- LDA -----------------------------------------------------------------------------------------

def _features(spark, sf):
    v, counts = uni_tables(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).first().n
    return lda.vectors(counts, n), n, v


def _top(model, n, vocab):
    return M.topic_terms(M.top_terms(lda.topic_weights(model, n), N), vocab)


@query("lda_online")
def lda_online(spark, sf):
    f, n, v = _features(spark, sf)
    return _top(lda.fit_online(f, K), n, v)


@query("lda_em")
def lda_em(spark, sf):
    v, counts = uni_tables(spark, sf)
    fit = em.fit(counts, v.agg(F.count(F.lit(1)).alias("n")).first().n, K, iterations=20, alpha=5.0, beta=0.01)
    return M.topic_terms(M.top_terms(fit.topic_weights(), N), v)


def _by_parts(spark, sf):
    v, counts = uni_tables(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).first().n
    return VB.fit(counts, n, VB.Online(num_topics=K, batches=4)), counts


@query("lda_topics")
def lda_topics(spark, sf):
    """Topic weights from the table cut by term; no matrix passes through the driver."""
    return _by_parts(spark, sf)[0].topic_weights()


@query("lda_theta")
def lda_theta(spark, sf):
    fit, counts = _by_parts(spark, sf)
    return fit.doc_topics(counts).select("doc_id", F.posexplode("theta").alias("topic_id", "weight"))
