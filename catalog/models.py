"""Topic models over documents in parts: the sampler, online steps, and mixtures of held-out documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.operators import counts as C, gibbs, topics as M, variational as VB
from rostrum.operators.parts import in_parts
from rostrum.plans.stage import stage
from rostrum.plans.topic_init import TopicConfig, init_topics

from .factors import FACTORS, _psi, state
from .fixtures import HASH, hash_unit
from .registry import query, r, with_ctes
from .topics import _EDGES, _HOLD, _NPMI, _PAIRS, _SCORE, _WALK, K as TOPICS, N, TOPICS as TOPIC_LISTS, UNI, WEIGHTS, _n_docs, uni_tables, weights

K = 3


def _size(v) -> int:
    return v.agg(F.count(F.lit(1)).alias("n")).first().n


# --- Gibbs sampling ------------------------------------------------------------------------------

@query("lda_gibbs", with_ctes(*UNI, select="""SELECT 'term' AS kind, term_id AS id, CAST(sum(cnt) AS BIGINT) AS n FROM uc GROUP BY term_id
 UNION ALL SELECT 'document', doc_id, CAST(sum(cnt) AS BIGINT) FROM uc GROUP BY doc_id"""))
def lda_gibbs(spark, sf):
    """Tokens by term and by document after eight passes: the sampler moves them between topics and loses none."""
    v, counts = uni_tables(spark, sf)
    fit = gibbs.fit(counts, _size(v), gibbs.Sampler(num_topics=K, passes=8, burn_in=4, optimize_every=2), seed=22)
    by_term = fit.counts.groupBy(F.col("term_id").cast("bigint").alias("id")).agg(F.sum("n").alias("n"))
    by_doc = fit.state.select(F.col("doc_id").alias("id"), F.size("topics").cast("bigint").alias("n"))
    return by_term.select(F.lit("term").alias("kind"), "id", "n").unionByName(by_doc.select(F.lit("document").alias("kind"), "id", "n"))


# --- variational steps in SQL --------------------------------------------------------------------

def _rounds(docs: str, beta: str, alpha: float, k: int, iterations: int, tolerance: float) -> list[str]:
    """CTEs ``g0 .. gN (doc_id, k, g, done, rounds)`` of the documents' parameters, and ``s0 .. sN`` of the shares per count."""
    out = [f"g0 AS (SELECT doc_id, k, 1.0::DOUBLE AS g, false AS done, 0 AS rounds FROM (SELECT DISTINCT doc_id FROM {docs}), (SELECT unnest(range({k}))::INT AS k))"]
    for i in range(iterations + 1):
        out += [f"w{i} AS (SELECT *, sum(g) OVER (PARTITION BY doc_id) AS a FROM g{i})",
                f"t{i} AS (SELECT *, exp({_psi('g')} - {_psi('a')}) AS t FROM w{i})",
                f"s{i} AS (SELECT doc_id, term_id, cnt / (sum(t * b) + 1e-100) AS s FROM {docs} JOIN {beta} USING (term_id) JOIN t{i} USING (doc_id, k) GROUP BY doc_id, term_id, cnt)"]
        if i < iterations:
            out += [f"x{i} AS (SELECT doc_id, k, {alpha} + any_value(t) * sum(s * b) AS x FROM t{i} JOIN s{i} USING (doc_id) JOIN {beta} USING (term_id, k) GROUP BY doc_id, k)",
                    f"""g{i + 1} AS (SELECT doc_id, k, CASE WHEN done THEN g ELSE x END AS g, done OR avg(abs(x - g)) OVER (PARTITION BY doc_id) < {tolerance} AS done,
 rounds + CASE WHEN done THEN 0 ELSE 1 END AS rounds FROM g{i} JOIN x{i} USING (doc_id, k))"""]
    return out


STEP = VB.Online(num_topics=K, alpha=0.4, eta=0.1, offset=3.0, batches=2, iterations=3, tolerance=0.0)
RATE = STEP.offset ** -STEP.decay
_U = lambda part: HASH(f"concat_ws(':', 42, 'lambda', term_id, k, '{part}')")
STEP_SQL = [*UNI, f"""lam AS (SELECT term_id, k, exp(0.1 * sqrt(-2 * ln({_U('a')})) * cos(2 * pi() * {_U('b')})) AS lam FROM uvocab, (SELECT unnest(range({K}))::INT AS k))""",
            "lsum AS (SELECT term_id, k, lam, sum(lam) OVER (PARTITION BY k) AS s FROM lam)", f"eb AS (SELECT term_id, k, exp({_psi('lam')} - {_psi('s')}) AS b FROM lsum)",
            "bd AS (SELECT * FROM uc WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 2 = 0)",
            *_rounds("bd", "eb", 0.4, K, STEP.iterations, 0.0),
            f"st AS (SELECT term_id, k, sum(s * t * b) AS st FROM s{STEP.iterations} JOIN t{STEP.iterations} USING (doc_id) JOIN eb USING (term_id, k) GROUP BY term_id, k)",
            "sc AS (SELECT (SELECT count(DISTINCT doc_id) FROM uc) / CAST((SELECT count(DISTINCT doc_id) FROM bd) AS DOUBLE) AS sc)"]


@query("lda_online_step", with_ctes(*STEP_SQL, select=f"""SELECT term_id, k AS topic_id,
 round((1 - {RATE!r}) * lam + {RATE!r} * (0.1 + sc * coalesce(st, 0)), 5) AS lam FROM lam LEFT JOIN st USING (term_id, k), sc"""))
def lda_online_step(spark, sf):
    """The topics after one batch, half of the documents."""
    v, counts = uni_tables(spark, sf)
    parts = in_parts(counts, batches=STEP.batches)
    alpha, eta = VB.priors(STEP)
    new, _, _ = VB.step(parts, VB.start(spark, _size(v), K, 42), alpha, eta, RATE, STEP, 0)
    return new.select("term_id", F.posexplode("lam").alias("topic_id", "x")).select("term_id", "topic_id", r(F.col("x"), 5).alias("lam"))


SHARE, ROUNDS, TOLERANCE, ALPHA = 0.3, 8, 0.05, 0.2
EVAL_SQL = [*UNI, WEIGHTS[-1], "bw AS (SELECT term_id, topic_id AS k, weight / sum(weight) OVER (PARTITION BY topic_id) AS b FROM weights)",
            f"ed AS (SELECT * FROM uc WHERE CAST('0x' || substr(md5(concat_ws(':', 42, doc_id)), 1, 8) AS BIGINT) / 4294967296.0 < {SHARE})",
            *_rounds("ed", "bw", ALPHA, TOPICS, ROUNDS, TOLERANCE)]


@query("lda_eval_theta", with_ctes(*EVAL_SQL, select=f"SELECT doc_id, k AS topic_id, round(g / a, 5) AS weight, rounds FROM w{ROUNDS}"))
def lda_eval_theta(spark, sf):
    """Mixtures of the held-out documents only, under fixed topics; each stops when it has settled."""
    v, counts = uni_tables(spark, sf)
    held = M.eval_split(counts, SHARE, 42).filter("is_eval").drop("is_eval")
    sums = F.sum("weight").over(M.Window.partitionBy("topic_id"))
    beta = VB.by_term(weights(v).select("topic_id", "term_id", (F.col("weight") / sums).alias("weight")))
    found = VB.fold_in(held, beta, [ALPHA] * TOPICS, ROUNDS, TOLERANCE)
    return found.select("doc_id", F.posexplode("theta").alias("topic_id", "w"), "rounds").select("doc_id", "topic_id", r(F.col("w"), 5).alias("weight"), "rounds")


# --- snapshots of one fit ------------------------------------------------------------------------

STEPS = 6
#: Every topic's weights move with the step; topic 0 stays as it is, so its list occurs at every step.
_STEP_TOPICS = [*UNI, f"""topics AS (SELECT topic_id, rank, term_id FROM (SELECT topic_id, term_id, CAST(row_number() OVER (PARTITION BY topic_id
 ORDER BY {HASH(f"concat_ws(':', CASE WHEN topic_id % {K} = 0 THEN 0 ELSE topic_id END, term)")} DESC, term_id) - 1 AS INT) AS rank
 FROM uvocab, (SELECT unnest(range({K * STEPS}))::INT AS topic_id)) WHERE rank < {N})"""]


@query("best_snapshot", with_ctes(*_STEP_TOPICS, _PAIRS, _NPMI, f"scores AS (SELECT topic_id // {K} AS step, avg(npmi) AS score FROM npmi GROUP BY ALL)",
                                  "best AS (SELECT step, score FROM scores ORDER BY score DESC, step LIMIT 1)",
                                  select=f"SELECT CAST(step AS INT) AS step, round(score, 6) AS score, CAST(topic_id % {K} AS INT) AS topic_id, rank, term_id FROM topics JOIN best ON step = topic_id // {K}"))
def best_snapshot(spark, sf):
    v, counts = uni_tables(spark, sf)
    each = v.select("term_id", "term", F.explode(F.sequence(F.lit(0), F.lit(K * STEPS - 1))).alias("topic_id"))
    name = F.when(F.col("topic_id") % K == 0, F.lit(0)).otherwise(F.col("topic_id"))
    lists = M.top_terms(each.select("topic_id", "term_id", hash_unit(F.concat_ws(":", name, "term")).alias("weight")), N)
    seen = stage(lists.select(F.floor(F.col("topic_id") / K).cast("int").alias("step"), (F.col("topic_id") % K).alias("topic_id"), "rank", "term_id"), "snapshots")
    scores = stage(M.snapshot_scores(C.incidence(counts), seen, _n_docs(spark, sf), N), "scores")
    return M.best_snapshot(seen, scores).withColumn("score", r(F.col("score")))


# --- topic initialisation from stored factors ----------------------------------------------------

_THETA = HASH("concat_ws(':', 'theta', doc_id, topic_id)")
_HELD = [x.replace("FROM uc ", "FROM ed ").replace("SELECT count(*) AS nd FROM docs", "SELECT count(DISTINCT doc_id) AS nd FROM ed") for x in (_PAIRS, _NPMI)]
CFG = TopicConfig(num_topics=TOPICS, eval_words=N, lda_alpha=5.0, eval_share=SHARE, eval_iterations=ROUNDS, eval_tolerance=TOLERANCE)
INIT_SQL = [
    *FACTORS, *TOPIC_LISTS[len(UNI):], "bw AS (SELECT term_id, topic_id AS k, weight AS b FROM weights)",
    f"ed AS (SELECT * FROM uc WHERE CAST('0x' || substr(md5(concat_ws(':', 42, doc_id)), 1, 8) AS BIGINT) / 4294967296.0 < {SHARE})",
    *_rounds("ed", "bw", 1.0, TOPICS, ROUNDS, TOLERANCE), *_HELD, _HOLD, _EDGES, _WALK,
    f"ldat AS (SELECT doc_id, topic_id, {_THETA} AS x FROM (SELECT DISTINCT doc_id FROM uc), (SELECT unnest(range({TOPICS}))::INT AS topic_id))",
    "bs AS (SELECT topic_id, term_id, weight * bm AS x FROM weights, bm)", "lastterm AS (SELECT max(term_id) AS m FROM uvocab)"]


@query("topic_init_tables", "WITH RECURSIVE " + ",\n".join(INIT_SQL) + f"""
SELECT 'beta_scaled' AS what, topic_id AS topic, count(*) AS n, max(term_id) AS last, round(sum(x), 3) AS total FROM bs GROUP BY topic_id
UNION ALL SELECT 'topic_word', topic_id, count(*), max(term_id), round(sum(x + 1e-6), 3) FROM bs, lastterm WHERE term_id < m GROUP BY topic_id
UNION ALL SELECT 'theta_scaled', topic_id, count(*), max(doc_id), round(sum(x * tm), 3) FROM ldat, tm GROUP BY topic_id
UNION ALL SELECT 'eval_theta', k, count(*), max(doc_id), round(sum(g / a), 3) FROM w{ROUNDS} GROUP BY k
UNION ALL SELECT 'top_terms', topic_id, count(*), max(term_id), CAST(sum(rank) AS DOUBLE) FROM topics GROUP BY topic_id
UNION ALL SELECT 'npmi_mean', -1, 1, -1, (SELECT round(avg(npmi), 6) + 0.0::DOUBLE FROM npmi)
UNION ALL SELECT 'tu_mean', -1, 1, -1, (SELECT round(sum(1.0::DOUBLE / h) / {N * TOPICS}, 6) FROM held)
UNION ALL SELECT 'to', -1, 1, -1, (SELECT {_SCORE} FROM walk)
UNION ALL SELECT 'entire_overlaps', -1, 1, -1, (SELECT CAST(count(*) FILTER (size = {N}) AS DOUBLE) FROM walk)""")
def topic_init_tables(spark, sf):
    """Everything that initialisation makes of stored factors and topics: sums, numbers of rows and last ids by topic, and
    the metrics. A share of the documents is held out; the last term goes, as it does by default."""
    v, counts, theta, beta = state(spark, sf)
    ks = F.sequence(F.lit(0), F.lit(TOPICS - 1))
    mixtures = counts.select("doc_id").distinct().select("doc_id", F.transform(ks, lambda k: hash_unit(F.concat_ws(":", F.lit("theta"), "doc_id", k))).alias("theta"))
    out = init_topics(counts, v, CFG, (theta, beta), (weights(v).drop("term"), mixtures))
    total = lambda x: (F.count("*").alias("n"), F.max("id").alias("last"), r(F.sum(x), 3).alias("total"))
    by_topic = lambda what, df, x: df.groupBy(F.col("topic_id").alias("topic")).agg(*total(x)).select(
        F.lit(what).alias("what"), F.col("topic").cast("bigint").alias("topic"), "n", F.col("last").cast("bigint").alias("last"), F.col("total").cast("double").alias("total"))
    long = lambda df: df.select(F.col("doc_id").alias("id"), F.posexplode("theta").alias("topic_id", "x"))
    word = lambda df: df.withColumnRenamed("term_id", "id")
    rows = [by_topic("beta_scaled", word(out.beta_scaled), "weight"), by_topic("topic_word", word(out.topic_word), "weight"),
            by_topic("theta_scaled", long(out.theta_scaled), "x"), by_topic("eval_theta", long(out.eval_theta), "x"), by_topic("top_terms", word(out.topics), "rank")]
    metric = out.metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), r(F.col(f"`{c}`").cast("double")).alias("total"))
                                                    for c in ("npmi_mean", "tu_mean", "to", "entire_overlaps")])).alias("m"))
    minus = F.lit(-1).cast("bigint")
    rows.append(metric.select("m.what", minus.alias("topic"), F.lit(1).cast("bigint").alias("n"), minus.alias("last"), "m.total"))
    return reduce(DataFrame.unionByName, rows)
