"""Topic initialisation: factorisation over seeds, LDA with metrics, and rescaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import factorization as PF
from ..operators import em, gibbs, scaling, topics
from ..operators import variational as VB
from ..operators.counts import incidence
from ..sources.tables import require_columns
from .stage import stage
from .versions import Versions


@dataclass(frozen=True)
class TopicConfig:
    num_topics: int = 50
    seeds: Sequence[int] = PF.DEFAULT_SEEDS
    pf_steps: int = 300
    lda_iterations: int = 50
    lda_alpha: float = 5.0
    lda_beta: float = 0.01
    lda_seed: int = 42
    eval_words: int = 10
    #: ``em``; ``gibbs``, the collapsed sampler; or ``online``, variational steps on topics cut by term.
    optimizer: str = "em"
    drop_last_term: bool = True
    #: Share of the documents that the topics are not fitted on: their mixtures are inferred, and coherence is taken over them.
    eval_share: float = 0.0
    eval_seed: int = 42
    eval_iterations: int = 50
    eval_tolerance: float = 1e-3


@dataclass
class TopicInit:
    pf_theta: DataFrame
    pf_beta: DataFrame
    weights: DataFrame
    theta: DataFrame
    topics: DataFrame
    metrics: DataFrame
    beta_scaled: DataFrame
    theta_scaled: DataFrame
    topic_word: DataFrame
    #: ``(doc_id, theta, rounds)`` of the held-out documents; none without an evaluation share.
    eval_theta: DataFrame | None = None


def _fit_lda(counts: DataFrame, num_terms: int, cfg: TopicConfig) -> tuple[DataFrame, DataFrame]:
    """``(topic_id, term_id, weight)`` and ``(doc_id, theta)`` of the fitted documents."""
    k = cfg.num_topics
    if cfg.optimizer == "gibbs":
        rules = gibbs.Sampler(k, cfg.lda_alpha, cfg.lda_beta, cfg.lda_iterations)
        fit = gibbs.fit(counts, num_terms, rules, cfg.lda_seed)
        return fit.topic_weights(), fit.doc_topics()
    if cfg.optimizer == "online":
        fit = VB.fit(counts, num_terms, VB.Online(k), cfg.lda_seed)
        return fit.topic_weights(), fit.doc_topics(counts).select("doc_id", "theta")
    if cfg.optimizer != "em":
        raise ValueError(f"no such optimizer: {cfg.optimizer!r}")
    fit = em.fit(counts, num_terms, k, cfg.lda_seed, cfg.lda_iterations, cfg.lda_alpha, cfg.lda_beta)
    return fit.topic_weights(), fit.doc_topics(counts).select("doc_id", "theta")


def init_topics(counts: DataFrame, vocab: DataFrame, cfg: TopicConfig = TopicConfig(),
                factors: tuple[DataFrame, DataFrame] | None = None,
                lda_result: tuple[DataFrame, DataFrame] | None = None) -> TopicInit:
    """Initialise topics of one group's ``counts`` and ``vocab``.

    Pass stored ``factors (theta, beta)`` or ``lda_result (weights, theta)`` to skip that stage. With an
    evaluation share, the topics are fitted on the other documents only.
    """
    num_terms = vocab.agg(F.count(F.lit(1)).alias("n")).first().n
    k = cfg.num_topics
    if factors is None:
        fit = PF.fit(counts, num_terms, k, cfg.seeds, cfg.pf_steps)
        factors = fit.theta, fit.beta
    train = held = counts
    if cfg.eval_share:
        split = topics.eval_split(counts, cfg.eval_share, cfg.eval_seed)
        train, held = (split.filter(c).drop("is_eval") for c in ("not is_eval", "is_eval"))
    if lda_result is None:
        weights, theta = _fit_lda(train, num_terms, cfg)
        lda_result = stage(weights, "topic_weights"), stage(theta, "doc_topics")
    weights, theta = lda_result
    eval_theta = None
    if cfg.eval_share:
        alpha = [cfg.lda_alpha / k] * k
        eval_theta = stage(VB.fold_in(held, VB.by_term(weights), alpha, cfg.eval_iterations, cfg.eval_tolerance), "eval_topics")
    top = stage(topics.top_terms(weights, cfg.eval_words), "top_terms")
    n_docs = held.agg(F.count_distinct("doc_id").alias("n")).scalar()
    metrics = topics.topic_metrics(incidence(held), top, n_docs, k, cfg.eval_words)
    means = stage(scaling.scale_factors(*factors), "means")
    beta_scaled = scaling.scaled_beta(weights, means, F.lit(num_terms))
    return TopicInit(*factors, weights, theta, topics.topic_terms(top, vocab), metrics, beta_scaled,
                     scaling.scaled_theta(theta, means),
                     scaling.topic_word(beta_scaled, F.lit(num_terms), cfg.drop_last_term), eval_theta)


def _print(df: DataFrame) -> list:
    """Rows and a sum of row hashes: the same for the same rows in any order."""
    got = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return [got.n, str(got.s)]


def init_topics_stored(counts: DataFrame, vocab: DataFrame, path: str, cfg: TopicConfig = TopicConfig()) -> tuple[TopicInit, list[str]]:
    """:func:`init_topics` with its two long stages kept below ``path``, and the names of the stages that ran.

    A stage's manifest tells the settings and inputs it was made from. A stage whose manifest agrees is read,
    any other runs and replaces it; changing the topics' prior leaves the factorisation as it is. Missing
    columns and empty inputs fail before any stage begins.
    """
    require_columns(counts, ("doc_id", "term_id", "cnt"))
    require_columns(vocab, ("term_id", "term"))
    inputs = {"counts": _print(counts.select("doc_id", "term_id", "cnt")), "vocab": _print(vocab.select("term_id", "term"))}
    if not inputs["counts"][0] or not inputs["vocab"][0]:
        raise ValueError("topics need counts and a vocabulary with rows")
    spark, ran = counts.sparkSession, []
    every = {k: list(v) if isinstance(v, (tuple, list)) else v for k, v in asdict(cfg).items()}

    def stored(name: str, settings: tuple[str, ...], tables: tuple[str, str], run) -> tuple[DataFrame, DataFrame]:
        versions, about = Versions(spark, f"{path}/{name}"), {"settings": {k: every[k] for k in settings}, "inputs": inputs}
        found = versions.latest()
        if found is None or found.about != about:
            found = versions.publish(dict(zip(tables, run())), about)
            ran.append(name)
        return tuple(found.read(spark, t) for t in tables)

    def factorise():
        fit = PF.fit(counts, inputs["vocab"][0], cfg.num_topics, cfg.seeds, cfg.pf_steps)
        return fit.theta, fit.beta

    def topics_of():
        train = topics.eval_split(counts, cfg.eval_share, cfg.eval_seed).filter("not is_eval").drop("is_eval") if cfg.eval_share else counts
        return _fit_lda(train, inputs["vocab"][0], cfg)

    factors = stored("factors", ("num_topics", "seeds", "pf_steps"), ("theta", "beta"), factorise)
    fitted = stored("topics", ("num_topics", "lda_iterations", "lda_alpha", "lda_beta", "lda_seed", "optimizer", "eval_share", "eval_seed"), ("weights", "theta"), topics_of)
    return init_topics(counts, vocab, cfg, factors, fitted), ran


def init_topics_by_group(counts: DataFrame, vocab: DataFrame, groups: Sequence[str], cfg: TopicConfig = TopicConfig(),
                         group: str = "chamber") -> dict[str, TopicInit]:
    """Initialise the topics of each group (their vocabularies, and so their factors, are apart).

    Groups without a vocabulary are left out.
    """
    part = lambda df, g: df.filter(F.col(group) == g).drop(group)
    return {g: init_topics(part(counts, g), part(vocab, g), cfg) for g in groups if not part(vocab, g).isEmpty()}
