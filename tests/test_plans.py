"""Composite plans, writers and the streaming split."""

import dataclasses
import json
import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import speeches as S
from rostrum.operators import vocabulary as V
from rostrum.plans import sinks
from rostrum.plans.prepare import PrepareConfig, corpus_from_rows, prepare
from rostrum.plans.stage import stage
from rostrum.plans.topic_init import TopicConfig, init_topics
from rostrum.sources import tables, transcripts
from rostrum.streaming import split

CFG = PrepareConfig(min_speeches_per_speaker=5, min_df=0.02, max_df=0.9, min_authors_per_word=2, ngram_max=3)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    themes = [["tax", "budget", "spending", "deficit", "income"], ["health", "care", "hospital", "doctor", "nurse"]]
    docs = []
    for i in range(160):
        words = [rng.choice(themes[i % 2]) for _ in range(rng.randint(5, 40))]
        text = " ".join(words) if i % 8 else "Mr Speaker I yield the floor to the gentleman"
        docs.append({"header": {"year": 2024, "month": "May", "day": 3, "chamber": ["House", " SENATE "][(i // 2) % 2]},
                     "content": [{"kind": "speech", "speaker": "x", "speaker_bioguide": None if i % 7 == 0 else f"S{i % 5}", "text": text}]})
    raw = spark.createDataFrame([(f"f{i}", json.dumps(d)) for i, d in enumerate(docs)], "file_path string, raw string")
    rows = corpus_from_rows(transcripts.with_doc_id(transcripts.speech_rows(raw)))
    return stage(rows.withColumn("speaker", F.concat("speaker", F.lit(" "))), "corpus")


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame([("yield_the_floor", 2.0), ("speaker", 1.0), ("tax", -0.1)], "term string, weight double")


@pytest.fixture(scope="module")
def prepared(corpus, model):
    return prepare(corpus, ["the", "to", "i"], model, F.lit(-0.5), CFG)


def test_boilerplate_is_removed(prepared):
    assert prepared.procedural.count() == 20
    assert {r.term for r in prepared.stopwords.collect()} == {"speaker", "yield_the_floor"}
    first, final = prepared.first, prepared.final
    assert first.docs.count() == 160 and final.docs.count() == 140
    assert first.vocab.filter("term = 'speaker'").count() == 1 and final.vocab.filter("term = 'speaker'").count() == 0
    assert final.docs.select("chamber").distinct().count() == 2
    # The first pass trims speaker labels, the second takes them as they are.
    assert {r.speaker for r in first.authors.collect()} == {f"S{i}" for i in range(5)} | {"UNKNOWN_SPEAKER"}
    assert {r.speaker for r in final.authors.collect()} == {f"S{i} " for i in range(5)} | {"UNKNOWN_SPEAKER"}


@pytest.mark.parametrize("change", [{"level_wise": False}, {"stage_corpus": False}])
def test_settings_do_not_change_results(corpus, model, prepared, change):
    other = prepare(corpus.repartition(5), ["the", "to", "i"], model, F.lit(-0.5), dataclasses.replace(CFG, **change))
    for part in ("first", "final"):
        for name in ("counts", "vocab", "authors"):
            a, b = getattr(getattr(prepared, part), name), getattr(getattr(other, part), name)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_written_corpus(spark, prepared, tmp_path):
    sinks.write_corpus(prepared.final, str(tmp_path))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    assert dict(read("counts").dtypes)["cnt"] == "float"
    rows = read("author_indices").filter("chamber = 'house'").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(len(rows))) and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert read("documents").count() == 140 and read("vocabulary").count() == prepared.final.vocab.count()
    assert read("author_map").count() == prepared.final.authors.count()
    house = prepared.final.vocab.filter("chamber = 'house'")
    sinks.write_vocab_json(house, str(tmp_path / "json"))
    text = "".join(r.value for r in spark.read.text(str(tmp_path / "json")).collect())
    assert json.loads(text) == {r.term: r.term_id for r in house.collect()}
    sinks.write_texts(prepared.stopwords.filter("chamber = 'house'"), str(tmp_path / "sw"), column="term", order=("share", "term"))
    assert spark.read.text(str(tmp_path / "sw")).count() == 2
    sinks.write_split(prepared.first.docs.select("chamber", "doc_id"), str(tmp_path / "split"), csv=True)
    assert sorted(p.name for p in (tmp_path / "split").glob("chamber=*")) == ["chamber=house", "chamber=senate"]


def test_topic_init_and_skips(spark, prepared, tmp_path):
    house = lambda df: df.filter("chamber = 'house'").drop("chamber")
    counts, vocab = house(prepared.final.counts), house(prepared.final.vocab)
    cfg = TopicConfig(num_topics=2, seeds=(1, 2), pf_steps=6, lda_iterations=15, eval_words=5)
    out = init_topics(counts, vocab, cfg)
    m = out.metrics.first()
    assert m.npmi_mean is not None and 0 < m.tu_mean <= 1 and m.entire_overlaps in (0, 1)
    assert out.topic_word.count() == 2 * (vocab.count() - 1)
    sinks.write_factors(out.pf_theta, out.pf_beta, 2, str(tmp_path / "pf"))
    sinks.write_lda(out.weights, out.theta, str(tmp_path / "lda"))
    sinks.write_metrics(out.metrics, str(tmp_path / "metrics"))
    sinks.write_results(out.metrics.withColumn("seed", F.lit(1)), str(tmp_path / "results"))
    sinks.write_scaled(out.beta_scaled, out.theta_scaled, out.topic_word, str(tmp_path / "scaled"))
    assert set(json.loads(spark.read.text(str(tmp_path / "metrics")).first().value)) == {"npmi_mean", "tu_mean", "to", "entire_overlaps"}
    stored = lambda p: spark.read.parquet(str(tmp_path / p))
    again = init_topics(counts, vocab, cfg, tables.read_factors(spark, str(tmp_path / "pf"), 2, [1, 2]), (stored("lda/beta"), stored("lda/train_theta")))
    a = {(r.topic_id, r.term_id): r.weight for r in out.beta_scaled.collect()}
    b = {(r.topic_id, r.term_id): r.weight for r in again.beta_scaled.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_streaming_split_equals_batch(spark, tmp_path, fmt):
    cols = "Speaker_Bioguide_ID string, Speaker_Name string, Text string, Date string, `Legislative Body` string"
    rows = [(f"S{i}", "n", f'line "{i}",\nnext', "2024-01-01", ["House", " senate", "Extensions", None][i % 4]) for i in range(40)]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write = lambda part: (sinks.write_csv if fmt == "csv" else lambda d, p: d.write.mode("overwrite").parquet(p))(
        spark.createDataFrame(part, cols).coalesce(1), f"{src}/{part[0][0]}")
    schema = spark.createDataFrame([], cols).schema
    for chunk in (rows[:15], rows[15:]):
        write(chunk)
        stream = split.speech_stream(spark, f"{src}/*", schema, fmt, max_files=1)
        for q in (split.start_split(stream, out, str(tmp_path / "cp1"), fmt=fmt), split.start_totals(stream, str(tmp_path / "tot"), str(tmp_path / "cp2"))):
            q.awaitTermination()
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"') if fmt == "csv" else spark.read
    got = reader.format(fmt).load(out).select("chamber", "Speaker_Bioguide_ID", "Text")
    want = S.split_chamber(spark.createDataFrame(rows, cols)).select("chamber", "Speaker_Bioguide_ID", "Text")
    assert got.count() == 20 and got.exceptAll(want).count() == 0
    totals = {r.chamber: r.rows for r in spark.read.parquet(str(tmp_path / "tot")).collect()}
    assert totals == {"house": 10, "senate": 10, "other": 20}
    with pytest.raises(ValueError, match="the table lacks"):
        split.speech_stream(spark, src, schema.__class__(schema.fields[:2]), fmt)


def test_dominant_key_still_gives_whole_results(spark):
    """A third of the rows under one speaker and one text: every row is still counted."""
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 50}", "same words again" if i % 3 == 0 else f"word{i % 90} again") for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id bigint, speaker string, text string")
    st = {r.term: (r.df, r.n_authors) for r in V.term_stats(V.first_pass(d, [], 2)).collect()}
    assert st["same words"] == (1000, 1) and st["again"] == (3000, 51)
    assert S.active_speakers(d, 100).count() == 1000


@pytest.mark.parametrize("optimizer", ["gibbs", "online"])
def test_held_out_share(spark, optimizer):
    rows = [(d, (d % 2) * 5 + t, 1 + (d + t) % 3) for d in range(60) for t in range(5)]
    counts = spark.createDataFrame(rows, "doc_id bigint, term_id bigint, cnt bigint")
    vocab = spark.createDataFrame([(t, f"t{t}", 1) for t in range(10)], "term_id bigint, term string, n int")
    cfg = TopicConfig(num_topics=2, seeds=(1,), pf_steps=2, lda_iterations=12, lda_alpha=1.0, eval_words=4, optimizer=optimizer, eval_share=0.4)
    out = init_topics(counts, vocab, cfg)
    train, held = {r.doc_id for r in out.theta.collect()}, {r.doc_id: r.theta for r in out.eval_theta.collect()}
    assert 5 < len(held) < 55 and train | set(held) == set(range(60)) and not train & set(held)
    assert out.weights.count() == 20 and out.topic_word.count() == 18
    if optimizer == "gibbs":  # the two vocabularies part, and so do the documents never seen
        side = {d: t[0] > t[1] for d, t in held.items()}
        assert len({(d % 2, s) for d, s in side.items()}) == 2
    with pytest.raises(ValueError):
        init_topics(counts, vocab, TopicConfig(num_topics=2, seeds=(1,), pf_steps=1, optimizer="none"))


def test_stored_stages(spark, tmp_path):
    from dataclasses import replace

    from rostrum.plans.topic_init import init_topics_stored

    rows = [(d, (d % 2) * 3 + t, 1 + (d + t) % 3) for d in range(20) for t in range(3)]
    counts = spark.createDataFrame(rows, "doc_id bigint, term_id bigint, cnt bigint")
    vocab = spark.createDataFrame([(t, f"t{t}", 1) for t in range(6)], "term_id bigint, term string, n int")
    cfg, path = TopicConfig(num_topics=2, seeds=(1, 2), pf_steps=2, lda_iterations=3, eval_words=3, optimizer="gibbs"), str(tmp_path / "stages")
    out, ran = init_topics_stored(counts, vocab, path, cfg)
    assert ran == ["factors", "topics"]
    again, ran = init_topics_stored(counts.repartition(3), vocab, path, replace(cfg, eval_words=2))
    assert ran == [] and sorted(map(str, again.beta_scaled.collect())) == sorted(map(str, out.beta_scaled.collect()))
    assert init_topics_stored(counts, vocab, path, replace(cfg, lda_beta=0.1))[1] == ["topics"]
    assert init_topics_stored(counts.filter("doc_id > 0"), vocab, path, cfg)[1] == ["factors", "topics"]
    with pytest.raises(ValueError, match="lacks: cnt"):
        init_topics_stored(counts.drop("cnt"), vocab, path, cfg)
    with pytest.raises(ValueError, match="rows"):
        init_topics_stored(counts, vocab.limit(0), path, cfg)
