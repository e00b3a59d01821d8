"""One document per group where ids repeat or are missing, helper names that clash, and the pipeline's stages on odd tables."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rostrum.llm import chat, decontaminate, mixing, simhash, toxicity
from tests.llm.test_edges import LONG, ROWS, SYLLABLES, DOCS as SCHEMA

A, B, C, D = (" ".join(f"{w}{i}" for i in range(30)) for w in ("alpha", "beta", "gamma", "delta"))


def test_ids_in_two_groups(spark):
    rows = [(1, A, "x"), (2, A, "x"), (2, B, "x"), (3, C, "x"), (None, C, "y"), (None, D, "y"), (None, D, "z"), (4, B, "u"), (5, B, "u"), (5, B, "u"), (6, "", "e"), (7, None, "e")]
    names = "__root string, simhash_fp string, odd_id int, fp int"
    df = spark.createDataFrame([(*r, "mine", "mine", 1, 2) for r in rows], f"doc_id long, text string, note string, {names}").repartition(3)
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == {(1, A): 1, (2, B): 1, (3, C): 1, (None, D): 1, (6, ""): 1}


def test_every_group_keeps_one(spark):
    rng = random.Random(8)
    texts = [f"{x} {y}" for x in (A, B, C, D) for y in ("", "tail", "more words", "end")] + [None, ""]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts)) for _ in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fps = [simhash.fingerprint(t or "", 4, 42) for _, t in rows]
    root = {f: f for f in fps}
    while True:  # groups of equal or near fingerprints
        new = {f: min(root[g] for g in root if ((f ^ g) & (1 << 64) - 1).bit_count() <= 4) for f in root}
        if new == root:
            break
        root = new
    least = {}
    for (d, _), f in zip(rows, fps):
        least[root[f]] = min((x for x in (least.get(root[f]), d) if x is not None), default=None)
    got = [(r.doc_id, root[simhash.fingerprint(r.text or "", 4, 42)]) for r in simhash.representatives(df).collect()]
    assert sorted(got, key=repr) == sorted([(d, g) for g, d in least.items()], key=repr)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "s", 1.0)], "doc_id long, text string, source string, label double")
    mixed = mixing.take(df.withColumns({x: F.lit("mine") for x in ("mix_h", "mix_hr", "mix_plan_h", "mix_take", "n_takes", "n_rows")}))
    assert mixed.filter("mix_hr = 'mine' and n_takes = 'mine'").count() == mixed.count() == 1
    bench = spark.createDataFrame([(1, "a b"), (2, "c d")], "item_id long, text string")
    named = df.withColumns({x: F.lit("mine") for x in ("hits_key", "hits_key_r", "hits_of", "hits_found", "n", "i")})
    out = decontaminate.with_hits(named, bench, rules=decontaminate.Rules(block_chars=4))
    assert out.filter("hits_of = 'mine' and hits.n_hit = 4").count() == 1
    record = spark.createDataFrame([('{"prompt": "p", "response": "r"}',)], "raw string").select(F.parse_json("raw").alias("record"))
    said = chat.chat(record.withColumn("_out", F.lit("mine")).withColumn("_canonical", F.lit("m")).withColumn("canonical", F.lit("c")).withColumn("OUT", F.lit("o")))
    assert said.columns == ["_out", "_canonical", "canonical", "OUT", "layout", "formatted", "loss"] and said.first()["_out"] == "mine"
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, "bad words" if i % 2 else "fine words", 0.5, "x") for i in range(40)], "doc_id long, text string, label double, toxic string")
    assert len(toxicity.fit(docs, labels).hashes)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def odd(spark):
    rows = ROWS + [(20, prose(1, 300), "en", "s1", 1), (21, prose(1, 300), "en", "s2", 1), (21, prose(2, 300), "en", "s2", 1), (None, prose(3, 200), None, None, None),
                   (None, prose(3, 200), None, None, None), (22, prose(4, 30_000), "en", "s1", 2), (23, prose(5, 120), None, "s1", 2), (23, prose(5, 120), None, "s1", 2)]
    return spark.createDataFrame([(*r, "mine") for r in rows], f"{SCHEMA}, quality string").repartition(3)


def test_stages_on_odd_rows(spark, odd):
    sf, docs = "/root/testdata/sf0.001", odd
    counts = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert docs.columns == odd.columns and docs.filter("quality = 'mine'").count() == docs.count()
        counts.append(collections.Counter((r.doc_id, (r.text or "")[:40]) for r in docs.collect()))
    clean = {(d, prose(s, n)[:40]) for d, s, n in ((20, 1, 300), (21, 1, 300), (21, 2, 300), (None, 3, 200), (22, 4, 30_000), (23, 5, 120))}
    assert clean <= set(counts[0]) and (None, ROWS[3][1][:40]) not in counts[0] and not any(d in (3, 4, 5) for d, _ in counts[0])
    # copies go, the other text of id 21 and one of the rows without an id stay
    assert {k: n for k, n in counts[1].items() if k in clean} == {k: 1 for k in clean if k != (21, prose(1, 300)[:40])}
    assert counts[2] == counts[1] and set(counts[3]) <= set(counts[2])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert collections.Counter(r.doc_id for r in last) == collections.Counter(r.doc_id for r in docs.collect())
    assert len(LONG) > 100_000
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, odd.limit(0), sf).count() == 0
