"""Published table sets, fits that go on from a snapshot, and seeds that fail by themselves."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import factorization as PF
from rostrum.plans import sinks
from rostrum.plans.versions import Versions


def test_versions(spark, tmp_path):
    path = str(tmp_path / "set")
    assert Versions(spark, path).latest() is None
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    v = Versions(spark, path).publish({"a": a, "b": a.limit(0)}, {"run": 1})
    assert (v.number, v.about) == (0, {"run": 1}) and v.read(spark, "b").schema == a.schema and v.read(spark, "b").count() == 0
    with pytest.raises(Exception):
        Versions(spark, path).publish({"a": a.union(a), "b": a.select("i", F.raise_error(F.lit("lost")).alias("s"))})
    assert Versions(spark, path).latest().read(spark, "a").count() == 1  # the half-written set is not seen
    for n in (2, 3):
        Versions(spark, path, keep=1).publish({"a": a.union(a)}, {"run": n})
    last = Versions(spark, path).latest()
    assert last.about == {"run": 3} and last.read(spark, "a").count() == 2
    assert len([f for f in (tmp_path / "set").iterdir() if f.name.endswith(".json")]) == 1
    with pytest.raises(Exception):
        Versions(spark, path).publish({"a": a}, number=last.number)


@pytest.mark.parametrize("csv", [False, True])
def test_split_with_an_empty_side(spark, tmp_path, csv):
    path = str(tmp_path / "split")
    rows = spark.createDataFrame([(1, "House", 'a "quoted",\ntext'), (2, " senate ", "b"), (3, "Extensions", "c"), (4, None, "d")], "id int, `Legislative Body` string, text string")
    first = sinks.publish_split(rows, path, csv)
    assert [(r.id, r.text) for r in first.read(spark, "house").collect()] == [(1, 'a "quoted",\ntext')]
    second = sinks.publish_split(rows.filter("id = 2"), path, csv)
    assert second.read(spark, "house").count() == 0 and second.read(spark, "house").columns == rows.columns
    assert [r.id for r in Versions(spark, path).latest().read(spark, "senate").collect()] == [2]
    if csv:  # a file of a header only
        text = "".join(f.read_text() for f in (tmp_path / "split").glob(f"{second.folder.rpartition('/')[2]}/house/*.csv"))
        assert text.strip() == "id,Legislative Body,text"


def test_vocabulary_lines(spark, tmp_path):
    vocab = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(["a", 'b"c', "d\\e", "straße", " x", "z"]))], "term_id bigint, term string").repartition(3)
    sinks.write_vocab_json_parts(vocab, str(tmp_path / "v"))
    parts = sorted((tmp_path / "v").glob("part-*.txt"))
    assert json.loads("".join(p.read_text() for p in parts)) == {r.term: r.term_id for r in vocab.collect()}
    sinks.write_vocab_json_parts(vocab.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*.txt")))) == {}


@pytest.fixture(scope="module")
def counts(spark):
    m = np.random.RandomState(3).poisson(0.8, (14, 6))
    return spark.createDataFrame([(d, w, int(m[d, w])) for d in range(14) for w in range(6) if m[d, w]], "doc_id bigint, term_id bigint, cnt bigint")


class Killed(Exception):
    pass


def kill(at):
    def done(step):
        if step == at:
            raise Killed
    return done


def factors(fit):
    long = lambda df, key: {(r.seed, r[key]): (*r["shape"], *r["rate"], r.prior_rate) for r in df.collect()}
    return long(fit.theta, "doc_id"), long(fit.beta, "term_id"), {(r.seed, r.step): r.elbo for r in fit.bounds.collect()}


@pytest.mark.parametrize("limit", [PF.BROADCAST_LIMIT, 0])
def test_resume(spark, counts, tmp_path, limit):
    settings = {"num_topics": 2, "seeds": [1, 2], "steps": 7, "elbo_every": 2, "checkpoint_every": 3, "broadcast_limit": limit}
    whole = factors(PF.fit(counts, 6, **settings))
    store = {"store": str(tmp_path / "fit"), "store_every": 3}
    with pytest.raises(Killed):
        PF.fit(counts, 6, on_step=kill(5), **settings, **store)  # the last snapshot is of step 3
    steps = []
    resumed = factors(PF.fit(counts, 6, on_step=steps.append, **settings, **store))
    assert steps == [4, 5, 6]
    for a, b in zip(whole, resumed):
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-9) for k in a)
    steps.clear()
    assert factors(PF.fit(counts, 6, on_step=steps.append, **settings, **store))[2] == resumed[2] and steps == []
    with pytest.raises(ValueError, match="another fit"):
        PF.fit(counts.filter("doc_id > 0"), 6, **settings, **store)


def test_seeds_fail_by_themselves(spark, counts, tmp_path):
    store, done = str(tmp_path / "seeds"), []

    def stop(step):
        done.append(step)

    PF.fit(counts.filter("doc_id < 3"), 6, 2, [8], 1, store=store)  # seed 8 will find another fit's snapshots
    with pytest.raises(PF.SeedsFailed, match="seeds 8$") as e:
        PF.fit_seeds(counts, 6, 2, [7, 8, 9], 3, store=store, parallel=2, on_step=stop)
    assert list(e.value.failures) == [8] and sorted(e.value.fits) == [7, 9] and len(done) == 6
    alone = factors(PF.fit(counts, 6, 2, [9], 3))
    assert np.allclose(list(alone[1].values()), list(factors(e.value.fits[9])[1].values()))
    done.clear()
    again = PF.fit_seeds(counts, 6, 2, [7, 9, 10], 3, store=store, on_step=stop)
    assert sorted(again) == [7, 9, 10] and done == [0, 1, 2]  # only the new seed is fitted
