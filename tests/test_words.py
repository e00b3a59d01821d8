"""Words, statistics and counts that are worked out inside the batches."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.functions import grams as G
from rostrum.functions import text as T
from rostrum.operators import counts as C
from rostrum.operators import vocabulary as V
from rostrum.plans.stage import stage

ODD = ["", None, "a", "ab a_b  É cd", "xé", "日本 日 \U0001d4b3\U0001d4b4 z", "no-break end", "١٢ tail"]


def _table(spark, pattern):
    cls, least = T.word_class(pattern)
    return G.table_of(T.class_bits(spark, cls)), least


@pytest.mark.parametrize("pattern", [T.FIRST_PASS_PATTERN, T.SECOND_PASS_PATTERN])
def test_words_are_those_of_the_engine(spark, pattern):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, text string")
    want = [(r.i, t) for r in df.select("i", T.token_array(F.col("text"), pattern).alias("t")).orderBy("i").collect() for t in r.t or ()]
    tokens, rows = G.split_words(pa.array([x and x.lower() for x in ODD]), *_table(spark, pattern))
    assert list(zip(rows.tolist(), tokens.to_pylist())) == want
    tokens, rows = G.split_words(pa.array(["zz", *[x and x.lower() for x in ODD]]).slice(1), *_table(spark, pattern))
    assert list(zip(rows.tolist(), tokens.to_pylist())) == want


def test_only_plain_patterns_are_split_in_batches():
    assert T.word_class(r"[\p{L}\p{N}_]{2,}") == (r"[\p{L}\p{N}_]", 2)
    assert all(T.word_class(p) is None for p in (r"\w+", r"[a-z]", r"([a-z]+)", r"[^a]+", r"[a-z&&[b]]+", r"[a]{0,}", r"[a]+[b]+"))


def test_white_space_is_made_single_blanks(spark):
    rows = ["", " ", " a", "a  b", "a \tb", "a\t b\n", " a b ", "a b", "\x1c\x1f x 　"]
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    got = [r.x for r in df.select(T.normalize_ws(F.col("x")).alias("x")).collect()]
    assert got == [re.sub(f"^{T.WS}+|{T.WS}+$", "", re.sub(f"{T.WS}+", " ", x)) for x in rows]


def _docs(spark):
    rng = random.Random(5)
    words = ["aa", "bb", "cc", "dd", "ee", "ff"]
    rows = [(rng.choice(["house", "senate"]), rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice(["x", "y", "z"]), " ".join(rng.choices(words, k=rng.randint(0, 14))))
            for _ in range(60)]
    return spark.createDataFrame([*rows, ("house", 9, "x", None), ("senate", 9, "y", "")], "chamber string, doc_id long, speaker string, text string").repartition(3)


def _counts(spark, docs):
    stats = V.term_stats(V.first_pass(docs), ["chamber"]).filter("df > 3")
    return stage(V.select_vocabulary(stats, ["chamber"]), "vocab")


@pytest.mark.parametrize("held", [3, G.HELD_COUNTS])
def test_counts_are_those_of_the_joins(spark, monkeypatch, held):
    """Documents may repeat or have no id."""
    docs, g = _docs(spark), ["chamber"]
    vocab = _counts(spark, docs)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    packed = stage(C.pack_overlaps(C.overlap_map(vocab, g), g), "overlaps")
    monkeypatch.setattr(C, "MAX_HELD", 0)
    by_joins = C.document_term_counts(docs, vocab, 3, g)
    want, less = rows(by_joins), rows(C.deoverlap(by_joins, packed, g, placed=True))
    monkeypatch.undo()
    monkeypatch.setattr(G, "HELD_COUNTS", held)
    found = C.document_term_counts(docs, vocab, 3, g)
    assert found.schema == by_joins.schema or found.dtypes == by_joins.dtypes
    assert len(want) > 50 and rows(found) == want
    assert rows(C.deoverlap(found, packed, g, placed=True)) == less
    assert rows(C.deoverlap(found, packed, g)) == less
    assert not {"Generate", "SortMergeJoin", "BroadcastHashJoin"} & set(re.findall(r"\w+", C.deoverlap(found, packed, g, placed=True)._jdf.queryExecution().executedPlan().toString()))


def test_merged_counts_stay_bounded(spark, monkeypatch):
    """Batches of one document are summed before they pile up."""
    monkeypatch.setattr(G, "HELD_COUNTS", 10)
    vocab = G.Vocabulary(pa.table({"term": ["a", "b"], "term_id": [5, 6], "n": [1, 1]}), [])
    seen, before = [], G._merged
    monkeypatch.setattr(G, "_merged", lambda batches, keys, width: (seen.append(sum(len(b.column(1).flatten()) for b in batches)), before(batches, keys, width))[1])
    batch = pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([[0, 1]], pa.list_(pa.int32())), pa.array([[1, 2]], pa.list_(pa.int32()))], names=["doc_id", "terms", "counts"])
    out = pa.Table.from_batches(list(G.merge_counts([batch] * 50, ["doc_id"], vocab)))
    assert out.to_pylist() == [{"doc_id": None, "term_id": 5, "n": 1, "cnt": 50}, {"doc_id": None, "term_id": 6, "n": 1, "cnt": 100}]
    assert max(seen) <= 24


def test_statistics_by_level_are_those_of_one_pass(spark):
    docs, g = _docs(spark), ["chamber"]
    words = {"house": ["cc"], "senate": ["aa", "ee"]}
    total = V.doc_total(docs, g)
    keep = lambda s: {tuple(r) for r in V.author_spread(V.df_band(s, total, 0.1, 0.9), 2).select("chamber", "term", "df", "n_authors").collect()}
    for stop in (words, ["bb"], ()):
        whole = V.build_stats(docs, stop, 3, T.FIRST_PASS_PATTERN, 0.1, 2, g)
        levels = V.build_stats(docs, stop, 3, T.FIRST_PASS_PATTERN, 0.1, 2, g, stage)
        assert keep(levels) == keep(whole) and keep(whole)


def test_table_of_bits():
    bits = np.zeros(0x110000, bool)
    bits[[3, 70000]] = True
    assert (G.table_of(np.packbits(bits).tobytes()) == bits).all()
