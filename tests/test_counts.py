"""Vocabulary, counts and de-overlap against small sequential models."""

import random
import re
from collections import Counter

import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as T
from rostrum.operators import align, counts as C, ids, procedural as P, speeches as S, vocabulary as V
from rostrum.plans.stage import stage


def grams(tokens, n_max, sep=" "):
    return [sep.join(tokens[i:i + n]) for n in range(1, n_max + 1) for i in range(len(tokens) - n + 1)]


def walk(counts, vocab):
    """n-grams present at the start, visited in vocabulary order, each taken off its distinct sub-terms."""
    cur = dict(counts)
    for g in [v for v in vocab if " " in v and counts.get(v, 0) > 0]:
        tok = g.split(" ")
        for subs in [set(tok)] + ([{" ".join(tok[i:i + 2]) for i in range(len(tok) - 1)}] if len(tok) > 2 else []):
            now = cur.get(g, 0)
            for s in subs:
                if s in vocab:
                    cur[s] = cur.get(s, 0) - now
    return {t: c for t, c in cur.items() if c > 0}


@pytest.mark.parametrize("n_max", [2, 3, 4])
def test_deoverlap_equals_sequential_walk(spark, n_max):
    rng = random.Random(n_max)
    docs = [[rng.choice("aa bb cc dd".split()) for _ in range(rng.randint(1, 14))] for _ in range(150)]
    everything = sorted({g for d in docs for g in grams(d, n_max)})
    vocab = [g for g in everything if rng.random() < 0.5]
    v = spark.createDataFrame([(i, t, len(t.split(" "))) for i, t in enumerate(vocab)], "term_id bigint, term string, n int")
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id bigint, text string")
    counts = C.document_term_counts(df, v, n_max)
    packed = stage(C.pack_overlaps(C.overlap_map(v)), "overlaps")
    got = {}
    for r in C.deoverlap(counts, packed).join(v.select("term_id", "term"), "term_id").collect():
        got.setdefault(r.doc_id, {})[r.term] = r.cnt
    known = set(vocab)
    for i, d in enumerate(docs):
        start = Counter(g for g in grams(d, n_max) if g in known)
        assert got.get(i, {}) == walk(start, vocab), (i, d)


def corpus(spark, n=200, seed=1):
    rng = random.Random(seed)
    words = [w + x for w in "al be ga de ep ze et th io ka".split() for x in ("", "x", "y")]
    rows = [(i, f"s{rng.randint(0, 6)}", " ".join(rng.choice(words[: rng.randint(3, 30)]) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, speaker string, text string")


def test_level_wise_statistics_equal_one_pass(spark):
    d = corpus(spark)
    pick = lambda st: {(r.term, r.df, r.n_authors) for r in V.author_spread(V.df_band(st, V.doc_total(d), 0.03, 0.6), 3).collect()}
    one = pick(V.build_stats(d, ["al", "be"], 3, T.FIRST_PASS_PATTERN, 0.03, 3))
    levels = pick(V.build_stats(d, ["al", "be"], 3, T.FIRST_PASS_PATTERN, 0.03, 3, stage=stage))
    assert one == levels and any(" " in t for t, _, _ in one) and sum(t.count(" ") == 2 for t, _, _ in one)


def test_term_statistics_by_group_take_one_shuffle(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["h", "s", None]), rng.choice(["x", "y", None, ""]), rng.choice([None, "", " ".join(rng.choice(["al", "be", "al be", "é" * 9, "longer" * 5])
             for _ in range(rng.randint(1, 30)))])) for _ in range(300)]
    rows += rows[:40]
    d = spark.createDataFrame(rows, "chamber string, speaker string, text string")
    # Tokens may hold the blank that joins n-grams: one term then comes from several lengths, and counts once a row.
    pattern = "al be|[a-zé]+"
    tokens = [(c, s, re.findall(pattern, t or "")) for c, s, t in rows]
    by_author, df, authors = Counter(), Counter(), {}
    for c, s, tok in tokens:
        by_author.update((c, s, g) for g in grams(tok, 3))
        for g in set(grams(tok, 3)):
            df[c, g] += 1
            authors.setdefault((c, g), set()).add(s)
    g = V.first_pass(d, (), 3, pattern)
    # The n-grams as they are, without the tokens beside them, count the same.
    assert sorted(V.term_stats(g.drop(V.FIRST_TOKENS), ["chamber"]).collect(), key=str) == sorted(V.term_stats(g, ["chamber"]).collect(), key=str)
    stats, counts = V.term_stats(g, ["chamber"]), V.author_term_counts(g, ["chamber"])
    got = [tuple(r) for r in stats.collect()]
    assert sorted(got, key=str) == sorted(((*k, n, len(authors[k])) for k, n in df.items()), key=str)
    assert sorted((tuple(r) for r in counts.collect()), key=str) == sorted(((*k, n) for k, n in by_author.items()), key=str)
    for out in (stats, counts):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and "Aggregate" not in plan
    assert V.term_stats(g.filter("text = 'none'")).count() == 0


def test_only_known_ngrams_leave_the_task(spark, monkeypatch):
    rows = [(1, "aa bb cc aa bb"), (1, "aa bb"), (None, "cc cc"), (3, None), (4, ""), (5, "é1 aa")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    v = spark.createDataFrame([(0, "aa bb", 2), (1, "bb cc aa", 3), (2, "cc", 1), (3, "é1", 1)], "term_id bigint, term string, n int")
    want = [(None, 2, 1, 2), (1, 0, 2, 3), (1, 1, 3, 1), (1, 2, 1, 1), (5, 3, 1, 1)]
    order = lambda x: str(x)
    tokens = V.with_tokens(d, T.SECOND_PASS_PATTERN)
    left = V.known_grams(tokens, ["doc_id"], (1, 3), v)
    assert sorted((r.doc_id, r.term, r.cnt) for r in left.filter("doc_id = 1").collect()) == [(1, "aa bb", 1), (1, "aa bb", 2), (1, "bb cc aa", 1), (1, "cc", 1)]
    pairs = spark.createDataFrame([("aa",), ("bb",)], "term string")
    assert {r.term for r in V.known_grams(tokens, ["doc_id"], (2, 2), pairs, parts=True).collect()} == {"aa bb"}
    assert sorted(map(tuple, C.document_term_counts(d, v).collect()), key=order) == sorted(want, key=order)
    monkeypatch.setattr(V, "MAX_KNOWN", 0)
    assert V.known_grams(tokens, ["doc_id"], (1, 3), v).count() > left.count()
    assert sorted(map(tuple, C.document_term_counts(d, v).collect()), key=order) == sorted(want, key=order)


def test_pieces_and_batches_do_not_change_counts():
    import pyarrow as pa

    from rostrum.functions import grams as G

    rows = [["a", "b", "a", None], None, [], ["a", "ab" * 40], ["b"] * 7]
    whole = pa.RecordBatch.from_arrays([pa.array(["x", "x", None, "y", "x"]), pa.array(rows, pa.list_(pa.string()))], names=["speaker", "grams"])
    want = {("x", "a"): 2, ("x", "b"): 8, ("y", "a"): 1, ("y", "ab" * 40): 1}
    for cut in (1, 3, 100):
        G.PIECE_GRAMS, before = cut, G.PIECE_GRAMS
        try:
            placed = [b for at in range(0, 5, 2) for b in G.combine([whole.slice(at, 2)], ["speaker"], False, 3)]
        finally:
            G.PIECE_GRAMS = before
        got = {}
        for part in range(3):
            mine = [b.filter(pa.compute.equal(b["part"], part)) for b in placed]
            got |= {(r["speaker"], r["term"]): r["cnt"] for b in G.by_author(mine, ["speaker"]) for r in b.to_pylist()}
        assert got == want


def test_results_do_not_depend_on_partitions(spark):
    d = corpus(spark)
    run = lambda df: sorted((r.term, r.df, r.n_authors) for r in V.term_stats(V.first_pass(df, ["al"])).collect())
    assert run(d.repartition(1)) == run(d.repartition(13, "speaker"))


def test_stopwords_go_before_ngrams(spark):
    d = spark.createDataFrame([(1, "s", "House of the People of Spain")], "doc_id bigint, speaker string, text string")
    rows = V.explode_grams(V.first_pass(d, ["of", "the"], 2), ["doc_id"])
    assert sorted(r.term for r in rows.collect()) == ["house", "house people", "people", "people spain", "spain"]
    words = spark.createDataFrame([("of",), ("the",)], "word string")
    long = V.ngrams_from_rows(V.remove_words(d, words), 2)
    assert sorted(r.term for r in long.collect()) == sorted(r.term for r in rows.collect())


def test_stop_list_per_group(spark):
    d = spark.createDataFrame([(1, "house", "a b"), (2, "senate", "a b")], "doc_id bigint, chamber string, text string")
    got = {r.chamber: r.tokens for r in V.with_tokens(d, "[a-z]", {"house": ["a"], "senate": ["b"]}).collect()}
    assert got == {"house": ["b"], "senate": ["a"]}


def test_df_band_bounds_are_inclusive(spark):
    st = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 15, 1), ("d", 16, 1)], "term string, df bigint, n_authors bigint")
    assert [r.term for r in V.df_band(st, F.lit(20), 0.1, 0.75).collect()] == ["b", "c"]
    with pytest.raises(ValueError):
        V.df_band(st, F.lit(20), 0.5, 0.1)


def test_vocabulary_checks(spark):
    w = lambda *x: spark.createDataFrame([(v,) for v in x], "word string")
    V.check_vocabulary(w("a", "b"))
    V.check_vocabulary(w("a", "a"), allow_duplicates=True)
    with pytest.raises(ValueError, match="1 vocabulary entries repeat"):
        V.check_vocabulary(w("a", "a"))
    with pytest.raises(ValueError, match="no entries"):
        V.check_vocabulary(w())


def test_dense_ids_follow_code_points(spark):
    names = ["b", "a", "ab", "", "é", "z", "\U0001d400", "￿", "abcd", "abce", "A"]
    df = spark.createDataFrame([(g, n) for g in "xy" for n in names], "g string, speaker string")
    got = {(r.g, r.speaker): r.author_id for r in ids.author_dimension(df, ["g"]).collect()}
    for g in "xy":
        assert [got[g, n] for n in sorted(names)] == list(range(len(names)))
    nums = spark.createDataFrame([(v,) for v in (-5, 3, 2_500_000, 999_999, 1_000_000)], "doc_id bigint")
    assert [r.row_id for r in ids.export_ids(nums).orderBy("doc_id").collect()] == [0, 1, 2, 3, 4]
    hashed = spark.range(500).select(F.xxhash64("id").alias("doc_id")).unionByName(
        spark.createDataFrame([(-2**63,), (2**63 - 1,), (2**63 - 2,)], "doc_id bigint"))
    got = ids.export_ids(hashed).orderBy("doc_id").collect()
    assert [r.row_id for r in got] == list(range(503))


@pytest.mark.parametrize("size, kept", [(24, False), (25, True), (26, True)])
def test_null_speaker_is_one_group(spark, size, kept):
    df = spark.createDataFrame([(None, i) for i in range(size)] + [("a", i) for i in range(30)], "speaker string, i int")
    out = S.active_speakers(df, 25)
    assert out.filter("speaker IS NULL").count() == (size if kept else 0) and out.filter("speaker = 'a'").count() == 30


def test_candidates_by_length_and_words(spark):
    rows = ["aaaaa bbbb cccc", "aaaaa bbbb ccccc", "aaaaaaaaa bbbbbbbbb", "x" * 395 + " a b", "x" * 396 + " a b", "...!!! a,b", "w " * 300]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    assert [r.doc_id for r in P.candidates(df).orderBy("doc_id").collect()] == [1, 3, 4, 6]
    assert [r.doc_id for r in P.short_candidates(df).orderBy("doc_id").collect()] == [1, 3]


def test_score_counts_a_term_once_and_is_strict(spark):
    df = spark.createDataFrame([(1, "I yield yield the floor"), (2, "nothing matches in here"), (3, "the floor is yours now")], "doc_id bigint, text string")
    model = spark.createDataFrame([("yield", 1.0), ("the_floor", 0.5)], "term string, weight double")
    score = lambda bias: {r.doc_id: r.score for r in P.score(P.short_candidates(df), model, F.lit(bias)).collect()}
    assert score(-0.5) == {1: 1.0, 2: -0.5, 3: 0.0}
    s = stage(P.score(P.short_candidates(df), model, F.lit(-0.5)), "s")
    assert [r.doc_id for r in P.procedural_docs(s).collect()] == [1]
    assert sorted(r.term for r in P.procedural_stopwords(s).collect()) == ["the_floor", "yield"]
    assert sorted(r.doc_id for r in P.without_procedural(df, s).collect()) == [2, 3]
    none = stage(P.score(P.short_candidates(df), model, F.lit(-9.0)), "none")
    assert P.procedural_stopwords(none).count() == 0


def test_ordered_subset(spark):
    lines = lambda *t: spark.createDataFrame(list(enumerate(t)), "pos bigint, text string")
    full = lines("a", "b", "a", "c", "b")
    got = align.ordered_subset(full, lines("a", "a", "c")).orderBy("pos").collect()
    assert [(r.pos, r.text) for r in got] == [(0, "a"), (2, "a"), (3, "c")]
    for wrong in (("a", "c", "a"), ("a", "a", "x"), ("a", "a", "c", "c")):
        with pytest.raises(Exception, match="ordered subset"):
            align.ordered_subset(full, lines(*wrong)).collect()


def greedy(full, kept):
    at, out = 0, []
    for x in kept:
        while at < len(full) and full[at] != x:
            at += 1
        if at == len(full):
            return None
        out.append(at)
        at += 1
    return out


@pytest.mark.parametrize("block", [3, 20_000])
def test_greedy_subset(spark, block):
    import random
    rng = random.Random(block)
    for size, words in ((300, "aaaabbcd"), (60, "a")) if block == 3 else ((300, "abcdefghij"),):
        full = [rng.choice(words) if rng.random() < 0.85 else f"only {i}" for i in range(size)] + [None, "x", None, "y", "x"]
        kept = [x for x in full if rng.random() < 0.6]
        lines = lambda rows, step: spark.createDataFrame([(step * i, x) for i, x in enumerate(rows)], "pos bigint, text string").repartition(4)  # noqa: B023, E731
        rows = align.ordered_subset_greedy(lines(full, 3), lines(kept, 7), block).orderBy("rank").collect()
        assert [(r.rank, r.pos // 3, r.text) for r in rows] == [(i, p, full[p]) for i, p in enumerate(greedy(full, kept))]
    wrong = [*kept[5:], *kept[:5]]
    assert greedy(full, wrong) is None
    for bad in (wrong, [*kept, "unseen"]):
        with pytest.raises(Exception, match="ordered subset"):
            align.ordered_subset_greedy(lines(full, 1), lines(bad, 1), block).collect()


def test_greedy_subset_of_a_hot_text(spark):
    lines = lambda rows: spark.createDataFrame(list(enumerate(rows)), "pos bigint, text string")
    got = lambda full, kept, block: [r.pos for r in align.ordered_subset_greedy(lines(full), lines(kept), block).orderBy("rank").collect()]
    assert got("ABA", "BA", 1) == [1, 2] and got("ABAB", "AB", 20) == [0, 1] and got("AB", "", 5) == []
    assert got("XAAAY", "XAY", 2) == [0, 1, 4] and got("AAXAA", "AXA", 1) == [0, 2, 3]


def test_wide_blanks_do_not_count_towards_the_length(spark):
    pad = "\x0c\x85\u2003\u00a0" * 100
    docs = spark.createDataFrame([(1, f"one{pad}two three four five six"), (2, f"I{pad} yield{pad} the floor to all"), (3, "x" * 400 + " a b")], "doc_id int, text string")
    assert {r.doc_id for r in P.short_candidates(docs, 100).collect()} == {1, 2}


def test_ids_of_one_prefix(spark):
    keys = sorted(f"same prefix {i}" for i in range(500))
    df = spark.createDataFrame([("a", k) for k in keys] + [("b", "zz"), ("b", "same prefix 3")], "g string, speaker string").repartition(4)
    for rows in (10, 1_000_000):
        got = sorted((r.g, r.i, r.speaker) for r in ids.dense_ids(df, "speaker", ids.string_bucket("speaker"), "i", ["g"], rows).collect())
        assert got == [("a", i, k) for i, k in enumerate(keys)] + [("b", 0, "same prefix 3"), ("b", 1, "zz")]


def test_ids_of_keys_with_an_outlier(spark):
    keys = [*range(0, 3000, 3), 10**17]
    df = spark.createDataFrame([(g, k) for g in ("a", "b") for k in keys], "g string, doc_id long").repartition(5)
    got = sorted((r.g, r.doc_id, r.row_id) for r in ids.export_ids(df, ["g"]).collect())
    assert got == [(g, k, i) for g in ("a", "b") for i, k in enumerate(keys)]
    assert ids.export_ids(df.limit(0)).count() == 0
