"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import chat, decontaminate, fuzzylines, mixing, quality, simhash, sitetree, suffixdedup, tokens, toxicity
from rostrum.llm.queries import byte_bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ther and ing ion est re ly on ba co du fe gi ho ju ka lo mu ne pi qua ro su ti vo wa xy ze ment per con der ver ous".split()
LONG = " ".join(f"word{i % 7919} x{i % 104729}" for i in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s1", 1),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s1", 1),   # repeated row
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", None, None, None),  # copy
    (None, "no id at all, yet some words to keep in a sentence of its own", None, "s2", None),
    (3, None, "en", None, 0), (4, "", None, "s2", 0), (5, " \t\n\x0b\x0c\r \n", "en", "s1", 3),
    (6, "ÄÖÜ straße 東京 \U0001F600 it's <|endoftext|>  two  spaces\n\n\nend ", "de", "s3", 9),
    (7, LONG, "en", "s1", len(LONG)),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_quality(spark, docs, empty):
    out = quality.with_verdict(docs.withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(1)), "q")
    got = {(r.doc_id, r.text): r.q for r in out.collect()}
    assert len(out.collect()) == len(ROWS) and out.filter("kept = 'mine'").count() == len(ROWS)
    for key in ((3, None), (4, "")):
        q = got[key]
        assert (q.n_words, q.word_chars, q.n_bytes, q.ratio, q.base_failed, q.kept) == (0, 0, 0, None, True, False)
    assert got[(7, LONG)].n_words == 120_000 and not got[(7, LONG)].kept  # counting is repetitive
    assert got[(6, ROWS[7][1])].n_symbols == 4  # < | | >
    assert quality.with_verdict(empty).count() == 0
    with pytest.raises(ValueError):
        quality.with_verdict(docs, "Text")


def test_quality_verdicts():
    import random
    import zstandard
    rng, z, rules = random.Random(5), zstandard.ZstdCompressor(3), quality.Bands()
    prose = " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(2000))
    noise = " ".join("".join(chr(rng.randint(161, 255) if rng.random() < 0.4 else rng.randint(33, 126)) for _ in range(60)) for _ in range(400))
    loop = " ".join(f"{w} {i}" for i in range(30) for w in ["the same line of words comes back here again and again"] * 1)
    kept = lambda t: quality.measure(t, rules, z)[-1]
    assert kept(prose) and not kept(noise) and not kept(loop * 20)
    # one half of the chunks is incompressible: the whole-document ratio passes, the chunks do not
    mixed = quality.measure(prose[:12_000] + " " + noise[:12_000], rules, z)
    assert mixed[9] > 0.3 * mixed[8] and not mixed[-1]
    assert quality.repeated_words(b"a b c x a b c".split()) == 6 and quality.repeated_words(b"a a a a".split()) == 4


def test_quality_judges_every_byte():
    import random
    import zstandard
    rng, z, rules = random.Random(6), zstandard.ZstdCompressor(3), quality.Bands()
    prose = " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(3000))
    bad = "".join(chr(rng.randint(33, 126)) for _ in range(4095))
    good, other = prose[:4096], prose[4096:8192]
    odd = lambda t: quality.measure(t, rules, z)[8:]
    assert odd(good + other[:4095]) == (2, 0, True) and odd(good + other) == (2, 0, True)
    assert odd(bad + good) == (2, 1, False) and odd(good + bad) == (2, 1, False)  # start, end
    assert odd(good + bad + other) == (3, 1, False)  # middle
    assert odd(good)[0] == 0 and odd(good + "x")[0] == 2


def test_simhash(spark, docs, empty):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.groups(docs.withColumn("fp", F.lit(0)).withColumn("root", F.lit(0))).collect()}
    assert {d for d, f in got if f == 0} == {3, 4, 5} and all(got[d, 0] == 3 for d in (3, 4, 5))
    assert simhash.groups(docs).count() == len(ROWS)
    kept = simhash.representatives(docs.withColumn("fp", F.lit("mine")))
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 6, 7] and kept.filter("fp = 'mine'").count() == 5
    assert simhash.groups(empty).count() == 0 and simhash.representatives(empty).count() == 0


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame([(1, "gamma delta EPSILON"), (1, "theta"), (10, " ".join(f"word{i} x{i}" for i in range(40))), (2, None), (3, "..."), (None, "alpha")],
                                  "item_id long, text string")
    for rules in (decontaminate.Rules(), decontaminate.Rules(block_chars=40)):  # one block, several blocks
        out = decontaminate.with_hits(docs.withColumn("n_hit", F.lit("mine")), bench, "h", rules=rules)
        rows = out.collect()
        assert len(rows) == len(ROWS) and all(r.n_hit == "mine" for r in rows)
        got = {r.doc_id: r.h for r in rows}
        assert (got[1].n_words, got[1].n_hit, list(got[1]["items"]), got[1].contaminated) == (10, 4, [1], True)
        assert got[1] == got[2] and list(got[7]["items"]) == [10] and got[7].n_hit == 80 and not got[7].contaminated
        assert (got[3].n_words, got[3].n_hit, got[3].contaminated) == (0, 0, False)
    assert decontaminate.with_hits(empty, bench).count() == 0
    assert decontaminate.with_hits(docs, bench.limit(0)).filter("hits.n_hit > 0").count() == 0
    digest = docs.limit(1).select(decontaminate.items_digest(F.array(F.lit(9), F.lit(10), F.lit(2)))).first()[0]
    assert digest == hashlib.sha256(b"10,2,9").hexdigest()


def test_mixing(spark, docs, empty):
    out = mixing.plan(docs.withColumn("target", F.lit("x"))).collect()
    assert len(out) == len(ROWS) and all(r.takes == 0 for r in out if r["size"] == 0) and all(0 <= r.takes <= 2 for r in out)
    by = {r.src: r for r in out}
    assert set(by) == {"ss1", "ss2", "ss3", "t"} and all(r.target <= 2 * r.source_size + 1e-9 for r in out)
    assert sum(r["size"] * r.takes for r in out) <= 1.5 * sum(r["size"] for r in out)
    again = mixing.plan(docs.repartition(7)).collect()
    key = lambda rows: sorted((r.h, r.src, r.takes) for r in rows)
    assert key(out) == key(again)
    taken = mixing.take(docs.withColumn("mix_h", F.lit("mine")))
    assert taken.columns == [*docs.columns, "mix_h"] and taken.count() == sum(r.takes for r in out)
    assert mixing.plan(empty).count() == 0 and mixing.take(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.takes) for r in mixing.plan(blank).collect()] == [(0, 0), (0, 0)]


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("a", 90), ("b", 1000), ("c", 400)], "src string, size long")
    got = {r.src: r.target for r in mixing.targets(sizes).collect()}
    # 1.5 * 1500 = 2250 words: a is capped at 200, c at 800, the rest goes to b
    assert got == pytest.approx({"a": 200.0, "b": 1250.0, "c": 800.0})


def test_tokens(spark, docs, empty):
    from tokenizers import Tokenizer

    spec = byte_bpe()
    small = tokens.Encoding(spec.tokenizer, length=16, batch_rows=4, remembered=100)
    tool = Tokenizer.from_file(spec.tokenizer)
    ids = {r[1]: [*tool.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in ROWS}
    for use in (spec, small):
        index = tokens.write(docs, use)
        out = tokens.digests(index, use).collect()
        assert len(out) == len(ROWS) and all(r.ends for r in out)
        at = 0
        for r in sorted(out, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        order = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
        assert order[0] is None and order[1:] == sorted(order[1:])
        want = sorted(((d, len(ids[t]), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[t]))) for d, t, *_ in ROWS), key=str)
        assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in out), key=str) == want
    row = index.filter("doc_id = 6").first()
    reader = tokens.ShardReader(row.file, small)
    values, mask = reader.sequence(row.at // 16)
    assert len(values) == len(mask) == 16 and values[row.at % 16].as_py() == ids[ROWS[7][1]][0]
    reader.close()
    assert tokens.digests(tokens.write(empty, spec), spec).count() == 0


def test_toxicity(spark, docs, empty):
    rows = [(i, ("such a scumbag you are" if i % 3 == 0 else "a fine day to you") + f" text{i}") for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (5, None), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(train, labels)
    out = train.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), toxicity.score(F.col("text"), model, spark).alias("s")).collect()
    assert all((r.s >= 0.5) == (r.doc_id % 3 == 0) for r in out)
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    scored = docs.select(toxicity.score(F.col("text"), model, spark).alias("s")).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.s <= 1 for r in scored)
    assert empty.select(toxicity.score(F.col("text"), model, spark)).count() == 0
    one = toxicity.fit(train, labels.filter("toxic = 0"))
    assert len(one.hashes) == 0 and {r.s for r in train.select(toxicity.score(F.col("text"), one, spark).alias("s")).distinct().collect()} != set()
    assert len(toxicity.fit(empty, labels).hashes) == 0


def test_fuzzy_lines(spark, docs, empty):
    line = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, f"{line}\nshort\n\n  \nab"), (2, f"  {line}s\t\nab\nother text that is here only once"), (3, None), (4, ""), (None, line), (5, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_no", F.lit("mine"))
    got = {(r.doc_id, r.line_no): (r.keep_doc, r.keep_line) for r in fuzzylines.classes(df).collect()}
    assert got[(2, 0)] == (1, 0) and got[(None, 0)] == (1, 0) and got[(2, 1)] == (1, 4) and got[(5, 0)] == (1, 4)
    assert got[(2, 2)] == (2, 2) and (1, 2) not in got and (1, 3) not in got
    out = {r.doc_id: (r.text, r.line_no) for r in fuzzylines.dedup(df).collect()}
    assert out == {1: (rows[0][1], "mine"), 2: ("other text that is here only once", "mine"), 3: (None, "mine"), 4: ("", "mine"), None: ("", "mine"), 5: ("", "mine")}
    assert fuzzylines.classes(empty).count() == 0 and fuzzylines.dedup(docs).count() == len(ROWS)


def test_fuzzy_lines_repeats(spark):
    import random
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(120))
    # the last: 101 distinct shingles against 120 distinct ones in 141, Jaccard 0.84
    pairs = [("=" * 80, "=" * 200), ("buy it now today " * 8, "buy it now today " * 20), (text[:105], text + text[60:85])]
    rows = [(2 * i + j, x.strip()) for i, pair in enumerate(pairs) for j, x in enumerate(pair)]
    true = [len({x[i:i + 5] for i in range(len(x) - 4)}) for _, x in rows]
    assert true == [1, 1, 17, 17, 101, 120]
    got = {r.doc_id: r.keep_doc for r in fuzzylines.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    rules = fuzzylines.Rules()
    lines = [x for _, x in rows] + ["ab", "".join(rng.choice("abcdef") for _ in range(400))]
    n, h, owner = fuzzylines._distinct(*fuzzylines._shingle_hashes(lines, 5), len(lines), rules)
    assert n.tolist()[:7] == [76, *true[1:], 1] and n[7] > rules.short and np.bincount(owner)[[1, 3, 5]].tolist() == true[1::2]


def test_fuzzy_lines_rows_without_ids(spark):
    rows = [(1, "known line"), (None, "known line\nfoo"), (None, "only here\nbar"), (7, "twice\nmine"), (7, "twice\nyours"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.text or "") for r in fuzzylines.dedup(df).collect())
    sevens = [t for d, t in got if d == "7"]
    assert [x for x in got if x[0] != "7"] == [("1", "known line"), ("None", ""), ("None", "foo"), ("None", "only here\nbar")]
    assert sevens in (["mine", "twice\nyours"], ["twice\nmine", "yours"])
    lines = fuzzylines.classes(df)
    assert lines.count() == 9 and lines.filter(fuzzylines.is_kept()).count() == 7


def test_suffix_dedup(spark, docs, empty):
    got = sorted(tuple(r)[:4] for r in suffixdedup.remove_repeats(docs.withColumn("h", F.lit(1))).collect() if r.doc_id is not None)
    n = len(ROWS[0][1])
    assert [x for x in got if x[0] in (1, 2)] == [(1, n, 0, 0), (1, n, 0, 0), (2, n, n, 1)]
    assert [x for x in got if x[0] in (3, 4)] == [(3, 0, 0, 0), (4, 0, 0, 0)]
    assert suffixdedup.remove_repeats(docs).count() == len(ROWS) and suffixdedup.remove_repeats(empty).count() == 0


def test_chat_layouts(spark):
    cases = [
        ('{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}', "messages", [("user", "hi"), ("assistant", "yo")]),
        ('{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": null}]}', "from_value", [("user", "hi"), ("assistant", "")]),
        ('{"instruction": "do", "input": "this", "output": "done", "id": 7}', "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
        ('{"instruction": "do", "output": "done"}', "instruction", [("user", "do"), ("assistant", "done")]),
        ('{"prompt": "p", "response": "r", "system": "s"}', "prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ('{"prompt": "p", "completion": "c"}', "prompt_completion", [("user", "p"), ("assistant", "c")]),
        ('{"question": "q", "answer": 4}', "question_answer", [("user", "q"), ("assistant", "4")]),
        ('{"data": {"messages": [{"role": "user", "content": "x"}]}}', "nested_messages", [("user", "x")]),
        ('{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}', "message_parts", [("user", "ab")]),
        ('{"messages": []}', "messages", []), ('{"turns": null}', "turns", []), ('{"text": "t"}', "one_text", [("assistant", "t")]),
        ('{"what": 1}', None, None), ('[1, 2]', None, None), (None, None, None), ('{"a": {"prompt": "p"}}', None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string").select("i", F.parse_json("raw").alias("record"))
    out = {r.i: r.c for r in df.select("i", chat.canonical(F.col("record")).alias("c")).collect()}
    for i, (_, name, turns) in enumerate(cases):
        c = out[i]
        assert (c.layout if c else None) == name, cases[i]
        assert (None if c is None or c.turns is None else [tuple(t) for t in c.turns]) == turns, cases[i]
    with pytest.raises(ValueError):
        chat.chat(df.withColumn("loss", F.lit(1)))
    assert chat.chat(df.limit(0)).count() == 0


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\\\h", "###", "####", "</turn>", "</turn>\n### user: x", "\\### Assistant: </turn> ok", "a\nb\n\n", "\\e\\h\\c: :", None, "東京 \U0001F600 ###" * 500]
    rows = [(i, j, r, t) for i, a in enumerate(nasty) for j, (r, t) in enumerate([("user", a), ("assistant", nasty[-1 - i]), (a, a), (None, "x"), ("assistant", a)])]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = chat.chat(chat.records_of_rows(df.withColumn("record", F.lit(1)))).select(
        "conv_id", chat.parse(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    for r in out:
        mine = sorted((x[1:] for x in rows if x[0] == r.conv_id), key=lambda x: x[0])
        want = [(chat.ROLES.get((role or "").lower(), role or ""), text or "") for _, role, text in mine]
        assert [tuple(t) for t in r.turns] == want
        assert r.learned == "".join(t for role, t in want if role == "assistant")
    assert chat.records_of_rows(df.limit(0)).count() == 0


def test_site_tree(spark):
    page = lambda body: f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"
    rows = [(i, f"http://A.example/{i}", page(f"<div class='strip'>Always the same strip</div><div class='words'><p>Text number {chr(97 + i)} {chr(98 + i)}</p></div>")) for i in range(20)]
    rows += [(100, "https://b.example/", page("<nav>menu</nav><article><h1>A &amp; B</h1><p><b>x<br>y<p>z &lt;b&gt; <i>q</i>w<div class=ad>buy</div>"
                                              "<section class='comments'><p>me</section><ul><li>a<li>b</ul>tail</article><aside>no</aside><footer>f</footer>")),
             (101, None, None), (102, "nonsense", ""), (103, "http://c.example", "only text < 3 &copy;"), (104, "http://c.example", "<p>a<script>x<p>"),
             (105, "http://u@c.example:80/x", "<article><p title='a>b'>open " + "long " * 200_000)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("host", F.lit("mine")).withColumn("removed", F.lit(1))
    out = sitetree.with_text(df).collect()
    got = {r.page_id: r.main_text for r in out}
    assert len(out) == len(rows) and all(r.host == "mine" for r in out)
    assert all(got[i] == f"Text number {chr(97 + i)} {chr(98 + i)}" for i in range(20))  # the strip is removed by the tree alone
    assert got[100] == "A & B\n\nx y\n\nz <b> qw\n\na\n\nb\n\ntail"
    assert (got[101], got[102], got[103], got[104]) == ("", "", "only text < 3 ©", "a") and len(got[105]) == 1_000_004
    assert sitetree.with_text(df.limit(0)).count() == 0
    assert df.select(sitetree.host_of(F.col("url"))).filter("page_id in (0, 105)").distinct().count() == 2


def test_site_tree_copies(spark):
    page = lambda body: f"<html><head><title>t</title></head><body><div class='strip'>Always the same strip</div>{body}</body></html>"
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    bodies = {
        "same": [page("<div class='wrap'><article><p>One copy</p></article></div>")] * 31,
        "most": [page(f"<div class='words'><p>{'The copy' if i % 10 < 7 else 'Text ' + word(i)}</p></div>") for i in range(200)],
        # copies of an article that differ around it
        "around": [page(f"<article><p>{'The copy' if i % 10 else 'Text ' + word(i)}</p></article><div class='box'>seen {word(i)}</div>") for i in range(60)],
        # a wrapper that looks the same wherever it has no article
        "wrapper": [page("<div class='frame'>Frame</div>" + f"<div class='words'><p>Text {word(i)}</p></div>") for i in range(40)] +
                   [page("<div class='frame'>Frame<article>Inside</article></div>")],
    }
    rows = [(f"http://{h}.example/{i}", b) for h, all_ in bodies.items() for i, b in enumerate(all_)]
    out = sitetree.with_text(spark.createDataFrame(rows, "url string, html string").repartition(5)).collect()
    got = {r.url[7:].replace(".example", ""): r.main_text for r in out}
    assert len(got) == len(rows)
    assert all(got[f"same/{i}"].endswith("One copy") for i in range(31))
    assert all(got[f"most/{i}"] == ("The copy" if i % 10 < 7 else "Text " + word(i)) for i in range(200))
    assert all(got[f"around/{i}"].startswith("The copy" if i % 10 else "Text " + word(i)) for i in range(60))
    assert all(got[f"wrapper/{i}"] == f"Text {word(i)}" for i in range(40)) and got["wrapper/40"].endswith("Inside")


def test_site_tree_names_are_a_weight(spark):
    page = lambda body: f"<html><head><title>t</title></head><body>{body}</body></html>"
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    art = lambda i: f"<article><h1>Head {word(i)}</h1><p>Text {word(i)} {word(i * 7)}</p></article>"
    want = lambda i: f"Head {word(i)}\n\nText {word(i)} {word(i * 7)}"
    hosts = {
        # names that mislead: a wrapper, a setting, a paragraph
        "wrapper": [page(f"<div class='layout with-sidebar'>{art(i)}</div><aside><article><p>Teaser {word(i)}</p></article></aside>") for i in range(20)],
        "sidebar": [page(f"<div id='sidebar-left' class='widget'>{art(i)}<p class='share'>Share this</p></div>") for i in range(20)],
        "open": [page(art(i).replace("<article>", "<article class='post comments-open'>") + f"<ol class='commentlist'><li>me {word(i)}</li></ol>"
                      f"<article class='comment-body' id='comment-{i}'><p>you {word(i)}</p></article>") for i in range(20)],
        "legal": [page(art(i).replace("<p>", "<p class='legal'>").replace("</article>", "<p class='copyright note'>All rights reserved</p></article>")) for i in range(20)],
        # names that say nothing: the tree alone finds the article
        "main": [page(f"<main><div class='ba'>The same strip</div><div class='bb'><h2>Head {word(i)}</h2><p>Text {word(i)} {word(i * 7)}</p></div><div class='bc'>Call 555-{i}</div></main>") for i in range(20)],
        "plain": [page(f"<div class='xa'><ul><li>One</li><li>Two</li></ul></div><div class='xb'><h2>Head {word(i)}</h2><p>Text {word(i)} {word(i * 7)}</p></div>"
                       f"<div class='xc'><span>All of it {'here' if i % 9 else 'there'}</span></div>") for i in range(40)],
        # inside articles: a box that repeats goes, dates and emphasis that repeat stay
        "inside": [page(art(i).replace("</article>", f"<div class='k'>Read our news</div><p><i>Note</i> {word(i * 3)}</p><div>2024-{i}</div></article>")) for i in range(40)],
    }
    rows = [(f"http://{h}.example/{i}", b) for h, all_ in hosts.items() for i, b in enumerate(all_)]
    got = {r.url[7:].replace(".example", ""): r.main_text for r in sitetree.with_text(spark.createDataFrame(rows, "url string, html string").repartition(5)).collect()}
    for h, all_ in hosts.items():
        for i in range(len(all_)):
            more = {"main": f"\n\nCall 555-{i}", "inside": f"\n\nNote {word(i * 3)}\n\n2024-{i}"}.get(h, "")
            assert got[f"{h}/{i}"] in (want(i) + more, want(i)) if h == "main" else got[f"{h}/{i}"] == want(i) + more, (h, i, got[f"{h}/{i}"])


def test_site_tree_root_stays():
    html = "<html><body><div class='a'><article>text</article></div><div class='b'>other</div></body></html>"
    key = {}
    for stack, _ in sitetree.events(html):
        key |= {e.tag + e.path[-2:]: e.key for e in stack}
    assert sitetree.main_text(html, frozenset(key.values()) - {key["div.b"]}) == "text\n\nother"
    assert sitetree.main_text(html, frozenset(key.values())) == "text"


def test_windows_are_compared_by_bytes(monkeypatch):
    """Hashes of a few bits only: windows that collide are told apart by their bytes."""
    import pyarrow as pa

    rng = np.random.RandomState(6)
    rules = suffixdedup.Rules(length=5)
    whole = suffixdedup._string_hashes
    monkeypatch.setattr(suffixdedup, "_string_hashes", lambda data, size: whole(data, size) & np.uint64(3))
    rows, want = [], []
    windows: dict = {}
    parts = []
    for part in range(4):
        contexts = [bytes(rng.randint(97, 99, rng.randint(5, 12)).astype(np.uint8)) for _ in range(30)]
        docs = rng.randint(0, 50, 30)
        parts.append((contexts, docs))
        for c, d in zip(contexts, docs.tolist()):
            for i in range(len(c) - 4):
                windows[c[i:i + 5]] = min(windows.get(c[i:i + 5], d), d)
        rows.append((np.array([len(c) for c in contexts], np.uint8).tobytes(), docs.astype(np.int64).tobytes(), b"".join(contexts)))
    for contexts, docs in parts:
        want.append([sum((windows[c[i:i + 5]] < d) << i for i in range(len(c) - 4)) for c, d in zip(contexts, docs.tolist())])
    sizes, docs, data = zip(*rows)
    batch = pa.table({"route": [0] * 4, "slice": list(range(4)), "sizes": list(sizes), "docs": list(docs), "data": list(data)})
    got = suffixdedup._answer(rules)(batch)
    assert [np.frombuffer(x, np.uint32).tolist() for x in got["masks"].to_pylist()] == want


def test_suffix_levels_with_hot_suffixes(spark):
    """Small slices, hot suffixes beyond the broadcast limit and few tasks give what plain Python gives."""
    rng = np.random.RandomState(9)
    passages = [bytes(rng.randint(97, 123, 120).astype(np.uint8)).decode() for _ in range(6)]
    texts = [" ".join(passages[rng.randint(0, 6)] if rng.rand() < 0.4 else bytes(rng.randint(97, 123, 90).astype(np.uint8)).decode() for _ in range(rng.randint(1, 6)))
             for _ in range(150)] + [passages[0]] * 3
    rows = list(enumerate(texts))
    first: dict = {}
    for d, t in rows:
        for i in range(len(t) - 49):
            first.setdefault(t[i:i + 50], d)
    want = {}
    for d, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < d:
                gone[i:i + 50] = [True] * 50
        want[d] = "".join(c for c, g in zip(t, gone) if not g)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for rules in (suffixdedup.Rules(slice_bytes=3000), suffixdedup.Rules(slice_bytes=2000, hot_slices=2, broadcast_rows=5, slice_tasks=3)):
        got = {r.doc_id: bytes(r.kept).decode() for r in suffixdedup.remove_repeats(df, rules=rules).collect()}
        assert got == want
