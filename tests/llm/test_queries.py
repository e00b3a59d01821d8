"""Registered queries over whole tables: against their SQL, or against plain Python on the same rows."""

import collections
import hashlib
import html
import math
import os
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from rostrum.llm import quality, toxicity
from rostrum.llm.queries import ORACLES, QUERIES, byte_bpe
from tools.compare import canonical, database

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF).collect()))


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical([d[0] for d in cur.description], cur.fetchall())


def base_measures(text):
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_op1(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op1_compression_bands"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for d, text, _ in docs:
        r = rows[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_measures(text)
        assert not (r.kept and r.base_failed)


def judged(raw, z, rules):
    """Whether the compression bands keep a text, chunk by chunk."""
    band = [b for b in rules.limits if len(raw) >= b[0]][-1]
    if not raw or not band[1] <= len(z.compress(raw)) / len(raw) <= band[2]:
        return False
    chunks, n = [], rules.chunk_bytes
    if len(raw) > n:
        chunks = [raw[i:i + n] for i in range(0, len(raw), n) if i + n <= len(raw)]
        if len(raw) % n:
            chunks.append(raw[-n:])
    odd = [c for c in chunks if not rules.chunk_limits[0] <= len(z.compress(c)) / n <= rules.chunk_limits[1]]
    return len(odd) <= rules.chunk_share * len(chunks)


def test_op1_verdict(spark, docs):
    """Ratios and verdicts from zstandard alone: the whole text, and chunks of which the last ends at the text's end."""
    rules, z = quality.Bands(), zstandard.ZstdCompressor(level=quality.Bands().level)
    rows = {r.doc_id: r for r in QUERIES["op1_compression_bands"](spark, SF).collect()}
    seen = collections.Counter()
    for d, text, _ in docs:
        r, raw = rows[d], text.encode()
        ratio = len(z.compress(raw)) / len(raw) if raw else None
        assert r.ratio == ratio if ratio is None else abs(r.ratio - ratio) < 1e-12
        verdict = not r.base_failed and judged(raw, z, rules)
        seen[r.kept] += 1
        assert r.kept == verdict, d
    assert len(seen) == 2


def classes(items, similar):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in similar:
        parent[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_op2(spark, docs):
    where = collections.defaultdict(list)
    for d, text, _ in docs:
        for n, line in enumerate(text.split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                where[line.strip(" \t\r\x0b\x0c")].append((d, n))
    lines = list(where)
    sets, posting, pairs = [{x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in lines], collections.defaultdict(list), []
    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in posting[g])
        pairs += [(i, j) for j, k in shared.items() if Fraction(k, len(s) + len(sets[j]) - k) >= Fraction(4, 5)]
        for g in s:
            posting[g].append(i)
    first = {}
    group = classes(lines, pairs)
    for g, x in zip(group, lines):
        first[g] = min([first.get(g, (1 << 62, 0)), *where[x]])
    want = {d: [0, 0, set()] for d, _, _ in docs}
    for g, x in zip(group, lines):
        for at in where[x]:
            want[at[0]][0] += 1
            if at != first[g]:
                want[at[0]][1] += 1
                want[at[0]][2].add(first[g][0])
    assert run(spark, "op2_fuzzy_lines") == sorted((d, n, k, sorted(s)) for d, (n, k, s) in want.items())


def test_op3(spark, con):
    got = {r.page_id: r for r in QUERIES["op3_site_style_tree"](spark, SF).collect()}
    for page, url, source in con.execute("SELECT page_id, url, html FROM pages").fetchall():
        article = re.search("<article>(.*?)</article>", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[page].url, got[page].text, got[page].n_chars) == (url, want, len(want))


def test_op4(spark, con):
    sf = SF.replace("sf0.001", "sf0.01")
    labels = dict(database(sf).execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = QUERIES["op4_ngram_toxicity"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) and {b for _, b in held} == {0, 1}


def grams(text, orders=(3, 4, 5), bits=20):
    """The buckets of a text's character n-grams in Python's own integers; none reaches over white space inside."""
    m, out = (1 << 64) - 1, set()
    codes = [32 if ord(c) <= 32 else ord(c) for c in f" {text.lower()} "]
    for n in orders:
        for i in range(len(codes) - n + 1):
            if 32 in codes[i + 1:i + n - 1]:
                continue
            h = codes[i]
            for c in codes[i + 1:i + n]:
                h = (h * 0x9E3779B97F4A7C15 + c) & m
            out.add((((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 + n) & m) >> (64 - bits))
    return out


def test_op4_by_brute_force(spark, docs, con):
    """Counts, ratios, the choice of features, and scores, document by document."""
    labels = dict(con.execute("SELECT doc_id, toxic FROM labels WHERE toxic IS NOT NULL").fetchall())
    has = {d: grams(text or "") for d, text, _ in docs}
    train = [d for d, _, _ in docs if d in labels and zlib.crc32(str(d).encode()) % 5]
    counts = [collections.Counter(f for d in train if labels[d] == c for f in has[d]) for c in (0, 1)]
    size = [sum(labels[d] == c for d in train) for c in (0, 1)]
    rules, want = toxicity.Rules(least_z=1.5), {}
    for f in counts[0].keys() | counts[1].keys():
        n0, n1 = counts[0][f], counts[1][f]
        r = math.log((n1 + 1) / (size[1] + 2)) - math.log((n0 + 1) / (size[0] + 2))
        if abs(r) / math.sqrt(1 / (n1 + 1) + 1 / (n0 + 1)) >= rules.least_z:
            want[f] = r
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(df, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), rules)
    assert model.hashes.tolist() == sorted(want) and len(want) > 10
    weights = dict(zip(model.hashes.tolist(), model.weights))
    # the optimizer's own optimum: the gradient of the penalised loss in each coefficient (weight / ratio) is near nought
    rows = [(labels[d], [f for f in has[d] if f in want]) for d in train]
    errors = [1 / (1 + math.exp(-(model.intercept + sum(weights[f] for f in fs)))) - y for y, fs in rows]
    slope = collections.Counter()
    for e, (_, fs) in zip(errors, rows):
        for f in fs:
            slope[f] += e * want[f] / len(rows)
    assert max(abs(slope[f] + rules.reg * weights[f] / want[f]) for f in want) < 1e-3 and abs(sum(errors)) / len(rows) < 1e-3
    got = {r.doc_id: r.s for r in df.select("doc_id", toxicity.score(F.col("text"), model, spark).alias("s")).collect()}
    for d, _, _ in docs:
        assert abs(got[d] - 1 / (1 + math.exp(-(model.intercept + sum(weights.get(f, 0.0) for f in has[d]))))) < 1e-9


def token_rows(rows):
    from tokenizers import Tokenizer

    tool, at, out = Tokenizer.from_file(byte_bpe().tokenizer), 0, []
    for d, text in rows:
        ids = np.array([*tool.encode(text, add_special_tokens=False).ids, 2], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    return out


def test_op5(spark, docs):
    assert run(spark, "op5_arrow_sequences") == token_rows([(d, t) for d, t, _ in docs])


def test_op6(spark, docs):
    first, want = {}, []
    for d, text, _ in docs:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        new = []
        for i in range(len(data) - 49):
            if data[i:i + 50] in first:
                gone[i:i + 50] = True
            else:
                new.append(data[i:i + 50])
        first.update(dict.fromkeys(new))
        spans = int((gone & ~np.concatenate(([False], gone))[:len(gone)]).sum())
        want.append((d, len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    assert run(spark, "op6_suffix_levels") == want


def fingerprints(texts):
    out = []
    for t in texts:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        h = [xxhash.xxh64(" ".join(words[i:i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))] if words else []
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def near(prints):
    return [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]


def test_op10(spark, docs):
    prints = fingerprints([t for _, t, _ in docs])
    group = classes(docs, near(prints))
    least = {}
    for g, (d, _, _) in zip(group, docs):
        least.setdefault(g, d)
    assert run(spark, "op10_simhash_vp_trees") == [(d, f"{f:016x}", least[g]) for (d, _, _), f, g in zip(docs, prints, group)]


def mixed(rows):
    """Fair queueing in plain Python: rows (doc_id, text, source) in, the same rows as often as taken out."""
    size = [len(WORD.findall(t)) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows})
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    budget, target, free = 1.5 * sum(size), {}, set(sources)
    while True:
        left = budget - sum(target.values())
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * total[s]}
        if not over:
            break
        target |= {s: 2 * total[s] for s in over}
        free -= over
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    queue = []
    for s in sources:
        mine = [(hashlib.md5(f"17:{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest(), i) for i, r in enumerate(rows) if r[2] == s]
        at = 0
        for _, i in sorted(mine) * 2:
            at += size[i]
            if size[i]:
                queue.append((at / target[s], s, at, i))
    out, used = [], 0
    for *_, i in sorted(queue):
        used += size[i]
        if used > budget:
            break
        out.append(rows[i])
    return out


def test_pipeline(spark, con, docs):
    rules, packer = quality.Bands(), zstandard.ZstdCompressor(3)
    rows = [r for r in docs if quality.measure(r[1], rules, packer)[-1]]
    seen, kept = set(), []
    for r, g in zip(rows, classes(rows, near(fingerprints([r[1] for r in rows])))):
        if g not in seen:
            kept.append(r)
        seen.add(g)
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[i:i + 13]) for (t,) in con.execute("SELECT text FROM benchmark").fetchall() for w in [split(t)] if w for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = split(text)
        hit = {j for n in sizes for i in range(len(words) - n + 1) if tuple(words[i:i + n]) in windows for j in range(i, i + n)}
        return not (hit and 20 * len(hit) >= len(words))

    want = token_rows(sorted((d, t) for d, t, _ in mixed([r for r in kept if clean(r[1])])))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "source_mix", "token_files"]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, frame.limit(0), SF).columns == frame.columns
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want
