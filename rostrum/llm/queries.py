"""Registered queries of the training-data operators: thin digests of each operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import stage
from . import chat, decontaminate, fuzzylines, lexical, manifest, mixing, quality, simhash, sitetree, suffixdedup, tokens, toxicity, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_compression_bands")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_verdict(docs, "q").select("doc_id", "q.*")


@query("op10_simhash_vp_trees")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return simhash.groups(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_prefix_decontamination", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(x) AS l, array_to_string(x, ' ') AS g FROM (
       SELECT item_id, w[s:s + least(13, len(w)) - 1] AS x
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b WHERE len(w) > 0))),
gram AS (SELECT r, p, l, array_to_string(w[p:p + l - 1], ' ') AS g
       FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)),
hit AS (SELECT DISTINCT r, p, l, item_id FROM gram JOIN win USING (l, g)),
n AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + l)) AS q FROM hit) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), "h")
    return found.select("doc_id", "h.n_words", "h.n_hit", F.size("h.items").cast("long").alias("n_items"),
                        decontaminate.items_digest(F.col("h.items")).alias("items_sha256"), "h.contaminated")


@query("op9_fair_queueing", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, 't') AS src,
       CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
       md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS n, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS INT)] AS BIGINT) AS w
      FROM d GROUP BY src),
o AS (SELECT *, CAST(1.5 AS DOUBLE) * CAST(sum(n) OVER () AS DOUBLE) AS b,
       CAST(sum(2 * n) OVER f AS BIGINT) - 2 * n AS c0, CAST(sum(w) OVER () AS BIGINT) - CAST(sum(w) OVER f AS BIGINT) + w AS w0 FROM s
       WINDOW f AS (ORDER BY CAST(2 * n AS DOUBLE) / CAST(w AS DOUBLE), src ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, 2 * n <= w * ((b - c0) / w0) AS capped FROM o),
t AS (SELECT src, n, b, CASE WHEN capped THEN CAST(2 * n AS DOUBLE) ELSE w * ((b - CAST(sum(CASE WHEN capped THEN 2 * n ELSE 0 END) OVER () AS DOUBLE))
       / CAST(sum(CASE WHEN NOT capped THEN w END) OVER () AS DOUBLE)) END AS target FROM c),
q AS (SELECT d.*, n, b, target, CAST(sum(size) OVER (PARTITION BY src ORDER BY h ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum FROM d JOIN t USING (src)),
e AS (SELECT r, src, size, b, cum + k * n AS pos, CAST(cum + k * n AS DOUBLE) / target AS f FROM q, (VALUES (0), (1)) AS v(k) WHERE size > 0),
g AS (SELECT r, CASE WHEN sum(size) OVER (ORDER BY f, src, pos ROWS UNBOUNDED PRECEDING) <= b THEN size ELSE 0 END AS took FROM e),
u AS (SELECT r, CAST(sum(took) AS BIGINT) AS taken FROM g GROUP BY r)
SELECT doc_id, size, n AS source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN u USING (r)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.plan(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("takes")).alias("taken"))


def byte_bpe() -> tokens.Encoding:
    import public_tokenizers

    return tokens.Encoding(public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_arrow_sequences")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokens.digests(tokens.write(docs, byte_bpe()), byte_bpe())
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


#: Fixed value: what both turns of the added conversation say.
ESCAPED_TURN = "\\### Assistant: </turn> ok"


@query("op7_schema_fingerprint", r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, 4 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c')) + 2
             + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e')) + 8 AS size FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pair = F.to_variant_object(F.struct(F.lit(ESCAPED_TURN).alias("prompt"), F.lit(ESCAPED_TURN).alias("response")))
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), pair.alias("record"))
    out = stage(chat.chat(chat.records_of_rows(rows).unionByName(added)), "chat-formatted")
    back = out.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("loss")).alias("learned"))
    each = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(each, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op4_ngram_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.score(F.col("text"), model, spark).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_site_style_tree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return sitetree.with_text(pages, "t").select("page_id", "url", F.col("t").alias("text"), F.length("t").cast("long").alias("n_chars"))


@query("op2_fuzzy_lines")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = fuzzylines.classes(docs)
    per = lines.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sum((~fuzzylines.is_kept()).cast("long")).alias("n_removed"),
        F.array_sort(F.collect_set(F.when(~fuzzylines.is_kept(), F.col("keep_doc")))).alias("keepers"))
    ids = docs.select(F.col("doc_id").alias("id")).distinct()
    return ids.join(per, F.col("id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("id").alias("doc_id"), F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("keepers", F.array().cast("array<long>")).alias("keepers"))


@query("op6_suffix_levels")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffixdedup.remove_repeats(docs, digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


#: What the leaf of a document hashes, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@query("op12_interval_manifest", r"""
WITH RECURSIVE c AS (SELECT row_number() OVER () AS r, *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
       list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
         lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
       FROM documents),
e AS (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
       || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM c),
l AS (SELECT r, doc_id, coalesce('s' || source, '') AS t, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
       CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS bad FROM e),
k AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM l),
g(t, n, v, i, h) AS (SELECT t, n, 0, i, leaf FROM k UNION ALL
       SELECT t, n, v + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM g WHERE n > CAST(pow(16, v) AS BIGINT) GROUP BY t, n, v, i // 16),
top AS (SELECT t, max_by(h, v) AS subroot, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM g GROUP BY t),
w(n, v, i, h) AS (SELECT n, 0, i, subroot FROM top UNION ALL
       SELECT n, v + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM w WHERE n > CAST(pow(16, v) AS BIGINT) GROUP BY n, v, i // 16),
sib AS (SELECT a.t, a.v, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
       FROM g a JOIN g b ON a.t = b.t AND a.v = b.v AND a.i // 16 = b.i // 16 WHERE a.n > CAST(pow(16, a.v) AS BIGINT) GROUP BY a.t, a.v, a.i),
up AS (SELECT a.v, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
       FROM w a JOIN w b ON a.v = b.v AND a.i // 16 = b.i // 16 WHERE a.n > CAST(pow(16, a.v) AS BIGINT) GROUP BY a.v, a.i),
steps AS (SELECT r, sib.v, x, y FROM k JOIN sib ON sib.t = k.t AND sib.i = k.i // CAST(pow(16, sib.v) AS BIGINT)
       UNION ALL SELECT r, 100 + up.v, x, y FROM k JOIN top USING (t) JOIN up ON up.i = top.i // CAST(pow(16, up.v) AS BIGINT)),
p AS (SELECT r, string_agg(x || y, '' ORDER BY v) AS proof, list({'x': x, 'y': y} ORDER BY v) AS s FROM steps GROUP BY r),
f(r, j, h, s) AS (SELECT r, 1, coalesce(bad, leaf), coalesce(s, []) FROM k LEFT JOIN p USING (r) UNION ALL
       SELECT r, j + 1, sha256(s[j].x || h || s[j].y), s FROM f WHERE j <= len(s)),
d AS (SELECT r, h FROM f WHERE j = len(s) + 1), o AS (SELECT max_by(h, v) AS root FROM w)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, h AS folded_root, h = root AS verified
FROM k JOIN top USING (t) JOIN d USING (r) LEFT JOIN p USING (r), o""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    values = [F.col(c) for c in LEAF_COLUMNS]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf([*values[:-1], lowered]))
    leaves = manifest.build(docs, values, F.col("doc_id"), F.col("source"), tampered).leaves()
    folded = leaves.withColumn("folded_root", manifest.fold(F.col("path"), F.coalesce("presented", "leaf")))
    return folded.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_content_archive", r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS x FROM pages),
k AS (SELECT *, CASE WHEN strlen(x) >= 1000 THEN max(page_id) OVER (PARTITION BY x) END AS last FROM p)
SELECT page_id, CAST(strlen(x) AS BIGINT) AS payload_bytes, sha1(x) AS payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to FROM k""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.store(warc.of_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    of = lambda name: warc.field(F.col("header"), name)
    # the digest named in the header must be that of the payload which the join brought
    sha1 = F.sha1("payload")
    wrong = F.raise_error(F.concat(F.lit("payload differs from its header's digest "), sha1)).cast("string")
    return archive.records(spark).select(
        warc.page_of(of("WARC-Record-ID")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(of("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1), sha1).otherwise(wrong).alias("payload_digest"),
        of("WARC-Type").alias("record_type"), warc.page_of(of("WARC-Refers-To")).alias("refers_to"))


@query("op11_blocked_lexical_search", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM b) GROUP BY r, doc_id, n, t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY t, nd),
f AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // l))))) AS BIGINT) AS score
      FROM p JOIN wt USING (t) JOIN b USING (t), s GROUP BY item_id, r, doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS INT) AS rank FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
