"""Inputs derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.plans.stage import spread

# Words left out by the vocabulary queries.
STOP = ["the", "of", "and", "to", "in", "by", "la", "de", "le", "les", "un", "une", "et", "der", "die", "und", "el", "los", "que", "a", "i", "o", "s"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
MIN_DF, MAX_DF, MIN_AUTHORS = 0.01, 0.75, 3
MIN_SPEECHES = 5


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str, write: bool = False) -> DataFrame:
    """``doc_id, speaker, text``; every source is a speaker. ``write`` suits plans of several scans."""
    return spread(table(spark, sf, "documents").select("doc_id", F.col("source").alias("speaker"), "text"), "doc_id", write)


DOCS = "docs AS (SELECT doc_id, source AS speaker, text FROM documents)"

_SPEAKER = """CASE WHEN n_chars < 100 THEN NULL WHEN n_chars < 150 THEN '  '
 WHEN n_chars < 300 THEN concat(' ', source, ' ') ELSE source END"""
_BODY = """CASE WHEN lang = 'es' THEN 'Extensions' WHEN lang = 'de' AND n_chars < 200 THEN NULL
 WHEN lang = 'en' AND n_chars < 500 THEN ' HOUSE ' WHEN lang = 'en' THEN 'House' ELSE 'Senate' END"""
_TEXT = "CASE WHEN n_chars < 60 THEN NULL ELSE text END"


def speeches(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, speaker, body, text`` with null, blank and untrimmed labels and null texts."""
    d = spread(table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text"), "doc_id")
    return d.select("doc_id", F.expr(_SPEAKER).alias("speaker"), F.expr(_BODY).alias("body"), F.expr(_TEXT).alias("text"))


SPEECHES = f"speeches AS (SELECT doc_id, {_SPEAKER} AS speaker, {_BODY} AS body, {_TEXT} AS text FROM documents)"

# White space as the engine sees it, for RE2.
WS_SQL = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def sql_ws(x: str) -> str:
    return sql_trim(f"regexp_replace({x}, '{WS_SQL}+', ' ', 'g')")


def sql_simple(x: str) -> str:
    return f"lower({sql_ws(f'''regexp_replace({x}, '[!-/:-@\\[-`{{-~]', '', 'g')''')})"


def sql_safe(x: str) -> str:
    t = sql_trim(x)
    return f"CASE WHEN lower({t}) NOT IN ('', 'none') THEN {t} END"


def sql_tokens(name: str, src: str, expr: str, cols: str) -> str:
    """CTE of token rows ``cols, tok, pos``."""
    return (f"{name}_l AS (SELECT {cols}, {expr} AS l FROM {src}),\n"
            f"{name} AS (SELECT {cols}, unnest(l) AS tok, generate_subscripts(l, 1) AS pos FROM {name}_l)")


def sql_grams(name: str, tokens: str, cols: str, sep: str = " ") -> str:
    """CTE of 1..3-gram rows ``cols, term, n, pos`` by window lead."""
    w = "OVER (PARTITION BY doc_id ORDER BY pos)"
    return (f"{name}_w AS (SELECT {cols}, pos, tok AS t1, lead(tok, 1) {w} AS t2, lead(tok, 2) {w} AS t3 FROM {tokens}),\n"
            f"{name} AS (SELECT {cols}, t1 AS term, 1 AS n, pos FROM {name}_w\n"
            f" UNION ALL SELECT {cols}, t1 || '{sep}' || t2, 2, pos FROM {name}_w WHERE t2 IS NOT NULL\n"
            f" UNION ALL SELECT {cols}, t1 || '{sep}' || t2 || '{sep}' || t3, 3, pos FROM {name}_w WHERE t3 IS NOT NULL)")


PASS1 = f"list_filter(regexp_extract_all(lower(text), '[a-zA-Z]+'), lambda x: x NOT IN ({STOP_SQL}))"
PASS2 = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

GRAMS1 = [DOCS, sql_tokens("tok1", "docs", PASS1, "doc_id, speaker"), sql_grams("gram1", "tok1", "doc_id, speaker")]
STATS = [*GRAMS1, """stats AS (SELECT term, count(DISTINCT doc_id) AS df, count(DISTINCT speaker) AS n_authors FROM gram1 GROUP BY term)"""]
VOCAB = [*STATS, f"""vocab AS (SELECT term, len(string_split(term, ' ')) AS n, row_number() OVER (ORDER BY term) - 1 AS term_id FROM stats
 WHERE n_authors >= {MIN_AUTHORS} AND df >= {MIN_DF} * (SELECT count(*) FROM docs) AND df <= {MAX_DF} * (SELECT count(*) FROM docs))"""]
COUNTS = [*VOCAB, sql_tokens("tok2", "docs", PASS2, "doc_id"), sql_grams("gram2", "tok2", "doc_id"),
          """dtm AS (SELECT doc_id, term_id, v.n AS n, count(*) AS cnt FROM gram2 g JOIN vocab v ON g.term = v.term GROUP BY ALL)"""]
OVERLAP = """big AS (SELECT term_id, term, n, string_split(term, ' ') AS tok FROM vocab WHERE n > 1),
subs AS (SELECT DISTINCT term_id, n, unnest(tok) AS sub FROM big
 UNION SELECT term_id, n, tok[1] || ' ' || tok[2] FROM big WHERE n > 2 UNION SELECT term_id, n, tok[2] || ' ' || tok[3] FROM big WHERE n > 2),
overlap AS (SELECT s.term_id, s.n, v.term_id AS sub_id, v.n AS sub_n, s.term_id < v.term_id AS before FROM subs s JOIN vocab v ON s.sub = v.term)"""


def sql_deoverlap(dtm: str, overlap: str, out: str, key: str = "doc_id", match: str = "") -> str:
    """CTEs for the counts after taking n-grams off the terms inside them."""
    return f"""{out}_off AS (SELECT {key}, o.sub_id AS term_id, sum(cnt) AS off, sum(CASE WHEN o.before THEN cnt ELSE 0 END) AS early
 FROM {dtm} d JOIN {overlap} o USING ({match}term_id) WHERE d.n > 2 AND o.sub_n = 2 GROUP BY ALL),
{out}_eff AS (SELECT d.*, cnt - coalesce(off, 0) AS final2, cnt - coalesce(early, 0) AS eff FROM {dtm} d LEFT JOIN {out}_off USING ({key}, term_id)),
{out}_uni AS (SELECT {key}, o.sub_id AS term_id, sum(eff) AS off FROM {out}_eff e JOIN {overlap} o USING ({match}term_id) WHERE o.sub_n = 1 GROUP BY ALL),
{out} AS (SELECT {key}, term_id, n, CAST(greatest(final2 - coalesce(u.off, 0), 0) AS BIGINT) AS cnt
 FROM {out}_eff LEFT JOIN {out}_uni u USING ({key}, term_id) WHERE final2 - coalesce(u.off, 0) > 0)"""


# Boilerplate classifier: the 50 most frequent n-grams of short documents, weights by a hash of the term.
BIAS = -0.25
SHORT = [DOCS, f"simple AS (SELECT doc_id, {sql_simple('text')} AS simple FROM docs)",
         "cand AS (SELECT * FROM simple WHERE length(simple) > 15 AND length(simple) - length(replace(simple, ' ', '')) > 1)",
         "short AS (SELECT * FROM cand WHERE length(simple) < 400)",
         sql_tokens("stok", "short", "string_split(simple, ' ')", "doc_id"), sql_grams("sgram", "stok", "doc_id", "_")]
HASH = lambda x: f"(CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT) + 0.5) / 4294967296.0"
MODEL = [*SHORT, f"""model AS (SELECT term, round(2 * {HASH('term')} - 1, 6) AS weight FROM
 (SELECT term, count(*) AS c FROM sgram GROUP BY term ORDER BY c DESC, term LIMIT 50))"""]


def hash_unit(c: Column) -> Column:
    h = F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(4294967296.0)
