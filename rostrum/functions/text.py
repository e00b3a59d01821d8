"""String expressions: trimming, dates, tokens and n-grams.

Everything here is a built-in Spark expression, so it runs inside the JVM on whole texts.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The characters Unicode-aware `\s` and str.strip() treat as white space.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_WS_NO_BLANK = WS.replace(r"\x1c-\x20", r"\x1c-\x1f")

# Month names and their numbers.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}

# The strings a CSV reader takes as missing.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

UNKNOWN_SPEAKER = "UNKNOWN_SPEAKER"

FIRST_PASS_PATTERN = r"[a-zA-Z]+"
SECOND_PASS_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Above this many words a stopword list is joined as a table instead of being held in the expression.
MAX_INLINE_WORDS = 50_000


def trim_ws(c: Column) -> Column:
    """Trim every Unicode white-space character, not only blanks."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def safe_str(c: Column) -> Column:
    """Trimmed text, or null when it is empty or spells ``none``."""
    t = trim_ws(c.cast("string"))
    return F.when(~F.lower(t).isin("", "none"), t)


def normalize_ws(c: Column) -> Column:
    """White-space runs become one blank; both ends are trimmed. Runs that are one blank already stay as they are."""
    return F.trim(F.regexp_replace(c, f"{_WS_NO_BLANK}{WS}*| {WS}+", " "))


def flatten_newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))


def normalize_body(c: Column) -> Column:
    """Chamber label in lower case, trimmed; null gives the empty string."""
    return F.lower(trim_ws(F.coalesce(c, F.lit(""))))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_STRINGS), c)


def clean_speaker(c: Column) -> Column:
    """First-pass speaker label: trimmed, and the unknown label for null or blank."""
    return F.coalesce(F.nullif(trim_ws(c), F.lit("")), F.lit(UNKNOWN_SPEAKER))


def simplify_text(c: Column) -> Column:
    """Text without ASCII punctuation, in lower case, with single blanks."""
    return F.lower(normalize_ws(F.translate(c, string.punctuation, "")))


def parse_month(c: Column) -> Column:
    """Month number from a digit string 1..12 or a full English name in any case."""
    s = F.lower(trim_ws(c))
    names = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    n = F.when(s.rlike("^[0-9]+$"), s.try_cast("int")).otherwise(F.try_element_at(names, s))
    return F.when(n.between(1, 12), n)


def header_date(year: Column, month: Column, day: Column) -> Column:
    """``YYYY-MM-DD`` from three integers, null unless all are there. The day is not range-checked."""
    parts = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(parts, F.format_string("%04d-%02d-%02d", year, month, day))


def token_array(text: Column, pattern: str) -> Column:
    """Lower-cased matches of ``pattern``; one capture group, if any, is the token."""
    groups = re.compile(re.sub(r"\\[pP]\{\w+\}", r"\\w", pattern)).groups
    if groups > 1:
        raise ValueError("a token pattern may hold at most one capture group")
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(groups))


def word_class(pattern: str) -> tuple[str, int] | None:
    """``(class, least length)`` of a pattern that matches runs of one class of characters, else None."""
    found = re.fullmatch(r"(\[[^\[\]^&][^\[\]&]*\])(?:\+|\{([1-9]\d?),\})", pattern)
    return (found[1], int(found[2] or 1)) if found else None


_CLASSES: dict[str, bytes] = {}


def class_bits(spark: SparkSession, cls: str) -> bytes:
    """One bit for each code point: whether the engine's regular expressions count it to ``cls``."""
    if cls not in _CLASSES:
        step = 4096
        rows = [(at, "".join(map(chr, range(at, at + step)))) for at in range(0, 0x110000, step) if not 0xD800 <= at < 0xE000]
        marked = spark.createDataFrame(rows, "at int, s string").select("at", "s", F.regexp_replace("s", cls, "\0").alias("m")).toArrow()
        bits = np.zeros(0x110000, bool)
        for at, s, m in zip(*[marked[c].to_pylist() for c in ("at", "s", "m")]):
            bits[at:at + step] = [x != y for x, y in zip(s, m, strict=True)]
        _CLASSES[cls] = np.packbits(bits).tobytes()
    return _CLASSES[cls]


def without_words(tokens: Column, words: Iterable[str]) -> Column:
    """Tokens in order, less the given words. A long literal list is a hash-set test in the plan."""
    words = list(words)
    if not words:
        return tokens
    if len(words) > MAX_INLINE_WORDS:
        raise ValueError("list too long for an expression; use vocabulary.remove_words")
    return F.filter(tokens, lambda t: ~t.isin(words))


def join_next(grams: Column, tokens: Column, n: int, sep: str) -> Column:
    """n-grams from (n-1)-grams at the same start: slot i is null where no n-gram starts at i."""
    return F.zip_with(grams, F.slice(tokens, n, F.greatest(F.size(tokens), F.lit(1))),
                      lambda a, b: F.concat(a, F.lit(sep), b))


def term_length(term: Column) -> Column:
    return F.size(F.split(term, " "))
