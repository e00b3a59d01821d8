"""Scalar expressions on hand-made edge rows, against plain Python string rules."""

import re
import string

import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as T

WILD = ["", " ", "none", " None ", "NONE\t", " x ", "\x0ba\x1cb\x85 c　", "a  b\n\nc", "tab\tend\t", "No.ne", "ÀÉ  ß", "x​y",
        "Mr. SPEAKER, I yield!", "it's   well-known", "a_b \\ c ^ d ` {e} [f] ~g", "...", " ! ? "]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_white_space_and_safe_str(spark):
    assert column(spark, WILD, T.trim_ws) == [v.strip() for v in WILD]
    assert column(spark, WILD, T.normalize_ws) == [re.sub(r"\s+", " ", v).strip() for v in WILD]
    want = [v.strip() if v.strip() and v.strip().lower() != "none" else None for v in WILD]
    assert column(spark, WILD + [None], T.safe_str) == want + [None]


def test_simplify(spark):
    drop = str.maketrans("", "", string.punctuation)
    want = [re.sub(r"\s+", " ", v.translate(drop).strip().lower()) for v in WILD]
    assert column(spark, WILD, T.simplify_text) == want


def test_labels(spark):
    assert column(spark, [" HOUSE ", None, "Senate ", "Extensions"], T.normalize_body) == ["house", "", "senate", "extensions"]
    assert column(spark, [" a ", None, " \t", "b"], T.clean_speaker) == ["a", T.UNKNOWN_SPEAKER, T.UNKNOWN_SPEAKER, "b"]
    assert column(spark, ["NA", "null", "na", "", "N/A", "x"], T.na_to_null) == [None, None, "na", None, None, "x"]
    assert column(spark, ["a\nb\r\nc", "d"], T.flatten_newlines) == ["a b  c", "d"]


def test_months_and_dates(spark):
    got = column(spark, ["March", " mAy ", "3", "03", "13", "0", "3.0", "Mar", None, "-3", ""], T.parse_month)
    assert got == [3, 5, 3, 3, None, None, None, None, None, None, None]
    df = spark.createDataFrame([(2024, 1, 45), (24, 12, 1), (None, 1, 1), (2024, None, 1)], "y int, m int, d int")
    out = [r[0] for r in df.select(T.header_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert out == ["2024-01-45", "0024-12-01", None, None]


def test_token_patterns(spark):
    text = ["José o'Neil x1 2nd_go A"]
    assert column(spark, text, lambda c: T.token_array(c, T.FIRST_PASS_PATTERN)) == [["jos", "o", "neil", "x", "nd", "go", "a"]]
    assert column(spark, text, lambda c: T.token_array(c, T.SECOND_PASS_PATTERN)) == [["josé", "neil", "x1", "2nd_go"]]
    assert column(spark, text, lambda c: T.token_array(c, r"(\w)\w+")) == [["j", "n", "x", "2"]]
    with pytest.raises(ValueError):
        T.token_array(F.lit("a"), "(a)(b)")
