"""Parity vectors for the text functions (whitespace, tokenizer, previews)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T

TOKEN_CASES = [
    ("parseHTTPResponse", ["parse", "httpresponse"]),
    ("get_URL2JSON", ["get", "url2", "json"]),
    ("x1.5", ["x1", "5"]),
    ("3.14", ["3", "14"]),
    ("1.2.3", ["1", "2", "3"]),
    ("2nd", ["2", "nd"]),
    ("a_1b", ["a", "1b"]),
    ("___", ["___"]),
    ("_", ["_"]),
    ("__init__", ["init"]),
    ("caféBar", ["caf", "bar"]),
    ("٣٤", ["٣٤"]),
    ("1٢3", ["1", "3"]),
    ("٣.٤", ["٣.٤"]),
    ("HTTPServer", ["httpserver"]),
    ("utf8String", ["utf8", "string"]),
    ("aBcDeF", ["a", "bc", "de", "f"]),
    ("", []),
    ("plain words here", ["plain", "words", "here"]),
]


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_tokenizer_vectors(spark):
    got = _eval(spark, [c[0] for c in TOKEN_CASES], T.tokenize)
    assert got == [c[1] for c in TOKEN_CASES]


def test_tokenize_parts_do_not_join(spark):
    df = spark.createDataFrame([("get", "Value", "x_y")], "a string, b string, c string")
    assert df.select(T.tokenize_parts("a", "b", "c")).first()[0] == ["get", "value", "x", "y"]


def test_split_identifier(spark):
    got = _eval(spark, ["getHTTP_value2Json", "a.b-c", "___"], T.split_identifier)
    assert got == [["get", "HTTP", "value2", "Json"], ["a", "b", "c"], []]


@pytest.mark.parametrize("raw,norm", [
    ("  a \t b\n\nc  ", "a b c"),
    (" x y\u0085", "x y"),
    ("\x1cq\x1fr", "q r"),
    ("", ""),
])
def test_normalize_whitespace(spark, raw, norm):
    assert _eval(spark, [raw], T.normalize_whitespace) == [norm]


def test_strip_keeps_inner_whitespace(spark):
    assert _eval(spark, ["\n  def f():\n    pass \n"], T.strip) == ["def f():\n    pass"]


def test_document_text_skips_empty_sections(spark):
    df = spark.createDataFrame([("f", "", "code"), ("f", "doc", "")], "n string, d string, c string")
    got = [r[0] for r in df.select(T.document_text("n", "d", "c")).collect()]
    assert got == ["f\n\ncode", "f\n\ndoc"]


def test_preview_and_truncate(spark):
    long = "word " * 100
    p = _eval(spark, [long], T.preview)[0]
    assert len(p) == 160 and p.endswith("...")
    assert _eval(spark, ["short   text"], T.preview) == ["short text"]
    code = "x" * 1801
    assert _eval(spark, [code], T.truncate_code) == ["x" * 1800 + "\n# ... truncated ..."]


def test_histogram_bucket_grows_past_four_digits(spark):
    df = spark.createDataFrame([(0,), (49,), (50,), (12345,)], "n long")
    got = [r[0] for r in df.select(T.histogram_bucket("n")).collect()]
    assert got == ["0000-0049", "0000-0049", "0050-0099", "12300-12349"]
