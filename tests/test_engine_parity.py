"""Property test: the Spark text functions and the SQL oracle's versions of
them agree on generated adversarial strings (whitespace classes, Unicode
digits, camelCase, underscores, punctuation)."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans import oracle

ALPHABET = list("aZbY09_ .-\t\n\r\x0b\x0c") + ["\u0085", " ", " ", "　",
                                                "\x1c", "٣", "٤", "๑", "é", "ß",
                                                "HTTP", "Json", "x2", "__"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join), min_size=1, max_size=20))
def test_tokenizer_and_whitespace_match_sql(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["tok"], r["ws"], r["st"]) for r in df.select(
        "i", T.tokenize("t").alias("tok"), T.normalize_whitespace("t").alias("ws"),
        T.strip("t").alias("st")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE x (i INTEGER, t VARCHAR)")
    con.executemany("INSERT INTO x VALUES (?, ?)", list(enumerate(texts)))
    rows = con.execute(f"SELECT i, {oracle.tokenize('t')}, {oracle.normalize_ws('t')}, "
                       f"{oracle.strip('t')} FROM x").fetchall()
    for i, tok, ws, st_ in rows:
        assert got[i] == (list(tok), ws, st_), texts[i]
