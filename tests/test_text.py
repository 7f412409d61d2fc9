"""Normalisation against plain Python."""

import re
import unicodedata

from pyspark.sql import functions as F

from corpusloom.functions import text as X

CASES = ["", None, "a", " a \t b ", "a\r\nb\rc", "\n\n a\n\n\n\nb \n \n", "제9조 제10조 2024-01-02 제2024-12호 12명", "총무과-123(2024) 010-1234-5678", "2023가합123 1,234,567 원 3억 원", "x" * 50_000, "é é"]


def canonical(t):
    lines = [re.sub(r"[ \t ]+", " ", x.strip()) for x in (t or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")


def test_canonical(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", X.canonical(F.col("t")).alias("c")).collect()}
    assert [got[i] for i in range(len(CASES))] == [canonical(t) for t in CASES]


def test_placeholders_both_forms(spark):
    df = spark.createDataFrame([("제9조 제10조 제123항 5 2024-01-02 3억 원",)], "t string")
    row = df.select(X.with_placeholders(F.col("t")).alias("c"), X.with_placeholders(F.col("t"), "strict").alias("s")).first()
    assert row.c == "제9조 제<NUM>0조 제<NUM>3항 <NUM> <DATE> <MONEY>"
    assert row.s == "제9조 제10조 제123항 <NUM> <DATE> <MONEY>"


def test_nfc(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, t string")
    got = {r.i: r.t for r in X.to_nfc(df, "t").collect()}
    assert got == {i: t and unicodedata.normalize("NFC", t) for i, t in enumerate(CASES)}


def test_safe_stem(spark):
    df = spark.createDataFrame([("a/b:c.pdf",), (" .. ",), (None,), ("x .pdf",)], "t string")
    assert [r[0] for r in df.select(X.safe_stem(F.col("t"), F.lit("doc"))).collect()] == ["a_b_c", "doc", "doc", "x"]


def test_buckets(spark):
    df = spark.range(0, 13)
    got = [r[0] for r in df.select(X.bucket(F.col("id"), (2, 5, 10))).orderBy("id").collect()]
    assert got == ["0", "0-2", "0-2", "3-5", "3-5", "3-5", "6-10", "6-10", "6-10", "6-10", "6-10", "11+", "11+"]
