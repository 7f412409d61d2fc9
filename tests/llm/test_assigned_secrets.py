"""Unquoted assignments, as in .env files and YAML."""

import pytest

from corpusloom.llm import secrets

HEX = "9c8b1f0e7a6d5c4b3a29181706f5e4d3c2b1a0ff"
MIXED = "qR7tK2mZ9wX4vB8nL1cJ6hG3"
FORMS = [f"export API_TOKEN={HEX}\nnext", f"SERVICE_PASSWORD={MIXED}\nHOME=x", f"db:\n  password: {MIXED}\n  port: 5432", f"token={HEX}", f"export MY_SECRET_PROD={HEX}\nnext"]


@pytest.mark.parametrize("text", FORMS)
def test_the_value_is_the_candidate(text):
    value = HEX if HEX in text else MIXED
    assert [text[a:b] for a, b in secrets.candidates(text.encode())] == [value]


def test_candidates_keep_other_tokens():
    raw = f'id {HEX} token = "{HEX}" padded {"QUJD" * 5}1== end password=abcdefgh/{HEX}'.encode()
    assert [raw[a:b].decode() for a, b in secrets.candidates(raw)] == [HEX, HEX, "QUJD" * 5 + "1==", f"abcdefgh/{HEX}"]


def test_forest_flags_and_redacts_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known, forest = secrets.learn(docs)
    harmless = [f"export CHECKSUM={HEX}\nnext", "API_TOKEN=" + "a" * 20 + "1\nnext"]
    some = spark.createDataFrame(list(enumerate(FORMS + harmless)), "doc_id long, text string").selectExpr("*", "'src0' AS source")
    out = {r.doc_id: r.text for r in secrets.redact_documents(some, known, forest).collect()}
    for i, text in enumerate(FORMS):
        assert out[i] == text.replace(HEX, secrets.REDACTED).replace(MIXED, secrets.REDACTED)
    assert [out[len(FORMS) + i] for i in range(len(harmless))] == harmless
