"""Registered queries against their SQL, and those without SQL against brute force."""

import hashlib
import re

import pytest
from brute import DATA, SF, brute_bytes, brute_components, brute_words, documents

from corpusloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(name, same):
    same(QUERIES[name], ORACLE[name], SF)


@pytest.mark.parametrize("sf", [SF, f"{DATA}/sf0.01"])
def test_op4(spark, sf):
    got = QUERIES["op4_suffix_array"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(documents(spark, sf))


@pytest.mark.parametrize("sf", [SF, f"{DATA}/sf0.01"])
def test_op6(spark, sf):
    got = QUERIES["op6_phrases"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(documents(spark, sf))


def test_op10(spark):
    docs = documents(spark, f"{DATA}/sf0.01")
    got = QUERIES["op10_simhash"](spark, f"{DATA}/sf0.01").collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == brute_components(docs)


def test_op2_finds_the_planted_tokens(spark):
    rows = QUERIES["op2_secret_scan"](spark, f"{DATA}/sf0.01").collect()
    want = {(i, hashlib.sha256(m.group(1).encode()).hexdigest()) for i, t in documents(spark, f"{DATA}/sf0.01") for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    got = {(r.doc_id, r.value_sha256) for r in rows if r.is_secret}
    assert want and want <= got and len(got - want) <= 0.02 * len(want) + 1


def test_op8_separates_held_out_labels(spark):
    sf = f"{DATA}/sf0.1"
    rows = QUERIES["op8_kneser_ney"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.25
