"""Candidates on small fixtures: what is kept, and that nothing is left out."""

import pytest

from corpusloom.plans import candidates
from corpusloom.plans.dialect import spark_query

LINES = "(SELECT * FROM {documents})"


@pytest.fixture
def lines(spark, tmp_path, monkeypatch):
    """lines(rows of (line_key, doc, text), plan) -> rows of the plan over these lines"""
    monkeypatch.setattr(candidates, "korean_lines", lambda d: LINES)

    def run(rows, plan):
        spark.createDataFrame(rows, "line_key long, doc long, text string").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        return spark_query(plan)(spark, str(tmp_path)).collect()

    return run


def test_the_best_sixty_candidates_stay(lines):
    rows = [(i, 1, "재개발 토지보상" if i % 5 == 0 else "재개발") for i in range(90)] + [(1000 + i, 2, "재개발") for i in range(12)]
    got = [r for r in lines(rows, candidates.ranked_candidates) if r.clause == "8"]
    assert sum(r.doc == 2 for r in got) == 12
    first = sorted((r for r in got if r.doc == 1), key=lambda r: r.place)
    assert [r.place for r in first] == list(range(1, 61))
    assert [r.line_key for r in first[:18]] == list(range(0, 90, 5))
    order = [(-r.match_score, r.line_key) for r in first]
    assert order == sorted(order)


def test_reasons_come_from_every_line_with_evidence(lines):
    rows = [(1, 1, "입찰 하나"), (2, 1, "날씨"), (3, 1, "입찰 둘"), (4, 1, "재건축 " + "x" * 200), (5, 1, "입찰 셋"), (6, 1, "입찰 넷"), (7, 2, "날씨")]
    got = {(r.doc, r.clause): r.reason for r in lines(rows, candidates.withholding_reasons)}
    assert got == {(1, "5"): "제5호: 입찰 하나; 입찰 둘; 입찰 셋", (1, "8"): "제8호: " + ("재건축 " + "x" * 200)[:120]}


def test_stages_and_inheritance_of_every_row(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert candidates.QUERIES["stage_cases"](spark, sf).count() == 3 * n
    assert candidates.QUERIES["ref_inheritance"](spark, sf).count() == n


def test_short_turns_have_a_state(spark, tmp_path):
    from corpusloom.plans import lines as L

    rows = [(1, 0, "short"), (1, 1, None), (1, 3, " ".join(f"word{i}" for i in range(20)))]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.turn: r.state for r in L.QUERIES["evidence_quotes"](spark, str(tmp_path)).collect()}
    assert got == {0: "too_short", 1: "too_short", 3: "found"}


def test_status_rules_of_all_types(lines):
    from corpusloom.sources.dims import STATUS_RULES

    assert (len(STATUS_RULES), sum(map(len, STATUS_RULES.values()))) == (23, 68)
    rows, want = [], set()
    for doc, rules in enumerate(STATUS_RULES.values()):
        for status, words in rules:
            for word in words:
                rows.append((len(rows), doc, word))
                want |= {(doc, len(rows) - 1, s) for s, w in rules if any(x in word for x in w)}
    assert {(r.doc, r.line_key, r.status) for r in lines(rows, candidates.status_candidates)} == want
    cells = lines(rows, candidates.cell_measures)
    assert len(cells) == 68 and all(r.documents == 1 and r.state == "counted" for r in cells)


def test_evidence_in_one_pass(spark):
    from corpusloom.operators.evidence import keyword_evidence
    from corpusloom.sources.dims import CLAUSE_WORDS, NOT_COUNTED

    def brute(text, clause):
        def hit(w):
            said = text
            for phrase in sorted(NOT_COUNTED.get((clause, w), ()), key=len, reverse=True):
                said = said.replace(phrase, "")
            return w in said

        found = [w for w in CLAUSE_WORDS[clause] if hit(w)]
        own = [w for w in found if not any(o != w and w in o for o in found)]
        return ",".join(own), sum(min(4, 2 + len(w) // 4) for w in own)

    texts = ["무기계약직 채용", "계약직과 수의계약", "종합감사 감사드립니다", "감사와 감사드립니다", "납품단가 1,000원", "", None, "택지개발 택지", "3억 원", "x"] + ["".join(pair) for pair in zip(sum(CLAUSE_WORDS.values(), ()), reversed(sum(CLAUSE_WORDS.values(), ())))]
    got = {}
    for r in keyword_evidence(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).collect():
        got[r.id, r.clause] = (r.words, r.score - r.money)
        assert r.words or r.money
    for i, text in enumerate(texts):
        for clause in CLAUSE_WORDS:
            words, score = brute(text or "", clause)
            assert got.get((i, clause), ("", 0)) == (words, score), (text, clause)


def test_one_pass_gives_what_the_plans_give(spark, tmp_path, monkeypatch):
    from corpusloom.sources.dims import STATUS_RULES

    monkeypatch.setattr(candidates, "korean_lines", lambda d: LINES)
    words = [word for rules in STATUS_RULES.values() for _, said in rules for word in said] + [word for said in candidates.CLAUSE_WORDS.values() for word in said]
    rows = [(i, i % 40, f"{word} {words[(7 * i) % len(words)]} {'3억 원' if i % 3 == 0 else ''}") for i, word in enumerate(words * 3)]
    rows += [(100000 + i, 41, " ".join(words)) for i in range(70)] + [(200000, 42, None), (200001, 42, "x"), (200002, 43, "입찰 " + "y" * 200)]
    spark.createDataFrame(rows, "line_key long, doc long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("status_candidates", "cell_measures", "withholding_reasons"):
        got = candidates.QUERIES[name](spark, str(tmp_path))
        want = spark_query(candidates.PLANS[name])(spark, str(tmp_path))
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())), name
        assert got._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1, name
