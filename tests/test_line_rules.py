"""Lines, contexts, quotes and disclosure rules against plain versions, at their edges."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import context as C
from corpusloom.operators import disclosure as D
from corpusloom.operators import lines as L
from corpusloom.operators import quotes as Q
from corpusloom.sources import files

# ---------------------------------------------------------------------------------------------- lines


def brute_pieces(text, most):
    out = []
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if not line.strip():
            continue
        while len(line) > most:
            window = line[:most]
            cut = max(window.rfind(c) + 1 for c in " \t|.。!?！？;；")
            cut = most if cut < most // 2 else cut
            out.append(line[:cut])
            line = line[cut:]
        if line:
            out.append(line)
    return out


def test_split_long_drops_and_rewrites_nothing(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\r\n　\n", "x" * 50, "abc " * 30, "a\rb\r\nc\n\n d ", "  lead" + "y" * 40 + "; tail. " + "z" * 21]
    texts += ["".join(rng.choice("ab .;\t\n|。") for _ in range(rng.randrange(120))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for most in (20, 21, 4096):
        got = {}
        for r in L.split_long(df, most).orderBy("doc_id", "line_id").collect():
            assert r.line_id == len(got.setdefault(r.doc_id, []))
            got[r.doc_id].append(r.text)
        assert got == {i: p for i, t in enumerate(texts) if (p := brute_pieces(t or "", most))}


def test_boilerplate_and_blank_lines_end_a_segment(spark):
    box = lambda pos: (0, pos * 12, 50, pos * 12 + 10)
    rows = [(1, 1, 0, 1, "a", *box(0), False), (1, 1, 1, 1, "b", *box(1), False), (1, 1, 2, 1, "page 1", *box(2), True), (1, 1, 3, 1, "c", *box(3), None), (1, 1, 4, 1, "　", *box(4), False),
            (1, 1, 5, 2, "d ", *box(5), False), (1, 1, 6, 2, "e", *box(6), False), (1, 1, 7, None, "f", *box(7), False), (1, 1, 8, None, "g", None, None, None, None, False)]
    df = spark.createDataFrame(rows, "doc_id int, page int, pos long, block_id long, text string, x0 long, y0 long, x1 long, y1 long, furniture boolean")
    count = lambda out: sorted((r.first_pos, r.lines) for r in out.collect())
    assert count(L.merge_wrapped(df, "furniture")) == [(0, 2), (3, 1), (5, 2), (7, 1), (8, 1)]
    assert count(L.merge_wrapped(df.where("pos < 8"), within_blocks=False)) == [(0, 8)]


def test_line_context(spark):
    long = "가" * 241
    rows = [(1, i, t) for i, t in enumerate(["one", long, "가" * 240, " three ", None])] + [(2, 0, "alone")]
    got = {(r.doc_id, r.pos): r.context for r in C.line_context(spark.createDataFrame(rows, "doc_id int, pos int, text string")).collect()}
    cut = "가" * 239 + "…"
    assert got[1, 0] == f"[대상] one\n[다음] {cut}\n[다음] {'가' * 240}" and got[2, 0] == "[대상] alone"
    assert got[1, 3] == f"[이전] {cut}\n[이전] {'가' * 240}\n[대상] three\n[다음] "


def brute_context(lines, first, last, budget, ceiling):
    def span(i):
        a = b = i
        if lines[i][1] is not None:
            while a and lines[a - 1][1] == lines[i][1]:
                a -= 1
            while b + 1 < len(lines) and lines[b + 1][1] == lines[i][1]:
                b += 1
        return a, b

    def side(i, step, left):
        out, used = [], 0
        while 0 <= i < len(lines) and used < left:
            a, b = span(i)
            size = sum(len(lines[k][0]) + 1 for k in range(a, b + 1))
            if used + size > left:
                break
            out = [lines[k][0] for k in range(a, b + 1)] + out if step < 0 else out + [lines[k][0] for k in range(a, b + 1)]
            used += size
            i = a - 1 if step < 0 else b + 1
        return out

    a, b = span(first)[0], span(last)[1]
    own = [lines[k][0] for k in range(a, b + 1)]
    rest = max(0, budget - sum(len(t) + 1 for t in own))
    return "\n".join(side(a - 1, -1, rest // 2) + own + side(b + 1, 1, rest - rest // 2))[:ceiling]


def test_budgeted_context(spark):
    rng = random.Random(5)
    docs, rows, anchors, want = {}, [], [], {}
    for d in range(25):
        block, lines = 0, []
        for _ in range(rng.randrange(1, 30)):
            block += rng.random() < 0.5
            lines.append(("t" * rng.randrange(0, 25), None if rng.random() < 0.2 else block))
        docs[d] = lines
        rows += [(d, i, b, t if rng.random() < 0.9 or t else None) for i, (t, b) in enumerate(lines)]
        for _ in range(3):
            first = rng.randrange(len(lines))
            last = min(len(lines) - 1, first + rng.randrange(3))
            anchors.append((d, first, last))
            want[d, first, last] = brute_context(lines, first, last, 60, 90)
    df, asked = spark.createDataFrame(rows, "doc_id int, pos int, block_id int, text string"), spark.createDataFrame(sorted(set(anchors)), "doc_id int, first_pos int, last_pos int")
    assert {(r.doc_id, r.first_pos, r.last_pos): r.context for r in C.budgeted_context(df, asked, budget=60, ceiling=90).collect()} == want


# --------------------------------------------------------------------------------------------- quotes


def test_quotes(spark):
    rows = [("a b  c", "bc", "found", 2), ("　x y\x1cz", "y z", "found", 3), ("aaa", "aa", "ambiguous", None), ("ab ab", "ab", "ambiguous", None), ("abc", "cb", "not found", None), ("abc", " \n", "empty", None), (None, "a", "not found", None),
            ("abc", None, "empty", None), ("1 + (2) = \\E[x]", "(2)=\\E[x]", "found", 4), ("😀 a😀b", "a 😀", "found", 2)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, q string, state string, at int")
    for r in df.select("i", "state", "at", Q.located(F.col("t"), F.col("q")).alias("x")).collect():
        assert (r.x.state, r.x.offset) == (r.state, r.at), r


def test_assertions(spark):
    text = "the clerk Kim earns 500 won; Kim left"
    rows = [(1, "clerk Kim", 1, text, "500", 1, text, "clerkKim earns 500", 1, text), (2, "Kim", 1, text, "500", 1, text, "clerk Kim earns 500", 1, text), (3, "clerk", 1, text, "500", 2, text, "clerk Kim earns 500", 1, text),
            (4, "clerk", 1, text, "500", 1, text, "Kim earns 500", 1, text), (5, "clerk", 1, text, "won", 1, text, "clerk Kim earns", 1, text), (6, "clerk", 9, None, "500", 1, text, "x", 1, text), (7, "clerk", 1, text, " ", 1, text, "clerk", 1, text)]
    df = spark.createDataFrame(rows, "id int, subject_quote string, subject_block int, subject_text string, value_quote string, value_block int, value_text string, link_quote string, link_block int, link_text string")
    assert {r.id: r.error for r in Q.assertion_errors(df).collect()} == {1: None, 2: "subject: ambiguous", 3: "spans of several blocks", 4: "link lacks the subject", 5: "link lacks the value", 6: "subject: unknown block", 7: "value: empty"}


# ----------------------------------------------------------------------------------------- disclosure


def test_commits(spark):
    rows = [("accepted_s", "direct", None), ("accepted_s", "mask_restoration", None), ("accepted_s", "mask_restoration", "rejected"), ("accepted_s", "mask_restoration", "accepted_s"), ("accepted_s", None, None), (None, "direct", "accepted_s"), ("rejected", "direct", "accepted_s")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, r string, v string")
    cols = (F.col("s"), F.col("r"), F.col("v"))
    got = df.orderBy("i").select(D.commits(*cols).alias("a"), D.commits(*cols, weak_masks=True).alias("b")).collect()
    assert [r.a for r in got] == [True, False, False, True, True, False, False] and [r.b for r in got] == [True] * 5 + [False, False]


def test_grade_histories(spark):
    today = date(2024, 6, 30)
    rows = [(i, g, d) for i, (g, d) in enumerate((g, d) for g in ("1급", "2급", "3급", "4급", None) for d in (today, today - timedelta(1), today - timedelta(729), today - timedelta(4000), today + timedelta(9), None) for _ in range(40))]
    df = spark.createDataFrame(rows, "id int, grade string, produced date")
    made = {r.id: r for r in D.grade_histories(df, str(today), 1.0).collect()}
    assert set(made) == {i for i, g, d in rows if g in ("2급", "3급") and d and d < today}
    for i, r in made.items():
        days = (r.changed_on - rows[i][2]).days
        assert 1 <= days <= 730 and r.changed_on <= today and r.old_grade < rows[i][1]
    assert max((r.changed_on - rows[i][2]).days for i, r in made.items()) > 365 and {r.old_grade for i, r in made.items() if rows[i][1] == "3급"} == {"1급", "2급"}
    some = D.grade_histories(df, str(today), 0.2).count()
    assert 0.1 < some / len(made) < 0.3 and D.grade_histories(df, str(today), 0.0).count() == 0


def test_values_of_scenarios(spark):
    born, rrn, tel, acc = "생년월일 실제 값이 없음", "주민등록번호 형식의 합성 값이 없음", "개인 연락처 실제 값이 없음", "계좌번호 실제 값이 없음"
    rows = [(None, "900101-1234567 010-1234-5678", []), (0, "가900101-1234567, 010-1234-5678", [rrn]), (0, "900101-5234567 0101-1234-5678", [rrn, tel]), (1, "1990-01-02 011-123-4567 321-45-678901", []), (1, None, [born, tel, acc]),
            (2, "900101-1234567", ["시나리오 필수 필드 '가구원 현황'가 없음"]), (3, "1890-01-02 검진결과", [born]), (4, "900101-1234567", [acc]), (8, "900101-1234567.", []), (6, "x", [rrn, "시나리오 필수 필드 '인사사항'가 없음"])]
    df = spark.createDataFrame([(i, n, t) for i, (n, t, _) in enumerate(rows)], "i int, n int, t string")
    got = df.orderBy("i").select(D.missing_values(F.col("t"), F.col("n")).alias("m")).collect()
    assert [r.m for r in got] == [want for _, _, want in rows]


def test_agencies(spark):
    pools = spark.createDataFrame([("1", [["a"], [], ["b", "c"]]), ("2", [])], "clause_no string, scenarios array<array<string>>")
    listed = spark.createDataFrame([("1", ["z"]), ("2", ["y"]), ("3", [])], "clause_no string, agencies array<string>")
    rows = [(1, "1", 0), (2, "1", 1), (3, "1", 5), (4, "1", None), (5, "2", 3), (6, "3", 1), (7, None, 1), (8, "1", -1), (9, "9", None)]
    got = {r.id: (r.agency, r.error) for r in D.agencies(spark.createDataFrame(rows, "id int, clause_no string, scenario int"), pools, listed).collect()}
    assert got[1] == ("a", None) and got[2] == ("z", None) and got[3][0] in "bc" and got[4] == ("z", None) and got[5] == ("y", None) and got[8][0] in "bc"
    assert {i: got[i] for i in (6, 7, 9)} == {6: (None, "no agency for clause 3"), 7: (None, "no agency for clause null"), 9: (None, "no agency for clause 9")}


def test_selections(spark):
    candidates = spark.createDataFrame([(1, i, 1 + i // 3, f"b{i}", f'text "{i}"') for i in range(50)] + [(2, 0, 1, "b0", "other")], "doc_id int, pos int, page_number int, block_id string, text string")
    current = spark.createDataFrame([(1, "s", "c", ("v", 40)), (2, "s2", "c", ("v", 40))], "doc_id int, source_sha256 string, config_sha256 string, config struct<version:string,most:int>")
    ask = lambda *rows: {r.doc_id: r for r in D.finalized_selections(spark.createDataFrame(list(rows), "doc_id int, source_sha256 string, config_sha256 string, block_ids array<string>"), current, candidates).collect()}
    one = ask((1, "s", "c", ["b7", "b2", "b7", "b0"]), (2, "s", "c", ["b0"]), (3, "s", "c", ["b0"]))
    assert (one[1].error, one[1].block_ids, one[1].pages) == (None, ["b0", "b2", "b7"], [1, 3]) and one[2].error == "source changed" and one[3].error == "unknown document"
    assert one[1].selection_sha256 == ask((1, "s", "c", ["b0", "b2", "b7"]))[1].selection_sha256 != ask((1, "s", "c", ["b0", "b2"]))[1].selection_sha256
    two = ask((1, "s", "d", ["b0"]), (2, "s2", "c", []))
    assert two[1].error == "selection config changed" and two[2].error == "no usable blocks" and two[2].selection_sha256 is None
    assert ask((1, "s", "c", [f"b{i}" for i in range(41)]))[1].error == "selected 41 blocks; maximum is 40" and ask((1, "s", "c", ["b1", "q", "p"]))[1].error == "unknown block IDs: p, q"
    assert ask((1, "s", "c", None))[1].error == "no usable blocks"


def test_deletion_targets_and_weights(spark):
    rows = [("/d/a.pdf", b"%PDF"), ("/d/b.PDF", b"\n<!DOCTYPE HTML>"), ("/d/c.hwp", b"x" * 250 + b"<html"), ("/d/d.hwp", b"x" * 252 + b"<html"), ("/d/e.xlsx", b""), ("/d/f", b""), ("/d/.hwp", b""), ("/d/g.jsonl", b""), ("/d/.DS_Store", b""), ("/d/extracted/h.txt", b"")]
    got = {r.path: r.reason for r in files.deletion_targets(spark.createDataFrame(rows, "path string, content binary"), "/d/").collect()}
    assert got == {"/d/b.PDF": "stub", "/d/c.hwp": "stub", "/d/e.xlsx": "suffix", "/d/f": "suffix", "/d/.hwp": "suffix"}
    assert files.parse_weights(None, "ab") == {"a": 0.5, "b": 0.5} and files.parse_weights('{"a": 1, "b": "2"}', "ab") == {"a": 1.0, "b": 2.0}
    for bad, said in (("[1]", "object"), ('{"a": 1}', "missing"), ('{"a": 1, "b": 1, "c": 1}', "unknown")):
        with pytest.raises(files.ContractError, match=said):
            files.parse_weights(bad, "ab")


def test_form_levels(spark):
    every = [(f, s) for f in D.NATIVE_SUBCLAUSES for s in D.TARGET_SUBCLAUSES]
    assert len(every) == 272 and not any(set(D.NATIVE_SUBCLAUSES[f]) & set(D.CONFLICTING_SUBCLAUSES[f]) for f in D.NATIVE_SUBCLAUSES)
    got = {(r.document_form, r.subclause): (r.level, r.error) for r in D.form_levels(spark.createDataFrame([*every, ("x", "cornering"), ("report", "life_body"), (None, None)], "document_form string, subclause string")).collect()}
    assert got["report", "security_diagnosis"] == ("conflict", None) and got["bid_material", "unit_cost"] == ("native", None) and got["other", "cornering"] == ("bridge", None)
    assert got["x", "cornering"] == (None, "unknown form: x") and got["report", "life_body"] == (None, "unsupported subclause: life_body") and got[None, None] == (None, "unknown form: null")
    assert {level: sum(g == (level, None) for g in got.values()) for level in ("native", "conflict", "bridge")} == {"native": sum(map(len, D.NATIVE_SUBCLAUSES.values())), "conflict": sum(map(len, D.CONFLICTING_SUBCLAUSES.values())), "bridge": 272 - sum(map(len, (*D.NATIVE_SUBCLAUSES.values(), *D.CONFLICTING_SUBCLAUSES.values())))}
