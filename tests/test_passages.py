"""Furniture, masks, candidates, cells and names at their edges."""

import random
import re

from pyspark.sql import functions as F

from corpusloom.operators import passages as P


def brute_furniture(lines):
    """lines: (page, text, x0, y0) of one document."""
    number = lambda t: bool(re.fullmatch(r"[\-‐‑‒–—−－]?\s*[0-9ivxlcdmIVXLCDM]+\s*[\-‐‑‒–—−－]?", t.strip()))
    pages = len({p for p, *_ in lines})
    placed = any(x is not None and y is not None for _, _, x, y in lines)
    groups = {}
    for page, text, x, y in lines:
        text = text or ""
        if placed and (x is None or y is None):
            continue
        key = (round(x), round(y)) if placed else "#" if number(text) else text
        groups.setdefault(key, []).append((page, text))
    good = set()
    for key, members in groups.items():
        seen, texts = len({p for p, _ in members}), [t for _, t in members]
        steady = max(map(texts.count, texts)) / len(texts) >= 0.8 or sum(map(number, texts)) / len(texts) >= 0.8
        if seen >= 3 and seen / pages >= 0.3 and (steady or not placed):
            good.add(key)
    out = []
    for _, text, x, y in lines:
        key = ((round(x), round(y)) if x is not None and y is not None else None) if placed else "#" if number(text or "") else text or ""
        out.append(key in good)
    return out


def test_furniture_by_place_or_by_text(spark):
    rng = random.Random(2)
    docs = {}
    for d in range(30):
        lines = []
        for page in range(rng.randrange(1, 9)):
            for _ in range(rng.randrange(1, 7)):
                place = rng.choice([(10.5, 20.4), (10.4, 20.6), (50.0, 700.2), (rng.random() * 400, 9.0), (None, 3.0)]) if d % 3 else (None, None)
                lines.append((page, rng.choice(["head", "- 3 -", " iv ", "text", "other", "", None, "3 of 4"]), *place))
        docs[d] = lines
    rows = [(d, i, *line) for d, lines in docs.items() for i, line in enumerate(lines)]
    got = {(r.doc_id, r.i): r for r in P.marked_furniture(spark.createDataFrame(rows, "doc_id int, i int, page int, text string, x0 double, y0 double")).collect()}
    assert len(got) == len(rows)
    for d, lines in docs.items():
        assert [got[d, i].is_boilerplate for i in range(len(lines))] == brute_furniture(lines), d
    dirty = spark.createDataFrame([(1, 1, "a\x07b\tc", 1.0, 2.0)], "doc_id int, page int, text string, x0 double, y0 double")
    assert P.marked_furniture(dirty).first().cleaned_text == "ab\tc" and P.marked_furniture(dirty.limit(0)).count() == 0


def test_mask_slots(spark):
    def brute(text):
        m = re.search(r"\*{2,}|○{2,}|●{2,}", text)
        if not m:
            return None
        start = max(0, m.start() - 30)
        said = text[start : start + 60].replace("\n", " ").strip()
        return ("…" if start > 0 else "") + said + ("…" if start + 60 < len(text) else "")

    texts = ["no mask * ○ ●", "**", "a" * 29 + "○○", "a" * 31 + "●●●" + "b" * 40, "x\n**\ny", " " * 40 + "**" + " " * 40, "가" * 100 + "*○○" + "나" * 100, "", "○●" * 9]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(P.mask_slot(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [brute(t) for t in texts]


def test_revalidated(spark):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = [("d", "e1", 1, 1, "one", False), ("d", "e1", 2, 1, "two ", False), ("d", "e1", 3, 1, "three", False), ("d", "e1", 4, 2, "four", False), ("d", "e1", 5, 2, "foot", True), ("d", "e1", 6, 2, "twin", False), ("d", "e1", 6, 2, "twin", False)]
    cases = [
        (("a", "d", "e1", [1, 2, 3], "one two three", None, 1), None), (("b", "d", "e1", [3, 1], "three one", None, 1), None), (("c", "d", "e1", [1, 1], "one one", None, 1), None), (("e", "d", "e1", [1, 3], "one  three", None, 1), "line text differs"),
        (("f", "d", "e1", [3, 4], "three four", None, 1), "page differs"), (("g", "d", "e1", [4, 5], "four foot", None, 2), "boilerplate line"), (("h", "d", "e1", [6], "twin", None, 2), "line_id twice"), (("i", "d", "e1", [9], "x", None, 1), "lines not found"),
        (("j", "d", "e0", [1], "one", None, 1), "stale extraction_id"), (("k", "q", "e1", [1], "one", None, 1), "no extraction"), (("l", "d", "e1", [1], "one", "bad", 1), "text_sha256 differs"), (("m", "d", "e1", [], "one", None, 1), "no line_ids"),
        (("n", "d", "e1", None, "one", None, 1), "no line_ids"), ((None, "d", "e1", [1], "one", None, 1), "no candidate_id"), (("o", "d", "", [1], "one", None, 1), "no extraction_id"), (("p", "d", "e1", [1], None, "x", 1), "no text"),
    ]
    rows = [(i, *(c[:5]), c[5] or (sha(c[4]) if c[4] is not None else None), c[6]) for i, (c, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, candidate_id string, doc_id string, extraction_id string, line_ids array<int>, text string, text_sha256 string, page int")
    known = spark.createDataFrame(lines, "doc_id string, extraction_id string, line_id int, page int, cleaned_text string, is_boilerplate boolean")
    assert {r.i: r.error for r in P.revalidated(df, known).collect()} == {i: want for i, (_, want) in enumerate(cases)}


def test_cells(spark):
    found = spark.createDataFrame([("5", "a", "report", "d1"), ("5", "a", "report", "d1"), ("5", "a", "report", "d2"), ("5", "b", "other", "d1"), ("5", "a", "plan", "d3")], "clause_no string, subclause string, doc_type string, doc string")
    statuses = spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d1", "y"), ("d2", "x"), ("d9", "z")], "doc string, status string")
    cells = spark.createDataFrame([("5", "a", "report"), ("5", "b", "other"), ("5", "a", "plan"), ("7", "a", "plan")], "clause_no string, subclause string, doc_type string")
    got = {(r.clause_no, r.subclause, r.doc_type): (r.state, r.span_candidates, r.matching_docs, r.by_status) for r in P.cell_measures(found, statuses, cells, ("report", "plan")).collect()}
    assert got == {("5", "a", "report"): ("counted", 3, 2, {"x": 2, "y": 1}), ("5", "b", "other"): ("no_rule", 1, 1, None), ("5", "a", "plan"): ("zero_matches", 1, 1, None), ("7", "a", "plan"): ("zero_matches", 0, 0, None)}


def test_names(spark):
    rows = [(1, "[합성] (초안) 계획"), (2, "계획 (안) — 1"), (3, "계획 — 1"), (4, "  .._-  "), (5, None), (6, "a" * 119 + ".b"), (7, "계획 안 – 1"), (8, "가\t나　다!?"), (9, "()"), (10, "[a")]
    named = {r.id: r for r in P.file_names(spark.createDataFrame(rows, "id int, title string")).withColumn("bare", P.without_label(F.col("title"))).collect()}
    assert [named[i].file_name for i in range(1, 11)] == ["합성_초안_계획", "계획_안_-_1", "계획_-_1", "4", "5", "a" * 119, "계획_안_-_1_2", "가_나_다", "9", "a"]
    assert named[1].bare == "계획" and named[2].bare == "계획 (안) — 1" and named[9].bare == "" and named[10].bare == "[a" and named[5].bare == ""
    ids = spark.range(2000)
    share = ids.where(P.chosen(F.col("id"), 3, 0.3)).count() / 2000
    assert 0.25 < share < 0.35 and ids.where(P.chosen(F.col("id"), 3, 0)).count() == 0 == ids.where(P.chosen(F.col("id"), 3, -1.0)).count()
    assert ids.where(P.chosen(F.col("id"), 3, 1.01)).count() == 2000


def test_texts_of_candidates_are_exchanged_with_their_lines_only(spark):
    rows = spark.createDataFrame([("a", 1, "e", [1, 2], "x y", "0", 1)] * 2, "candidate_id string, doc_id int, extraction_id string, line_ids array<int>, text string, text_sha256 string, page int")
    now = spark.createDataFrame([(1, "e", 1, 1, "x", False), (1, "e", 2, 1, "y", False)], "doc_id int, extraction_id string, line_id int, page int, cleaned_text string, is_boilerplate boolean")
    done = P.revalidated(rows.withColumn("text_sha256", F.sha2("text", 256)), now)
    assert [r.error for r in done.collect()] == [None, None]
    plan = done.select("candidate_id", "error")._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "_said" in plan and "line_ids" not in plan.split("Join", 1)[1].split("\n", 1)[0]
