"""Contracts between stages: edges that the test tables don't reach."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import contracts as C
from corpusloom.operators import writeback as W
from corpusloom.sources import files


def errors(df, key="id"):
    return {r[key]: r.error for r in df.collect()}


# ----------------------------------------------------------------------------------------- renderings


def test_match_renders(spark):
    records = spark.createDataFrame(
        [(1, "s", "d/a.b.pdf", "5", "x"), (2, "s", "d/.hidden", "5", None), (3, "s", "d/c?.hwp", None, None), (4, "s", "d/e.hwp", "5", "x"), (5, "s", "d/f.hwp", "5", "x"), (6, "s", None, "5", "x"), (7, "s", "g", "5", "x"), (8, "t", "other/a.b.hwp", "5", "x")],
        "record_id int, source string, source_path string, clause_no string, subclause_key string",
    )
    renders = spark.createDataFrame(
        [(1, "a.b", "failed", None), (2, "a.b", "ok", "/out/x/a.b.pdf"), (3, ".hidden", "ok_truncated", "/out/h.pdf"), (4, "c_", "ok", "/outer/c.pdf"), (5, "e", "ok", "/out/../e.pdf"), (6, "f", "ok", "/out/f.pdf"), (7, "", "ok", "/out/n.pdf"), (8, "g", "ok", None), (9, "stray", "ok", "/out/s.pdf")],
        "nth int, document_id string, status string, pdf string",
    )
    url = "synthetic://source-generation/"
    rows = spark.createDataFrame([("gen_s", f"{url}a.b/5-x"), ("gen_s", f"{url}a.b/5-x"), ("gen_s", f"{url}.hidden/5-none"), ("s", f"{url}f/5-x")], "source string, source_url string")
    got = {(r.record_id, r.document_id): (r.outcome, r.status, r.body_file_path) for r in W.match_renders(records, renders, rows, "/out").collect()}
    assert got == {
        (1, "a.b"): ("filled", "ok", "x/a.b.pdf"), (2, "hidden"): ("gated", "missing", None), (3, "c_"): ("outside", "ok", None), (4, "e"): ("outside", "ok", None), (5, "f"): ("no row", "ok", None),
        (6, "generated-document"): ("gated", "missing", None), (7, "g"): ("gated", "ok", None), (8, "a.b"): ("no row", "ok", None), (None, "stray"): ("unclaimed", "ok", None), (None, ".hidden"): ("unclaimed", "ok_truncated", None),
    }


def test_mixed_radices_there_and_back(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        radices = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 7))]
        total = 1
        for r in radices:
            total *= r
        rows.append((rng.randrange(total), radices))
    df = spark.createDataFrame(rows, "i long, r array<long>").select("i", "r", W.decoded(F.col("i"), F.col("r")).alias("d"))
    for row in df.withColumn("back", W.encoded(F.col("d"), F.col("r"))).collect():
        digits, rest = [], row.i
        for r in reversed(row.r):
            digits.append(rest % r)
            rest //= r
        assert row.d == digits[::-1] and row.back == row.i


def test_rebuild_frames(spark):
    templates = spark.createDataFrame([("a/가", [["x", "y"], ["p", "q", "r"]])], "template string, axes array<array<string>>")
    doc = '"document":{"contract_version":"1"}'
    records = {
        "fine": '{"template":"a/가","template_version":"v2","seed":3,"case_index":5,%s}' % doc,
        "text": '{"template":"a/가","seed":"0","case_index":" 4 ","response":{"document":{"contract_version":"0.9"}}}',
        "half": '{"template":"a/가","seed":0,"case_index":1.5,%s}' % doc,
        "flag": '{"template":"a/가","seed":0,"case_index":true,%s}' % doc,
        "seed": '{"template":"a/가","case_index":1,%s}' % doc,
        "far": '{"template":"a/가","seed":0,"case_index":6,%s}' % doc,
        "low": '{"template":"a/가","seed":0,"case_index":-1,%s}' % doc,
        "old": '{"template":"a/가","template_version":"v1","seed":0,"case_index":1,%s}' % doc,
        "read": '{"template":"a/가","template_version":"v0","seed":0,"case_index":1,%s}' % doc,
        "none": '{"seed":0,"case_index":1,%s}' % doc,
        "other": '{"template":"a","seed":0,"case_index":1,%s}' % doc,
        "list": '{"template":"a/가","seed":0,"case_index":1,"document":[1]}',
        "lost": '{"template":"a/가","seed":0,"case_index":1,"response":{}}',
        "bad": '{"template":', "null": None,
    }
    df = W.rebuild_frames(spark.createDataFrame(list(records.items()), "name string, record string"), templates, "v2", "1", ("v0",))
    got = {r.name: r for r in df.collect()}
    assert (got["fine"].digits, got["fine"].picked, got["fine"].document_id, got["fine"].older_contract, got["fine"].failure) == ([1, 2], ["y", "r"], "c-track/a/가/seed3-case5", None, None)
    assert (got["text"].picked, got["text"].older_contract, got["text"].failure) == (["y", "q"], "0.9", None) and got["read"].failure is None
    assert {n: r.failure for n, r in got.items() if r.failure} == {
        "half": "no number", "flag": "no number", "seed": "no number", "far": "out of range", "low": "out of range", "old": "old template version",
        "none": "no template", "other": "unknown template", "list": "no document", "lost": "no document", "bad": "malformed", "null": "malformed",
    }


# ------------------------------------------------------------------------------------ decision tables


def test_decision_table_is_complete_and_has_no_dead_rules(spark):
    domains = {"a": ("x", "y"), "b": (True, False)}
    with pytest.raises(ValueError, match="no rule"):
        C.DecisionTable(domains, [({"a": "x"}, "no")])
    with pytest.raises(ValueError, match="decide nothing"):
        C.DecisionTable(domains, [({"a": "x"}, "no"), ({"a": "x", "b": True}, "never"), ({}, None)])
    with pytest.raises(ValueError, match="unknown"):
        C.DecisionTable(domains, [({"a": "z"}, "no"), ({}, None)])
    table = C.DecisionTable(domains, [({"a": "x", "b": False}, "no"), ({"a": ("x", "y"), "b": True}, "so"), ({}, None)])
    rows = spark.createDataFrame([(1, "x", False), (2, "x", True), (3, "y", False), (4, "z", True), (5, None, True), (6, "x", None)], "id int, a string, b boolean")
    assert errors(table.apply(rows)) == {1: "no", 2: "so", 3: None, 4: "unknown a: z", 5: "unknown a: null", 6: "unknown b: null"}


def test_routes(spark):
    plan = "id int, route string, source_class string, evidence string, mode string, source_clause string, source_subclause string, target_class string, target_clause string, target_subclause string, statuses array<string>"
    rows = [
        (1, "source_aligned", "S", "direct_legal_evidence", "source_aligned", "5", "a", "S", "5", "a", []),
        (2, "source_aligned", "S", "direct_legal_evidence", "source_aligned", "5", "a", "S", "5", None, []),
        (3, "source_aligned", "O", "contextual_anchor_only", "source_aligned", None, None, "S", "5", "a", []),
        (4, "mask_restoration", "O", "no_usable_public_source", "counterfactual", None, None, "S", "5", "a", None),
        (5, "administrative_augmented", "O", "contextual_anchor_only", "counterfactual", None, None, "S", None, None, ["초안"]),
        (6, "administrative_augmented", "O", "contextual_anchor_only", "counterfactual", None, None, "S", None, None, []),
        (7, "fully_synthetic", "O", "no_usable_public_source", "source_aligned", None, None, "S", "5", "a", []),
        (8, "anchored", "C", "contextual_anchor_only", "counterfactual", "1", "b", "S", "5", "a", []),
    ]
    assert errors(C.route_errors(spark.createDataFrame(rows, plan))) == {
        1: None, 2: "source_aligned target must exactly match the C/S source label", 3: "source_aligned route requires a C/S source", 4: None, 5: None,
        6: "administrative_augmented route requires an admin-only target", 7: "O source requires generation_mode=counterfactual", 8: "anchored route requires an O source",
    }


# ----------------------------------------------------------------------------------- lineage, presence


def test_attempts(spark):
    rows = [("a", "p", 1, None, []), ("b", "p", 2, "a", ["r"]), ("c", "p", 3, "b", ["r", "s"]), ("d", "p", 4, "c", ["r"]),  # a whole chain
            ("e", "p", 2, "gone", ["r"]), ("f", "p", 3, "e", ["r"]), ("g", "p", 4, "f", ["r"]), ("h", "p", 5, "g", ["r"]), ("i", "p", 6, "h", ["r"]),  # its first link is broken
            ("j", "p", 3, "k", ["r"]), ("k", "p", 2, "j", ["r"]),  # a circle
            ("l", "q", 2, "a", ["r"]), ("m", "p", 4, "b", ["r"]), ("n", "p", 1, None, ["r"]), ("o", "p", 2, "a", []), ("s", "p", 2, "a", ["r", "r"]), ("t", "p", None, None, []),
            ("u", "p", 2, "a", ["r"]), ("u", "p", 2, "a", ["r"]), ("v", "p", 3, "u", ["r"]), ("w", "p", 1, None, None), ("x", "p", 2, "x", ["r"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, sha256 string, plan_sha256 string, attempt_index int, parent_sha256 string, repair_codes array<string>")
    got = {}
    for r in C.attempt_errors(df).collect():
        got.setdefault(r.sha256, set()).add(r.error)
    fine = {k for k, v in got.items() if v == {None}}
    assert fine == {"a", "b", "c", "d", "w"}
    assert all(got[k] == {"broken chain"} for k in "fghiv") and got["e"] == {"unknown parent"} and got["l"] == {"parent of another plan"} and got["m"] == {"parent is not the attempt before"}
    assert got["u"] == {"hash of several attempts"} and got["x"] == {"parent is not the attempt before"} and got["k"] == {"parent is not the attempt before"} and got["j"] == {"broken chain"}
    assert got["t"] == {"attempts count from 1"} and C.attempt_errors(df.limit(0)).count() == 0


def test_presence(spark):
    parts = (*C.COMPLETE, "generation_receipt", "failure")
    schema = "id int, route string, result struct<" + ",".join(f"{p}:string" for p in parts) + ">"
    whole = {p: "x" for p in parts if p != "failure"}
    cases = [
        (whole, "anchored", None), ({**whole, "generation_receipt": None}, "anchored", "source-referenced generation requires a generation receipt"), ({**whole, "generation_receipt": None}, "fully_synthetic", None),
        ({"failure": "x"}, "anchored", None), ({}, None, "successful pipeline result requires classification, generation, validation, and comparison"),
        ({"failure": "x", "source_assessment": "x", "generation_artifact": "x"}, "anchored", "generation artifact requires generation plan"), ({**whole, "failure": "x"}, "anchored", "comparison requires a successful consistency validation"),
    ]
    rows = spark.createDataFrame([(i, route, tuple(c.get(p) for p in parts)) for i, (c, route, _) in enumerate(cases)], schema)
    assert errors(C.presence_errors(rows)) == {i: want for i, (_, _, want) in enumerate(cases)}


# -------------------------------------------------------------------------------------------- phrases


def test_phrases(spark):
    phrases = spark.createDataFrame([("T", 0, "b"), ("T", 1, "a"), ("T", 2, ""), ("S", 0, "c"), ("S", 1, "b")], "owner string, nth int, phrase string").where("phrase <> ''")
    variants = spark.createDataFrame([("S", ["T", "U"]), ("free", None)], "status string, applies_to array<string>")
    overrides = spark.createDataFrame([("S", "a"), ("free", "b")], "status string, phrase string")
    rows = [(1, "T", "S", "a b c"), (2, "T", None, "a b c"), (3, "V", "S", "a b c"), (4, "T", "free", "a b"), (5, "T", "who", "b"), (6, None, None, "a"), (7, "T", "S", None), (8, None, "S", "b")]
    df = spark.createDataFrame(rows, "id int, template_id string, document_status string, body_text string")
    got = {r.id: r.violations for r in C.phrase_violations(df, phrases, variants, overrides).collect()}
    assert got == {1: ["[T/S] c", "[T/S] b", "[T] b"], 2: ["[T] b", "[T] a"], 3: ["[V] S applies to T, U"], 4: ["[T] a"], 5: ["[T] b"], 6: [], 7: [], 8: ["[] S applies to T, U"]}


# --------------------------------------------------------------------------------------------- publish


def test_a_failure_leaves_no_root(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    good = spark.range(5)
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        files.publish({"first": good, "second": bad}, root)
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(files.ContractError, match="not published"):
        files.published(spark, root)
    manifest = files.publish({"first": good, "second": good.limit(0)}, root)
    assert {(r.name, r.rows) for r in manifest.collect()} == {("first", 5), ("second", 0)} and spark.read.parquet(f"{root}/first").count() == 5
    with pytest.raises(files.ContractError, match="published already"):
        files.publish({"first": bad}, root)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    digest = {r.name: r.content_sha for r in manifest.collect()}
    again = files.publish({"first": good.repartition(3).orderBy(F.desc("id"))}, f"file://{tmp_path}/again").first()
    assert again.content_sha == digest["first"]
