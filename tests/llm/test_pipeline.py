"""The pipeline's stages, each on the rows that the one before kept, against what brute force keeps."""

import re

from brute import SF, brute_components

import corpus_pipeline as P


def kept_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_stages(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(stage(spark, steps[-1], SF).cache())
        if name != "mix_sources":
            assert steps[-1].columns == columns
    rows = [[r.asDict() for r in s.collect()] for s in steps]
    # near-duplicates: the smallest id of every component
    components = brute_components([(r["doc_id"], r["text"] or "") for r in rows[1]])
    assert {r["doc_id"] for r in rows[2]} == {c for _, _, c in components}
    # decontamination: windows of ten words, shorter items whole
    windows = set()
    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = kept_words(item.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    dirty = {r["doc_id"] for r in rows[2] if any(tuple(w[i : i + n]) in windows for w in [kept_words(r["text"])] for n in sizes for i in range(len(w) - n + 1))}
    assert {r["doc_id"] for r in rows[3]} == {r["doc_id"] for r in rows[2]} - dirty
    # secrets: gone from the texts, documents stay
    assert {r["doc_id"] for r in rows[4]} == {r["doc_id"] for r in rows[3]}
    assert not [r for r in rows[4] if re.search(r'(?i)token = "[0-9a-f]{40}"', r["text"])]
    # mixing: near the targets
    total = {}
    for r in rows[5]:
        total.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(taken - target) <= 1 for taken, target in total.values())


def test_awkward_documents_pass_all_stages(spark, odd):
    for table in (odd, odd.limit(0)):
        docs = table
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_run(spark):
    assert P.run(spark, SF).count() > 0
