"""Front selection against the rule in plain Python, at smaller values and at the reference's."""

import math

import pytest

from corpusloom.plans import lines
from corpusloom.plans.dialect import spark_query


def expected(text, threshold, front, tokens):
    items = text.split("\n")
    items = ["INTERNAL DRAFT" if i % 12 == 0 else f"- {i // 12 + 1} -" if i % 12 == 11 else x for i, x in enumerate(items)]
    pages = (len(items) + 11) // 12
    said, kept, page = [], 0, None
    for at in range(0, len(items), 4):
        block, now = items[at : at + 4], at // 12 + 1
        if pages > threshold and now > front:
            break
        trial = said + ([f"[PAGE {now}]"] if now != page else []) + [f"[BLOCK {at // 4}]\n" + "\n".join(block)]
        if pages > threshold and math.ceil(len("\n\n".join(trial)) / 2) > tokens:
            break
        said, kept, page = trial, kept + len(block), now
    state = "full_document" if pages <= threshold else "front_pages" if kept else "context_overflow"
    return kept, len(items), len("\n\n".join(said)), state


@pytest.mark.parametrize("limits", [(3, 2, 10_000), (3, 2, 150), (3, 2, 5), (85, 20, 32_000)])
def test_front_selection(spark, tmp_path, limits):
    texts = ["\n".join(f"line {i} " + "x" * width for i in range(n)) for n, width in ((1, 5), (36, 9), (37, 9), (60, 40), (1020, 300), (1021, 3), (1021, 900), (100, 700))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.kept_lines, r.total_lines, r.kept_chars, r.state) for r in spark_query(lambda d: lines.front_selection(d, *limits))(spark, str(tmp_path)).collect()}
    assert got == {i: expected(t, *limits) for i, t in enumerate(texts)}


def test_the_query_takes_the_references_limits():
    assert (lines.PAGE_THRESHOLD, lines.FRONT_PAGES, lines.FRONT_TOKENS) == (85, 20, 32_000)
