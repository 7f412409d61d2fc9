"""Samples for review against a plain greedy choice over all rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import sampling as S
from corpusloom.operators.ranking import numbered, numbered_within

SUMMARY = "row_id string, arrival long, coverage_cell_key string, seed_candidate_id string, seed_extraction_id string, body_length long, raw_hash string, normalized_hash string, fingerprint string"
COVERAGE = "coverage_cell_key string, planned_target long, actual_ok long, shortage long, coverage_status string"


def world(seed, rows=120, cells=9, seeds=12, lengths=30):
    rng = random.Random(seed)
    summary = [
        (f"r{i:03d}", i, f"c{rng.randrange(cells)}", rng.choice(["", *(f"s{rng.randrange(seeds)}" for _ in range(5))]), f"e{i % 7}", rng.randrange(lengths), f"x{rng.randrange(rows)}", f"n{rng.randrange(rows // 2)}", f"f{rng.randrange(6)}")
        for i in range(rows)
    ]
    coverage = []
    for c in range(cells + 2):
        actual = sum(r[2] == f"c{c}" for r in summary)
        planned = rng.choice([0, 5, 10, 20, 20])
        short = max(0, planned - actual)
        coverage.append((f"c{c}", planned, actual, short, "not_applicable" if planned == 0 else "shortage" if short else "filled"))
    return summary, coverage


def central(members):
    lengths = sorted(m[5] for m in members)
    middle = lengths[len(lengths) // 2]
    return middle, sorted(members, key=lambda m: (abs(m[5] - middle), m[7], m[0]))


def brute_anomalies(summary, coverage, quota):
    groups = {}
    for column, reason in ((6, "raw_exact_duplicate"), (7, "normalized_duplicate"), (3, "shared_source"), (8, "format_concentration")):
        by = {}
        for r in summary:
            by.setdefault(r[column], []).append(r)
        groups[reason] = by
    cases = {}
    for reason in ("raw_exact_duplicate", "normalized_duplicate"):
        cases[reason] = [(min(m[0] for m in g), float(len(g))) for g in groups[reason].values() if len(g) > 1]
        cases[reason].sort(key=lambda c: (-c[1], c[0]))
    short = []
    for key, planned, _, lacking, status in coverage:
        members = [r[0] for r in summary if r[2] == key]
        if status == "shortage" and planned > 0 and members:
            short.append((-lacking / planned, -planned, key, min(members)))
    cases["coverage_shortage"] = [(c[3], -c[0]) for c in sorted(short)]
    largest = max(groups["format_concentration"].values(), key=lambda g: (len(g), -min(m[1] for m in g)), default=None)
    cases["format_concentration"] = [(central(largest)[1][0][0], float(len(largest)))] if largest else []
    cases["shared_source"] = sorted(((min(m[0] for m in g), float(len(g))) for s, g in groups["shared_source"].items() if s and len(g) > 1), key=lambda c: (-c[1], c[0]))
    chosen, why = [], {}
    order = ("raw_exact_duplicate", "normalized_duplicate", "coverage_shortage", "format_concentration", "shared_source")
    for reason in order:
        for row, value in cases[reason]:
            if len(chosen) < quota and row not in why:
                chosen.append((row, reason, value))
                why[row] = reason
    return [(row, reason, value, ",".join(o for o in order if o != reason and any(row == r for r, _ in cases[o]))) for row, reason, value in chosen]


def brute_representatives(summary, coverage, quota, taken, cap=2, relax=5):
    keys = [c[0] for c in sorted(coverage, key=lambda c: (-c[1], -(c[3] / c[1] if c[1] else 0), c[0])) if c[2] > 0]
    out, used, by_cell, by_seed = [], set(taken), {}, {}
    for extra in range(relax + 1):
        for _ in range(2):
            for key in keys:
                members = [r for r in summary if r[2] == key and r[0] not in used]
                if len(out) >= quota or by_cell.get(key, 0) >= cap + extra or not members:
                    continue
                middle, near = central(members)
                row = next((r for r in near if not r[3] or by_seed.get(r[3], 0) < cap + extra), None)
                if row:
                    out.append((row[0], key, float(abs(row[5] - middle))))
                    used.add(row[0])
                    by_cell[key] = by_cell.get(key, 0) + 1
                    by_seed[row[3]] = by_seed.get(row[3], 0) + 1
    return out


@pytest.mark.parametrize(
    ("seed", "shape", "quota"),
    [(1, {}, 25), (2, {"cells": 2, "seeds": 2}, 14), (3, {"lengths": 2}, 30), (4, {"rows": 400, "cells": 3, "seeds": 3, "lengths": 300}, 21), (5, {"rows": 60, "cells": 20}, 60), (6, {"rows": 300, "cells": 2, "lengths": 4, "seeds": 4}, 14)],
)
def test_representatives(spark, seed, shape, quota):
    rows, plan = world(seed, **shape)
    taken = {r[0] for r in rows[:3]}
    summary, coverage = spark.createDataFrame(rows, SUMMARY).cache(), spark.createDataFrame(plan, COVERAGE)
    got = S.representatives(summary, coverage, quota, taken, chunk=4)
    assert [(r["row_id"], r["coverage_cell_key"], r["metric_value"]) for r in got] == brute_representatives(rows, plan, quota, taken)


@pytest.mark.parametrize(("seed", "count"), [(1, 30), (2, 12), (3, 3), (4, 0)])
def test_review_sample(spark, seed, count):
    rows, plan = world(seed)
    summary, coverage = spark.createDataFrame(rows, SUMMARY).cache(), spark.createDataFrame(plan, COVERAGE)
    must = sorted({r[0] for r in rows[seed::40]} | {brute_anomalies(rows, plan, 10)[0][0]})
    forced = spark.createDataFrame([(i, "why") for i in [*must, *must, "unknown"]], "row_id string, reason string")
    files = spark.createDataFrame([(r[0], f"{r[0]}.pdf") for r in rows[::2]], "row_id string, pdf_path string")
    got = [(r.row_id, r.sample_kind, r.reason_code, r.secondary_reasons, r.metric_value, r.sample_rank) for r in S.review_sample(summary, coverage, count, forced, files).orderBy("sample_rank").collect()]
    rest = max(0, count - len(must))
    odd = [c for c in brute_anomalies(rows, plan, min(10, math.ceil(rest * 2 / 3))) if c[0] not in must] if rest else []
    usual = brute_representatives(rows, plan, rest - len(odd), {*must, *(c[0] for c in odd)})
    want = [(i, "mandatory", "classification_disagreement", "", 0.0) for i in must] + [(r, "anomaly", why, others, v) for r, why, v, others in odd] + [(r, "representative", "representative_cell", "", v) for r, _, v in usual]
    have = {r[0] for r in rows[::2]}
    assert got == [(i, kind, why, others if i in have else ",".join(filter(None, (others, "pdf_unavailable"))), v, n) for n, (i, kind, why, others, v) in enumerate(want, 1)]


def test_review_of_nothing(spark):
    summary, coverage = spark.createDataFrame([], SUMMARY), spark.createDataFrame([], COVERAGE)
    assert S.review_sample(summary, coverage, 10).count() == 0


def test_numbers_over_ranges(spark):
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}", (i * 37) % 101) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, g string, v int").repartition(5)
    every = {r.id: r.rank for r in numbered(df, F.asc("v"), F.desc("id")).collect()}
    order = sorted(rows, key=lambda r: (r[2], -r[0]))
    assert every == {r[0]: n for n, r in enumerate(order, 1)}
    within, want, seen = {r.id: r.nth for r in numbered_within(df, "g", F.asc("v"), F.desc("id"), name="nth").collect()}, {}, {}
    for r in order:
        seen[r[1]] = want[r[0]] = seen.get(r[1], 0) + 1
    assert within == want
