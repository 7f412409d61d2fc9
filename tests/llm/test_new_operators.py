"""Alignment, resampling and near-duplicate vectors against brute force, with awkward rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import DATA
from brute_align import brute_alignment

from corpusloom.llm import align, embeddings, resample
from corpusloom.llm.queries import QUERIES


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


def texts(rows):
    return sorted((tuple(map(str, r)) for r in rows), key=str)


# ------------------------------------------------------------------------------------------- alignment

TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<|endoftext|> <s> </s> <unk>"), (6, "  two  spaces\n\n\ttabs \r\n"), (7, "x" * 5000), (8, "日本語のテキスト " * 50),
    (9, "é" * 80), (9, "a\x00b"), (None, "null key here it's we'll"), (10, "ﬁ ½ ① Ａ"), (11, "👩‍👩‍👧 emoji"), (12, "abc def"), (12, "abc def"), (13, "　wide nbsp   x"),
]


def test_op11(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute_alignment([(r.doc_id, r.text) for r in docs])
    got = QUERIES["op11_alignment"](spark, f"{DATA}/sf0.001").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256")
    assert rows_of(got) == texts(want)


@pytest.mark.parametrize("limits", [{}, {"slice_size": 10, "block_bytes": 300}])
def test_alignment_of_awkward_texts(spark, limits):
    # extra columns whose names the operator uses inside
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in TEXTS], "doc_id long, text string, block int, pair string, key int")
    want, parts = brute_alignment(TEXTS)
    assert rows_of(align.alignments(df, **limits)) == texts(want)
    assert rows_of(align.token_links(df)) == texts((p[0], *link) for p in parts for link in p[3])
    shared = align.token_links(df, shared=True).drop("n_bytes")
    assert rows_of(shared) == texts((p[0], i, j, p[1][i], p[2][j]) for p in parts for left, right in p[4] for i in left for j in right)


def test_alignment_of_nothing(nothing):
    assert align.alignments(nothing).count() == 0 and align.token_links(nothing).count() == 0


def test_stretches_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(align, "STRETCH", 200)
    coders = align._coders(align.FOLDER, align.FILE_A, align.FILE_B)
    text = " ".join(f"word{i % 37} it's, 12{i}" for i in range(400)) + "\n\n  end"
    (whole,), (cut,) = (align._measure([text], coders, size) for size in (1 << 20, 20))
    assert [x.tolist() if hasattr(x, "tolist") else x for x in whole.settle()] == [x.tolist() if hasattr(x, "tolist") else x for x in cut.settle()]
    assert whole.numbers.tolist() == cut.numbers.tolist()


@pytest.mark.parametrize("expanded", [1, 7, 1 << 20])
def test_product_of_sparse_matrices(expanded):
    rng = np.random.default_rng(2)
    x, y = rng.random((20, 30)) < 0.2, rng.random((30, 25)) < 0.3
    a, b = (align.Rows(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1]) for m in (x, y))
    found = np.zeros((20, 25), int)
    for i, j, n in align.product(a, b, expanded):
        found[i, j] += n
    assert (found == x.astype(int) @ y.astype(int)).all()
    back = align.transposed(align.transposed(a))
    assert back.start.tolist() == a.start.tolist() and back.at.tolist() == a.at.tolist()


# ------------------------------------------------------------------------------------------ resampling


def brute_resample(docs, targets, order=1, percent=10, least=20, buckets=10_000, seed=2024):
    def words(text):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if ord(c) > 127 or c.isalnum() else " " for c in text or "").split(" ")

    def features(text):
        w = [x for x in words(text) if x]
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, order + 1) for i in range(len(w) - n + 1)]

    own, goal = [features(t) for _, t in docs], [features(t)[1] for t in targets]
    s, t = Counter(b for _, f in own for b in f), Counter(b for f in goal for b in f)
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for (i, _), (n, f) in zip(docs, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    pool = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(pool[: percent * len(pool) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("order", [1, 3])
def test_resampling(spark, odd, nothing, order, monkeypatch):
    monkeypatch.setattr(resample, "KNOWN_WORDS", 50)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    goal = [None, "w1 w2 w3 alpha BETA", "é w100"]
    targets = spark.createDataFrame([(t, 1) for t in goal], "text string, n int")
    for percent, least in ((10, 20), (50, 0), (100, 1), (0, 20)):
        got = resample.resample(odd, targets, order=order, percent=percent, min_words=least, cuts=2)
        assert rows_of(got) == texts(brute_resample(docs, goal, order, percent, least))
    assert resample.resample(nothing, targets).count() == 0
    assert rows_of(resample.resample(odd, targets.limit(0))) == texts(brute_resample(docs, []))


def test_resampling_with_ties(spark):
    # one id and text holds most rows; others tie in nothing but their weight
    docs = [(5, "one two three")] * 300 + [(None, "four five six")] * 100 + [(i, "one two three") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    targets = spark.createDataFrame([("two",)], "text string")
    for percent in (3, 50, 95):
        got = resample.resample(df, targets, percent=percent, min_words=1)
        assert rows_of(got) == texts(brute_resample(docs, ["two"], percent=percent, least=1))


def test_features_over_slices():
    raw = ("Ab cd, ef-gh " * 40 + "ij").encode()
    for order in (1, 2, 3):
        whole = Counter(f for _, found in resample._features(raw, order) for f in found)
        cut = Counter(f for _, found in resample._features(raw, order, size=5) for f in found)
        assert whole == cut


# -------------------------------------------------------------------------------- near-duplicate vectors


def brute_vectors(rows, threshold=0.95):
    n = len(rows)
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = [np.array(v, float) if f else None for (_, v), f in zip(rows, fine)]
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if fine[i] and fine[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] / (math.sqrt(x[i] @ x[i]) * math.sqrt(x[j] @ x[j])) >= threshold:
                near[i].append(j)
                near[j].append(i)
    seen, out = set(), []
    for first in range(n):
        if first in seen:
            continue
        seen.add(first)
        members = [first]
        for i in members:
            new = [j for j in near[i] if j not in seen]
            seen.update(new)
            members += new
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[i][0], len(near[i]), least, rows[i][0] == least) for i in members]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base, rows = rng.normal(size=(40, 24)), []
    single = lambda v: [float(x) for x in v.astype(np.float32)]
    for i in range(400):
        rows.append((i, single(base[i % 40] + rng.normal(size=24) * rng.choice([0.02, 0.15, 0.25, 0.32, 1]))))
    rows += [(i, single(base[0] + rng.normal(size=24) * 0.1)) for i in range(400, 550)]  # a dense region
    rows += [(i, rows[5][1]) for i in range(550, 650)]  # copies
    rows += [(650, None), (651, []), (652, [0.0] * 24), (653, [math.nan] * 24), (654, [1.0, None] + [0.0] * 22), (655, [1.0] * 5), (656, [2.0] * 5), (657, [1.0] * 5 + [0.0] * 19)]
    return rows + [(None, rows[3][1]), (None, [-9.0] + [0.0] * 23), (7, rows[7][1]), (658, [math.inf] + [1.0] * 23), (659, [0.0] * 23 + [-0.0]), (660, [-x for x in rows[5][1]])]


@pytest.mark.parametrize("limits", [{}, {"tile": 50}, {"tile": 50, "max_tiles": 4, "visitors": 200}, {"tile": 1000, "visitors": 100}])
def test_near_vectors(spark, vectors, limits):
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors], "vec_id long, embedding array<float>, node int, digest string").repartition(5)
    assert rows_of(embeddings.near_vectors(df, **limits)) == texts(brute_vectors(vectors))


def test_near_vectors_of_doubles_and_of_nothing(spark, vectors):
    rows = [r for r in vectors if r[1] is None or len(r[1]) in (0, 24)][::5]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(embeddings.near_vectors(df, threshold=0.9)) == texts(brute_vectors(rows, 0.9))
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    assert [tuple(r) for r in embeddings.near_vectors(df.limit(1)).collect()] == [(rows[0][0], 0, rows[0][0], True)]


def test_pairs_at_the_threshold(spark):
    # cosines of 0.95 give or take the last bits of doubles are decided on the given vectors
    rows = [(0, [1.0] + [0.0] * 15)] + [(i, [0.95 + k * 2**-52, math.sqrt(1 - 0.95**2)] + [0.0] * 14) for i, k in enumerate(range(-3, 4), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(embeddings.near_vectors(df)) == texts(brute_vectors(rows))
