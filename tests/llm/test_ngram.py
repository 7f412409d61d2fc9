"""The character model against counts in plain Python, and what it tells apart."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import DATA

from corpusloom.llm import ngram

TRUSTED = ["the cat sat on the mat. the dog sat on the log!", "a cat and a dog, on the mat", "the cat sat on a log", "été à la mer 漢字 😀", "the cat sat on the mat. the dog sat on the log!"]
OTHERS = ["the mat sat on the cat. the log sat on the dog!", "the cat", "idiot", "the  idiot\nsat on the mat", "z", None, " \n", "été, the cat!! 漢 😀😀", "x" * 3000]


def letters(text):
    normal = " ".join((text or "").split())
    return [ngram.START] * (ngram.ORDER - 1) + list(normal + " ") if normal else []


def brute(trusted):
    """character, context -> probability, by the definition."""
    counts = {ngram.ORDER: Counter()}
    for t in trusted:
        w = letters(t)
        counts[ngram.ORDER].update(tuple(w[i - ngram.ORDER + 1 : i + 1]) for i in range(ngram.ORDER - 1, len(w)))
    for k in range(ngram.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {k: ngram.discounts(*(sum(n == j for n in c.values()) for j in (1, 2, 3, 4))) for k, c in counts.items()}
    total, saved = defaultdict(int), defaultdict(float)
    for k, c in counts.items():
        for g, n in c.items():
            total[k, g[:-1]] += n
            saved[k, g[:-1]] += cut[k][min(n, 3) - 1]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        if (k, g[:-1]) not in total:
            return p(g[1:])
        n = counts[k][g]
        return ((n - cut[k][min(n, 3) - 1]) if n else 0) / total[k, g[:-1]] + saved[k, g[:-1]] / total[k, g[:-1]] * p(g[1:])

    return p


def wanted(p, text):
    """(characters, perplexity, peak)"""
    w = letters(text)
    spent = [-math.log(p(tuple(w[i - ngram.ORDER + 1 : i + 1]))) for i in range(ngram.ORDER - 1, len(w))]
    if not spent:
        return 0, None, None
    runs = [sum(spent[max(0, i - ngram.PEAK + 1) : i + 1]) / ngram.PEAK for i in range(len(spent))]
    return len(spent), math.exp(sum(spent) / len(spent)), math.exp(max(runs))


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_perplexities_by_definition(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(ngram, "SLICE_BYTES", 64)
    p = brute(TRUSTED)
    model = ngram.train(spark.createDataFrame([(t,) for t in TRUSTED], "text string"))
    docs = spark.createDataFrame(list(enumerate(TRUSTED + OTHERS)), "doc_id long, text string").selectExpr("*", "'x' AS lang")
    got = {r.key: r for r in ngram.score(docs, model, block_bytes=block_bytes).collect()}
    assert len(got) == len(TRUSTED + OTHERS)
    for i, t in enumerate(TRUSTED + OTHERS):
        n, perplexity, peak = wanted(p, t)
        assert got[i].n_symbols == n
        if n:
            assert got[i].perplexity == pytest.approx(perplexity, rel=1e-9) and got[i].peak == pytest.approx(peak, rel=1e-9)
        else:
            assert got[i].perplexity is None and got[i].peak is None


def test_probabilities_sum_to_one(spark):
    model = ngram.train(spark.createDataFrame([(t,) for t in TRUSTED], "text string"))
    signs = sorted({c for t in TRUSTED for c in letters(t)} | {"Δ"} - {ngram.START})
    for context in ("\x02\x02\x02\x02", "the ", "zzzz", "é à "):
        grams = spark.createDataFrame([(context + c,) for c in signs if c != ngram.START], "gram string")
        assert sum(r.p for r in ngram.probabilities(grams, model).collect()) == pytest.approx(1)


def test_hashes_that_collide(monkeypatch):
    points, size = ngram.points_of(["abcdefgh abcdefgi", "abcd"])
    ends = ngram.places(size)
    want = sorted(ngram.spelled(points, ngram.distinct(points, ends)[0]).to_pylist())
    proper = ngram._codes
    monkeypatch.setattr(ngram, "_codes", lambda p, e: proper(p, e) % np.uint64(4))
    at, n = ngram.distinct(points, ends)
    assert sorted(ngram.spelled(points, at).to_pylist()) == want and "abcde" in want and sum(n) == len(ends)
    found = ngram.Table(points, at).find(points, ends)
    assert ngram.spelled(points, at[found]).equals(ngram.spelled(points, ends))


def test_what_is_gathered_grows_with_the_input(spark):
    docs = spark.range(3_000).selectExpr("concat_ws(' ', transform(sequence(1, 20), i -> hex(xxhash64(id, i)))) AS text")
    few, many = (ngram.train(docs.limit(n)).seen[ngram.ORDER].count() for n in (1_000, 3_000))
    assert many > 1.9 * few > 300_000


def test_toxic_words_raise_the_peak(spark):
    rng = np.random.default_rng(3)
    nouns, verbs = ["cat", "dog", "cow", "hen", "fox"], ["sees", "hears", "likes", "finds"]
    line = lambda: f"the {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} and the {rng.choice(nouns)} {rng.choice(verbs)} it. "
    texts = ["".join(line() for _ in range(5)) for _ in range(300)]
    good = ["".join(line() for _ in range(5)) for _ in range(20)]
    toxic = [t.replace("the ", "the idiot ", 1) for t in good]
    mixed = ["".join(rng.permutation(list(t))) for t in good]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + good + toxic + mixed)], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in ngram.classify(docs, docs.where("doc_id < 300").select("doc_id")).collect()}
    part = lambda k: [rows[300 + 20 * k + i] for i in range(20)]
    assert sum(r.kept for r in part(0)) >= 17
    assert not any(r.kept for r in part(1) + part(2))


def test_labels_never_trained_on(spark):
    """Trusted texts that stay out of training are kept, toxic ones and those of low quality are not."""
    sf = f"{DATA}/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trained = labels.where("quality = 1 AND toxic = 0 AND doc_id % 5 <> 0").select("doc_id")
    rows = ngram.classify(docs, trained).join(labels, "doc_id").where("quality = 0 OR toxic = 1 OR doc_id % 5 = 0").collect()
    share = lambda some: np.mean([r.kept for r in some])
    good, toxic, bad = [r for r in rows if r.quality and not r.toxic], [r for r in rows if r.toxic], [r for r in rows if not r.quality]
    print("kept: good", share(good), "toxic", share(toxic), "bad", share(bad))
    assert share(good) > 0.96 and share(toxic) < 0.5 and share(bad) < 0.15
