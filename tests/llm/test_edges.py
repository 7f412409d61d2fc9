"""Awkward tables through every operator: defined results, nothing crashes."""

import hashlib
import io
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from brute import brute_bytes, brute_components, brute_words
from pyspark.sql import functions as F

from corpusloom.llm import chat, decontam, mixing, ngram, phrases, quality, secrets, simhash, suffix, warc
from corpusloom.llm._graph import components
from corpusloom.llm._store import fresh_path

BIG = (1 << 63) - 1


def distinct_ids(odd):
    """The awkward documents without shared or null ids."""
    return odd.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min_by("text", F.col("n_chars")).alias("text"))


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_suffix_and_phrases(odd, nothing):
    df = distinct_ids(odd)
    got = suffix.repeated_bytes(df).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(pairs(df))
    got = phrases.repeated_words(df).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(pairs(df))
    for op in (suffix.repeated_bytes, phrases.repeated_words):
        assert op(nothing).count() == 0
        rows = op(odd).collect()
        assert len(rows) == odd.count()
        late = [r for r in rows if r.doc_id is None]  # a null id comes after all ids, so its copy goes
        assert sorted(r.n_removed > 0 for r in late) == [False, True]


def test_repeats_when_every_anchor_is_hot(odd):
    import dataclasses

    df = distinct_ids(odd)
    got = suffix.repeated_bytes(df, plan=dataclasses.replace(suffix.PLAN, hot=2)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(pairs(df))
    got = phrases.repeated_words(df, plan=dataclasses.replace(phrases.PLAN, hot=2)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(pairs(df))


def test_suffix_array_by_induced_sorting():
    rng = np.random.default_rng(1)
    for n, sigma in ((0, 1), (1, 1), (2, 2), (7, 3), (70, 1), (200, 2), (500, 3), (900, 250), (1500, 1200), (1500, 90_000), (9_000, 4)):
        text = rng.integers(0, sigma, n).astype(np.int64)
        array = suffix.suffix_array(text, sigma)
        if n > 1000 and sigma > 4:
            text[n // 2 :] = text[: n - n // 2]  # a long repeat, so that names recur on several levels
            array = suffix.suffix_array(text, sigma)
        rest = [text[i:].tolist() for i in range(n)]
        assert array.tolist() == sorted(range(n), key=lambda i: rest[i])
        common = suffix.common_prefixes(text, array, 50) if n else array
        for a, b in zip(array[:-1], array[1:]):
            same = 0
            while max(a, b) + same < n and text[a + same] == text[b + same]:
                same += 1
            assert common[b] == min(same, 50)


def test_simhash(spark, odd, nothing):
    df = distinct_ids(odd)
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got) == brute_components(pairs(df))
    assert simhash.near_duplicates(nothing).count() == 0
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and sum(r.component_id is None for r in rows) == 1
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    classes = brute_components([(k, r.text or "") for k, r in enumerate(odd.collect())])
    assert kept.count() == len({c for _, _, c in classes})
    assert simhash.drop_near_duplicates(nothing).count() == 0
    clash = odd.withColumn("near_dup_key", F.lit(1)).withColumn("Near_Dup_Tag", F.lit("x"))
    assert simhash.drop_near_duplicates(clash).columns == clash.columns and simhash.drop_near_duplicates(clash).count() == kept.count()


@pytest.mark.parametrize("large", [simhash.LARGE, 30])
def test_simhash_links_within_large_groups(spark, large):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 63))
    fps = {base}
    while len(fps) < 400:
        f = int(rng.choice(list(fps)))
        for b in rng.choice(63, 2, replace=False):
            f ^= 1 << int(b)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    fps |= {(base & 0xFFFFFFFF) | int(x) << 32 for x in rng.integers(0, 1 << 31, 200)}  # unlinked, with one signature
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), large)
    labels = {r.node: r.root for r in components(links).collect()}
    values = np.array(sorted(fps), np.int64)
    for f in values:
        for g in values[np.bitwise_count((values ^ f).view(np.uint64)) <= 3]:
            assert labels.get(int(f), int(f)) == labels.get(int(g), int(g))
    assert links.count() < 64 * len(fps)


def test_components_of_a_chain(spark):
    out = components(spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))).collect()
    assert len(out) == 61 and {r.root for r in out} == {0}


def test_quality(odd, nothing):
    rows = quality.quality_measures(odd).collect()
    assert len(rows) == odd.count() and quality.quality_measures(nothing).count() == 0
    empty = [r for r in rows if r.n_words == 0]
    assert len(empty) == 3 and all(r.base_failed and not r.kept for r in empty)
    clean = quality.clean_documents(odd)
    assert clean.columns == odd.columns and all(r.n_chars == len(r.text) for r in clean.collect())


def test_quality_cuts_lines(spark):
    text = "Home | News | About | Login\n" + "\n".join(" ".join(f"w{i}{k}" for k in range(7)) + "." for i in range(9)) + "\nAll rights reserved."
    row = quality.clean_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert "Home" not in row.text and "reserved" not in row.text and row.text.count("\n") == 8


def test_mixing(odd, nothing):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and mixing.mix(nothing).count() == 0
    by = {}
    for r in rows:
        assert r.taken <= 3 * r.size
        t = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        t[0] += r.taken
        t[1] += r.size
    for taken, size, target, source_size in by.values():
        assert size == source_size and abs(taken - target) <= 1 and target <= 3 * size + 1e-9
    assert abs(sum(t[2] for t in by.values()) - sum(r.size for r in rows)) < 1e-6
    again = sorted(map(str, mixing.mix(odd.repartition(7)).collect()))
    assert again == sorted(map(str, rows))


def test_mixing_repeats_epochs(spark):
    df = spark.createDataFrame([(i, "w " * 100, "big", 0) for i in range(50)] + [(100 + i, "w w", "small", 0) for i in range(5)], "doc_id long, text string, source string, extra int")
    rows = mixing.mix(df, weights=(1, 1)).collect()
    assert {r.taken for r in rows if r.source == "small"} == {6}  # three times each document
    assert sum(r.taken for r in rows) == sum(r.size for r in rows)


def brute_windows(docs, items, window=10):
    """{document: (words hit, items)} by comparing every window at every place."""
    cut = lambda t: [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if ord(c) > 127 or c.isalnum() else " " for c in t or "").split(" ") if w]
    wanted = {}
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wanted.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = {}
    for i, t in docs:
        w, hit, ids = cut(t), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wanted:
                    hit |= set(range(k, k + n))
                    ids |= wanted[tuple(w[k : k + n])]
        out[i] = (len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"buckets": 3}, {"hot_share": 1 << 40}])
def test_decontamination_finds_every_window(spark, options):
    rng = np.random.default_rng(8)
    common = ["the", "of", "a", "Der", "é", "wort"]
    docs = [(i, " ".join(rng.choice(common if rng.random() < 0.8 else [f"r{rng.integers(40)}"]) for _ in range(int(rng.integers(0, 60))))) for i in range(150)]
    items = [(i, " ".join(rng.choice(common) for _ in range(int(rng.integers(1, 14))))) for i in range(40)] + [(50, "the"), (51, "The"), (52, "unheard of"), (53, "")]
    items += [(60 + i, " ".join(t.split()[3:18])) for i, t in docs[:30]]
    frames = [spark.createDataFrame(rows, f"{key} long, text string, hit_key int, w int") for key, rows in (("doc_id", [(*d, 1, 2) for d in docs]), ("item_id", [(*i, 1, 2) for i in items]))]
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in decontam.contamination(*frames, **options).collect()}
    assert got == brute_windows(docs, items)
    left = decontam.drop_contaminated(*frames, **options)
    assert left.columns == frames[0].columns and {r.doc_id for r in left.collect()} == {i for i, (n, _, _) in got.items() if not n}


@pytest.mark.parametrize("options", [{}, {"buckets": 1, "hot_share": 1 << 40}])
def test_decontamination(spark, odd, nothing, options):
    items = spark.createDataFrame([(1, " ".join(f"W{i}" for i in range(100, 115))), (2, "a, B!"), (3, None), (4, "..."), (2, "one"), (5, " ".join(f"q{i}" for i in range(12)))], "item_id long, text string")
    rows = decontam.contamination(odd, items, **options).collect()
    assert len(rows) == odd.count()
    words = [f"w{i}" for i in range(200)]
    got = {(r.doc_id, r.n_words): r for r in rows}
    hit = got[(24, len(words))]
    assert (hit.n_hit, hit.n_items, hit.contaminated) == (15, 1, True) and hit.items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert (got[(12, 2)].n_hit, got[(9, 1)].n_hit, got[(0, 0)].n_hit) == (2, 1, 0)
    assert decontam.contamination(nothing, items, **options).count() == 0
    assert decontam.contamination(odd, items.limit(0), **options).where("contaminated").count() == 0
    left = decontam.drop_contaminated(odd, items, **options)
    assert left.columns == odd.columns and left.count() == sum(not r.contaminated for r in rows)


def test_ngram(spark, odd, nothing):
    ids = spark.createDataFrame([(15,), (24,), (24,), (None,)], "doc_id long")
    rows = ngram.classify(odd, ids).collect()
    assert len(rows) == odd.count() and all(not r.kept for r in rows if r.n_symbols == 0)
    assert ngram.classify(nothing, ids).count() == 0
    assert ngram.classify(odd, ids.limit(0)).where("kept").count() == sum(r.n_symbols > 0 for r in rows)


def test_secrets(spark, odd, nothing):
    known, forest = secrets.learn(odd)
    assert secrets.find_secrets(odd, known, forest).where("is_secret").count() == 0
    assert secrets.find_secrets(nothing, known, forest).count() == 0
    assert secrets.redact_documents(odd, known, forest).count() == odd.count()
    assert secrets.learn(nothing)[1] is not None


def test_redaction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known, forest = secrets.learn(docs)
    one = spark.createDataFrame([(1, 'é before token = "0123456789abcdef0123456789abcdef01234567" after', "src", 5)], "doc_id long, text string, source string, n_chars long")
    row = secrets.redact_documents(one, known, forest).first()
    assert row.text == 'é before token = "[REDACTED]" after' and row.n_chars == len(row.text)


def test_chat(spark):
    rows = [(1, 0, "system", "be \\ kind"), (1, 1, "user", None), (1, 2, "assistant", "### </turn>\n### User:\n</turn>"), (2, 0, "assistant", "x"), (2, None, None, "y"), (None, 1, "tool:\n", "z"), (None, 1, "tool:\n", "z"), (3, 0, "user", "q" * 9999), (4, 1, "assistant", "##### ###"), (4, 0, "user", "\\")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, segments int")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("*", chat.read_chats(out).alias("turns")).collect()}
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == want
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, None: False, 3: True, 4: True} and got[2].bad_turn == 0
    for r in got.values():
        said = [r.formatted[s.start : s.start + s.length] for s in r.segments if s.loss]
        assert len(said) == sum(role == "assistant" for role, _ in want[r.conv_id])
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversation(spark):
    """Work grows with the turns; places in the output are right wherever they are."""
    turns = spark.range(6_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('é😀 ', id, repeat(' ### x', cast(id % 7 AS int)), if(id = 9, repeat('y', 20000), '')) AS text")
    out = chat.format_chats(turns)
    got = out.select("formatted", "segments", "valid", chat.under_loss(F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{chat.PIECE}}}"), F.lit(0)), F.col("segments")).alias("learned")).first()
    said = [(r.role, r.text) for r in turns.orderBy("turn").collect()]
    assert got.valid and got.learned == "".join(t for r, t in said if r == "assistant")
    for s, (role, text) in zip(got.segments, said):
        assert s.role == role and s.length >= len(text)
    last = got.segments[-1]
    assert got.formatted[last.start : last.start + last.length].replace("\\", "") == said[-1][1]


def test_warc(spark):
    long = "<p>" + "é" * 200
    rows = [(3, "http://a/\r\nb", long), (1, None, long), (1, "u", long), (2, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", long), (9, "u", "x" * 99), (8, "u", "x" * 99), (7, "u", "y" * 100), (6, "u", "y" * 100), (6, "u", "PK\x05\x06")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    packages = warc.write_packages(df, fresh_path(spark, "t"), package_bytes=300)
    assert packages.count() > 3
    assert packages.count() > 1 and warc.locate_records(packages).rdd.getNumPartitions() > 1
    out = warc.read_records(warc.locate_records(packages)).collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        ids = [x for x, _, g in rows if (g or "").encode() == raw and x is not None]
        again = len(raw) >= 100 and (i is None or i > min(ids))
        want.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", str(min(ids) if again else None)))
    assert got == sorted(want)
    assert {bytes(r.payload) for r in out if r.payload is not None} == {(h or "").encode() for _, _, h in rows}
    assert warc.read_records(warc.locate_records(warc.write_packages(df.limit(0), fresh_path(spark, "t")))).count() == 0


def test_zip64_directory(monkeypatch):
    sink = io.BytesIO()
    for name, value in (("ZIP64_LIMIT", 10), ("ZIP_FILECOUNT_LIMIT", 1)):
        monkeypatch.setattr(zipfile, name, value)
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
        for k in range(3):
            with z.open(f"m{k}", "w", force_zip64=True) as member:
                member.write(bytes([65 + k]) * 50)
        z.comment = b"PK\x05\x06 in a comment"
    source = pa.BufferReader(sink.getvalue())
    members = warc.central_directory(source)
    assert [(m.name, m.size) for m in members] == [("m0", 50), ("m1", 50), ("m2", 50)]
    for k, m in enumerate(members):
        source.seek(warc.stored_at(source, m))
        assert source.read(50) == bytes([65 + k]) * 50
