"""Brute-force versions of operators that SQL cannot express."""

import hashlib
import re

import numpy as np
import xxhash

DATA = "/root/testdata"
SF = f"{DATA}/sf0.001"


def documents(spark, sf=SF):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def brute_bytes(docs):
    first = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = t.encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    out = []
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\x01" * 50
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def brute_words(docs):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in docs]
    first = {}
    for i, w in sorted(words, key=lambda d: d[0]):
        for p in range(len(w) - 19):
            first.setdefault(tuple(w[p : p + 20]), (i, p))
    out = []
    for i, w in words:
        gone = [0] * len(w)
        for p in range(len(w) - 19):
            if first[tuple(w[p : p + 20])] < (i, p):
                gone[p : p + 20] = [1] * 20
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out)


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs):
    fps = np.array([brute_fingerprint(t) for _, t in docs], np.uint64)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            root[find(int(j))] = find(i)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, f"{int(fps[k]):016x}", least[find(k)]) for k, (i, _) in enumerate(docs))
