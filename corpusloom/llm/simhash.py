"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. If two fingerprints differ in at most
three bits, one of the segments differs in at most one, so that both have a common signature
(segment, wildcard position, segment without that bit). Every distinct fingerprint is indexed
under its 64 signatures, equal signatures meet through a hash exchange, and the meeting
fingerprints are verified by the number of differing bits. Verified links join into components.

Scale: exact copies share a fingerprint and count once. Fingerprints that meet are read as a
sorted stream of rows of 24 bytes; a signature shared by many gives a spanning set of links, never
all pairs, and no link between components is lost. Only links travel on.

Defined results: null or empty texts have fingerprint zero and are linked like any other; fewer
words than a shingle count as one shingle; a null key never becomes a component's id unless no
member has a key; repeated rows get one result each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _bytes as B
from ._graph import components
from ._store import materialize

MAX_BITS = 3
SHINGLE = 3
SEED = 42
#: A signature with at most so many fingerprints is checked pair by pair.
SMALL = 24
#: A signature with more fingerprints is split by quarters of the other segment.
LARGE = 10_000


def _fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.zeros(len(words), np.int64)
        np.cumsum(size[:-1] + 1, out=start[1:])
        stop = start + size
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(start[:n].tolist(), stop[shingle - 1 :].tolist())), np.uint64, n)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fp): the 64-bit fingerprint of every row, as a signed long."""
    narrow = docs.select(docs[key], docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.buffers(batch.column(1))
            raw = data.tobytes()
            found = np.fromiter((_fingerprint(raw[a:b].lower().split(), shingle, seed) for a, b in zip(offsets[:-1], offsets[1:])), np.uint64, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[key, "fp"])

    return narrow.mapInArrow(run, T.StructType([narrow.schema[0], T.StructField("fp", T.LongType())]))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_BITS


def _canonical(a: np.ndarray, b: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Whether ``sig`` is the first signature that both have, so that each pair is told once."""
    x = a ^ b
    low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)
    use_low = np.bitwise_count(low) <= 1
    part = np.where(use_low, low, high)
    bit = np.where(part == 0, np.uint64(0), np.bitwise_count(part - np.uint64(1)).astype(np.uint64))
    return sig == np.where(use_low, np.uint64(0), np.uint64(32)) + bit


def _spanning(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is linked in ``fps``: a breadth-first search that compares with unreached ones only."""
    rest = fps
    while len(rest):
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            at, frontier = frontier[0], frontier[1:]
            hit = _near(rest, at)
            if hit.any():
                reached, rest = rest[hit], rest[~hit]
                yield np.full(len(reached), at), reached
                frontier = np.concatenate([frontier, reached])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, sig, fp) sorted by part -> links (src, dst)."""
    held: list[list[np.ndarray]] = [[], [], []]

    def emit(pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if pairs:
            src, dst = (np.concatenate(x).view(np.int64) for x in zip(*pairs))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    def work(part: np.ndarray, sig: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        bounds = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        size = np.diff(bounds)
        of, end = np.repeat(size, size), np.repeat(bounds[1:], size)
        out = []
        for lag in range(1, SMALL):
            i = np.flatnonzero((of <= SMALL) & (np.arange(len(part)) + lag < end))
            if not len(i):
                break
            i = i[_near(fp[i], fp[i + lag])]
            i = i[_canonical(fp[i], fp[i + lag], sig[i] >> np.uint64(32))]
            if len(i):
                out.append((fp[i], fp[i + lag]))
        for g in np.flatnonzero(size > SMALL):
            out += _spanning(fp[bounds[g] : bounds[g + 1]])
        return out

    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in range(3)]
        if not len(now[0]):
            continue
        for old, new in zip(held, now):
            old.append(new)
        if held[0][0][0] == now[0][-1]:  # one part goes on, perhaps in the next batch
            continue
        every = [np.concatenate(x) for x in held]
        cut = int(np.flatnonzero(np.diff(every[0]))[-1]) + 1
        yield from emit(work(*(x[:cut] for x in every)))
        held = [[x[cut:]] for x in every]
    if held[0]:
        yield from emit(work(*(np.concatenate(x) for x in held)))


def links(distinct_fps: DataFrame, large: int = LARGE) -> DataFrame:
    """(src, dst): links between distinct fingerprints that join all that are within MAX_BITS of each other.

    A signature that more than ``large`` fingerprints have is split: of the four quarters of the
    other segment, two such fingerprints have one in common.
    """
    fp = F.col("fp")
    segments = (fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32))
    variants = [segments[s].bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit))) + F.lit((32 * s + bit) << 32) for s in (0, 1) for bit in range(32)]
    indexed = distinct_fps.select(fp, F.explode(F.array(*variants)).alias("sig")).select("sig", "fp")
    often = materialize(indexed.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large).select(F.col("sig").alias("hot")), "hot-signatures")
    if often.isEmpty():
        parted = indexed.select(F.col("sig").alias("part"), "sig", "fp")
    else:
        other = F.when(F.shiftrightunsigned("sig", 32) < 32, segments[1]).otherwise(segments[0])
        quarters = F.array(*(F.xxhash64("sig", F.lit(k), F.shiftrightunsigned(other, 8 * k).bitwiseAND(F.lit(255))) for k in range(4)))
        marked = indexed.join(often, indexed["sig"] == often["hot"], "left")
        parted = marked.select("sig", "fp", F.explode(F.when(F.col("hot").isNull(), F.array("sig")).otherwise(quarters)).alias("part")).select("part", "sig", "fp")
    return parted.repartition("part").sortWithinPartitions("part").mapInArrow(_links, "src long, dst long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id): the class of every row and the smallest key reachable from it."""
    marked = materialize(fingerprints(docs, key, text), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min(key).alias("first_key"))
    classes = materialize(classes, "fingerprint-classes")
    joined = components(materialize(links(classes.select("fp")), "fingerprint-links"))
    rooted = classes.join(joined, classes["fp"] == joined["node"], "left").select("fp", "first_key", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_key").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(key, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every class: that with the smallest key, null keys last, and of equal keys one text.

    Which rows stay is found on rows of a few numbers; the texts are exchanged once, by key and hash.
    """
    taken = {c.lower() for c in docs.columns}
    place, tag = (next(n for n in (f"near_dup_{name}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken) for name in ("key", "tag"))
    own = docs.select("*", F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias(place), F.xxhash64(text).alias(tag))
    marked = fingerprints(docs.select(F.struct(F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias(place), F.xxhash64(text).alias(tag)).alias("who"), F.col(text).alias("text")), "who", "text")
    marked = materialize(marked, "fingerprints")
    first = materialize(marked.groupBy("fp").agg(F.min("who").alias("who")), "fingerprint-classes")
    joined = components(materialize(links(first.select("fp")), "fingerprint-links"))
    rooted = first.join(joined, first["fp"] == joined["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("who").alias("who"))
    stay = rooted.select(F.col(f"who.{place}").alias("stay_key"), F.col(f"who.{tag}").alias("stay_tag"))
    kept = own.join(stay, (own[place] == stay["stay_key"]) & (own[tag] == stay["stay_tag"]), "left_semi")
    if not marked.groupBy("who").count().where("count > 1").isEmpty():  # rows that are repeated as they are
        kept = kept.dropDuplicates([place, tag])
    return kept.drop(place, tag)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
