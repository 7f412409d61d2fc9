"""Suffix-array deduplication: remove every byte of a passage that an earlier document has.

Equal windows meet in one shard (see ``_repeats``). A shard joins its distinct contexts into one
text and sorts its suffixes by induced sorting: suffixes are classed as smaller or larger than
their right neighbours, the leftmost-smaller substrings are sorted and named, the reduced text of
names is sorted recursively, and its order induces that of all suffixes in two linear sweeps.
Permuted common prefixes then tell which neighbours in the array share
``WINDOW`` bytes; the smallest document in such a run keeps its window.

Defined results: a null text is empty; equal documents keep the one with the smallest id, and rows
that share an id never remove each other's bytes; a null id counts as larger than all ids; texts
shorter than the window stay as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._repeats import Contexts, Repeats, covered_items, merged, per_row

WINDOW = 50
GRAM = 16
#: Sweeps go bucket by bucket where buckets hold so many suffixes on average, else suffix by suffix.
BUCKET = 64


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one to its right; the last is not."""
    n = len(text)
    step = np.append(np.sign(np.diff(text.astype(np.int64))), -1)
    place = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(place[::-1])[::-1]] > 0


def _sweep(text: np.ndarray, small: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The order of all suffixes that the given order of leftmost-smaller ones induces."""
    n, sigma = len(text), len(bounds) - 1
    array = np.full(n, -1, np.int64)
    head = bounds[:-1].copy()

    def place(items: np.ndarray, larger: bool) -> None:
        left = items[items > 0] - 1
        left = left[small[left] != larger]
        if not len(left):
            return
        char = text[left]
        order = np.argsort(char, kind="stable")
        left, char = left[order], char[order]
        first = np.flatnonzero(np.append(True, char[1:] != char[:-1]))
        count = np.diff(np.append(first, len(char)))
        rank = np.arange(len(char)) - np.repeat(first, count)
        if larger:
            array[head[char] + rank] = left
            head[char[first]] += count
        else:
            array[tail[char] - 1 - rank] = left
            tail[char[first]] -= count

    by_char = lms[np.argsort(text[lms], kind="stable")]
    at = np.searchsorted(text[by_char], np.arange(sigma + 1))
    place(np.array([n]), True)
    for c in range(sigma):
        done = bounds[c]
        while done < head[c]:
            done, block = head[c], array[done : head[c]]
            place(block, True)
        place(by_char[at[c] : at[c + 1]], True)
    stop, tail = head.copy(), bounds[1:].copy()
    for c in range(sigma - 1, -1, -1):
        done = bounds[c + 1]
        while done > tail[c]:
            done, block = tail[c], array[tail[c] : done]
            place(block[::-1], False)
        place(array[bounds[c] : stop[c]][::-1], False)
    return array


def _walk(text: np.ndarray, small: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What :func:`_sweep` gives, one suffix at a time: linear for every alphabet, as names of long texts make it."""
    n = len(text)
    letter, is_small = text.tolist(), small.tolist()
    array, head, tail = [-1] * n, bounds[:-1].tolist(), bounds[1:].tolist()
    for i in reversed(lms.tolist()):  # at the ends of their buckets, in order
        tail[letter[i]] -= 1
        array[tail[letter[i]]] = i
    if n:
        c = letter[n - 1]
        array[head[c]] = n - 1
        head[c] += 1
    for k in range(n):
        i = array[k] - 1
        if i >= 0 and not is_small[i]:
            c = letter[i]
            array[head[c]] = i
            head[c] += 1
    tail = bounds[1:].tolist()
    for k in range(n - 1, -1, -1):
        i = array[k] - 1
        if i >= 0 and is_small[i]:
            c = letter[i]
            tail[c] -= 1
            array[tail[c]] = i
    return np.array(array, np.int64)


def suffix_array(text: np.ndarray, sigma: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (values below ``sigma``) in order, by induced sorting, recursively."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    text = text.astype(np.int64 if sigma > 1 << 16 else np.uint16)
    induce = _sweep if sigma * BUCKET <= n else _walk
    small = _smaller(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    bounds = np.append(0, np.cumsum(np.bincount(text, minlength=sigma)))
    if len(lms) > 1:
        rough = induce(text, small, lms, bounds)
        is_lms = np.zeros(n + 1, bool)
        is_lms[lms] = True
        ordered = rough[is_lms[rough]]
        length = np.zeros(n, np.int64)
        length[lms] = np.diff(np.append(lms, n)) + 1
        a, b = ordered[:-1], ordered[1:]
        same = (length[a] == length[b]) & (np.maximum(a, b) + length[a] <= n)
        live, depth = np.flatnonzero(same), 0
        while len(live):
            live = live[depth < length[a[live]]]
            equal = text[a[live] + depth] == text[b[live] + depth]
            same[live[~equal]] = False
            live, depth = live[equal], depth + 1
        name = np.zeros(n, np.int64)
        name[ordered] = np.append(0, np.cumsum(~same))
        reduced = name[lms]
        names = int(reduced.max()) + 1
        order = np.argsort(reduced) if names == len(lms) else suffix_array(reduced, names)
        lms = lms[order]
    return induce(text, small, lms, bounds)


def common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each place of the text, bytes in common (``most`` at most) with the suffix before it in the array.

    Only places where the bytes to the left differ are compared; elsewhere the value is one less
    than that of the place to the left.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    place = np.arange(n)
    fresh = (before < 0) | (place == 0) | (before == 0)
    mid = np.flatnonzero(~fresh)
    fresh[mid] = (text[mid - 1] != text[before[mid] - 1])
    start = np.flatnonzero(fresh)
    length = np.zeros(n, np.int64)
    live, depth = start[before[start] >= 0], 0
    cap = 1 << 62
    while len(live) and depth < cap:
        other = before[live]
        inside = np.maximum(live, other) + depth < n
        live, other = live[inside], other[inside]
        equal = text[live + depth] == text[other + depth]
        live, depth = live[equal], depth + 1
        length[live] = depth
        if depth >= 4 * most:  # long common prefixes are rare; all that matters is how far they reach
            break
    if len(live):
        for i in live.tolist():
            a, b = i + depth, int(before[i]) + depth
            room = n - max(a, b)
            differ = np.flatnonzero(text[a : a + room] != text[b : b + room])
            length[i] = depth + (int(differ[0]) if len(differ) else room)
    owner = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.minimum(np.maximum(length[owner] - (place - owner), 0), most)


def _shared_part(c: Contexts, plan: Repeats) -> np.ndarray:
    """Contexts with a partner on either side: every window has half of what surrounds its anchor to the left or to the right."""
    half = (plan.window - plan.gram + 1) // 2
    prefix = B.prefix_hash(B.BYTE_VALUE[c.data])
    at = c.edges[:-1] + c.rel
    out = np.zeros(len(c.anchor), bool)
    for side, start, end in ((1, at - half, at + plan.gram), (2, at, at + plan.gram + half)):
        fit = np.flatnonzero((start >= c.edges[:-1]) & (end <= c.edges[1:]))
        key = B.mix(B.span_hash(prefix, start[fit], end[fit]) + B.mix(c.anchor[fit]))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        hit = np.zeros(len(fit), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        out[fit[hit]] = True
    return out


def solve(c: Contexts, plan: Repeats) -> np.ndarray:
    """Whether each window of each context also starts in a document with a smaller id."""
    windows = c.items - plan.window + 1
    covered = np.zeros(int(windows.sum()), bool)
    worth = np.flatnonzero(_shared_part(c, plan))
    if not len(worth):
        return covered
    some = c.take(worth)
    raw, edges = some.data.tobytes(), some.edges
    seen: dict[bytes, int] = {}
    which = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())), np.int64, len(worth))
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, which, some.doc)
    first = np.full(len(seen), -1, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    size = some.size[first].astype(np.int64)
    # the contexts as one text over 257 letters, 0 between them
    text = np.zeros(int((size + 1).sum()), np.uint16)
    begin = np.cumsum(size + 1) - (size + 1)
    inside = np.ones(len(text), bool)
    inside[begin + size] = False
    owned = Contexts.take(some, first).data
    text[inside] = owned.astype(np.uint16) + 1
    array = suffix_array(text, 257)
    prefix = common_prefixes(text, array, plan.window)
    owner = np.repeat(np.arange(len(size)), size + 1)
    whole = (begin + size)[owner] - np.arange(len(text)) >= plan.window
    run = np.cumsum(prefix[array] < plan.window)
    at = array[whole[array]]
    run = run[whole[array]]
    head = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    smallest = np.minimum.reduceat(least[owner[at]], head) if len(at) else least[:0]
    found = np.zeros(len(text), np.int64)
    found[at] = np.repeat(smallest, np.diff(np.append(head, len(at))))
    n = windows[worth]
    index = np.repeat(np.arange(len(worth)), n)
    nth = np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n)
    to = np.repeat((np.cumsum(windows) - windows)[worth], n) + nth
    covered[to] = found[begin[which[index]] + nth] < some.doc[index]
    return covered


PLAN = Repeats("byte", WINDOW, GRAM, within=False, solve=solve)
_OUT = "id long, tag long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = B.buffers(batch.column(2))
        rows = []
        for i, spans in enumerate(batch.column(3).to_pylist()):
            piece = data[offsets[i] : offsets[i + 1]]
            gone = merged(spans, len(piece))
            rows.append((len(piece), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(piece[~gone].tobytes()).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, zip(*rows))], names=["id", "tag", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", plan: Repeats = PLAN) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    texts, rows, several = covered_items(docs, plan, key, text)
    cut = texts.mapInArrow(_cut, _OUT)
    whole = ~F.col("first") & (F.col("n_bytes") >= plan.window)  # all of it stands in a smaller document
    return per_row(rows, cut, several).select(
        F.col("key").alias(key), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.when(F.col("first"), F.col("n_removed")).otherwise(F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.when(F.col("first"), F.col("n_spans")).otherwise(F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def op4_suffix_array(spark, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
