"""Repeated passages across documents: content-defined anchors deal every window to one shard.

A document is a sequence of items (bytes or words). Of each window of ``window`` consecutive
items, the ``gram`` consecutive items with the lowest hash are its anchor, so equal windows have
equal anchors and only windows with one anchor need to meet. The work is one Spark job after a
first pass over the table:

1. Every task reads its documents and sends anchors' hashes, packed by bucket; a bucket keeps those
   that two different texts have (or one text twice, if ``within``).
2. Each document cuts out, around every kept anchor, the items of the windows that have this anchor.
   These contexts go to shards by anchor, where a solver finds
   equal windows and tells which occurrences are not the first.
3. Documents take back their covered intervals.

Skew: exact copies count once. A task tells an anchor or a context that many of its documents have
once, and settles later occurrences itself after comparing their bytes, so a common passage costs
each shard one row a task. Anchors that very many texts have ("hot") are dealt out window by window
instead of all to one shard: from ``Repeats.hot`` texts on, or from twice, four times as many and so
on where more than ``MAX_HOT`` anchors have that many.

Identity: equal texts are those with equal hashes of 128 bits. A document is known by its id and 64
bits of its text together, so only rows that share an id could ever be confused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._store import materialize

#: A bucket or shard is meant to stand for so many bytes of text.
BUCKET_BYTES = 24 << 20
MAX_HOT = 1_000_000
LAST = np.iinfo(np.int64).max
#: Rows that share a text are dealt to so many tasks.
SALTS = 16


@dataclass(frozen=True)
class Repeats:
    unit: str  # "byte" or "word"
    window: int
    gram: int
    #: Whether an earlier occurrence in the same document counts.
    within: bool
    #: (Contexts, Repeats) -> per context and window, whether it is covered.
    solve: Callable[[Contexts, Repeats], np.ndarray] | None = None
    #: An anchor is hot from so many texts.
    hot: int = 50_000
    #: A shard solves whole anchors of about so many bytes at a time, which bounds its memory.
    chunk_bytes: int = 2 << 20


@dataclass
class Contexts:
    """Pieces of documents, back to back: ``edges`` bounds their bytes; ``lo`` is the first item's place in its document."""

    anchor: np.ndarray
    doc: np.ndarray
    who: np.ndarray
    lo: np.ndarray
    rel: np.ndarray
    items: np.ndarray
    size: np.ndarray
    data: np.ndarray

    @property
    def edges(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)

    def take(self, index: np.ndarray) -> Contexts:
        at = self.edges
        return Contexts(*(getattr(self, f)[index] for f in ("anchor", "doc", "who", "lo", "rel", "items", "size")), gather(self.data, at[index], self.size[index]))


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces [start, start+size) of ``data``, back to back."""
    total = int(size.sum())
    if not total:
        return data[:0]
    step = np.ones(total, np.int64)
    full = size > 0
    start, size = start[full], size[full]
    at = np.cumsum(size)[:-1]
    step[0] = start[0]
    step[at] = start[1:] - (start[:-1] + size[:-1] - 1)
    return data[np.cumsum(step)]


@dataclass
class Items:
    """A slice of documents as items: their hashes, each document's first item, and bytes in normal form."""

    value: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def items_of(data: np.ndarray, offsets: np.ndarray, unit: str) -> Items:
    if unit == "byte":
        place = np.arange(len(data) + 1)
        return Items(B.BYTE_VALUE[data], offsets, place[:-1], place[1:], data)
    start, end, first = B.word_spans(data, offsets)
    value = B.span_hash(B.prefix_hash(B.BYTE_VALUE[data]), start, end)
    size = end - start + 1  # each word with one space behind it
    joined = gather(np.append(data, np.uint8(32)), start, size)
    stop = np.cumsum(size)
    joined[stop - 1] = 32
    return Items(value, first, stop - size, stop - 1, joined)


def _slide(x: np.ndarray, width: int, how: np.ufunc) -> np.ndarray:
    """how.reduce of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = how(x[:-size], x[size:])
        size *= 2
    return how(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(value: np.ndarray, first: np.ndarray, plan: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the lowest grams of all windows, in order."""
    n, w = len(value), plan.window - plan.gram + 1
    if n < plan.window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = B.prefix_hash(value)
    up, _ = B.POWERS.take(n + 1)
    gram = B.mix((prefix[plan.gram :] - prefix[: -plan.gram]) * up[: n + 1 - plan.gram])
    least = _slide(gram, w, np.minimum)  # by window
    steps = np.zeros(len(least) + 1, np.int32)
    edge = first[1:-1]
    edge = edge[(edge > first[:-2])]  # windows over a document's end belong to nobody
    np.add.at(steps, np.clip(edge - plan.window + 1, 0, len(least)), 1)
    np.add.at(steps, np.clip(edge, 0, len(least)), -1)
    least = np.where(np.cumsum(steps[:-1]) > 0, np.uint64(0), least)
    pad = np.zeros(w - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), w, np.maximum)
    at = np.flatnonzero((gram == most) & (gram != 0))
    return at, gram[at]


def reigns(at: np.ndarray, code: np.ndarray, doc: np.ndarray, first: np.ndarray, plan: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(lo, hi): first and last start of the windows that have each anchor as their lowest gram, the leftmost of equals."""
    w = plan.window - plan.gram + 1
    lo = np.maximum(at - w + 1, first[doc])
    hi = np.minimum(at, first[doc + 1] - plan.window)
    for lag in range(1, w):
        near = np.flatnonzero(at[lag:] - at[:-lag] < w)
        if not len(near):
            break
        left, right = near, near + lag
        block = code[left] <= code[right]
        x = right[block]
        lo[x] = np.maximum(lo[x], at[left[block]] + 1)
        block = code[right] < code[left]
        x = left[block]
        hi[x] = np.minimum(hi[x], at[right[block]] - w)
    return lo, hi


_PACKED = "bucket int, who binary, count binary, code binary, settled boolean"


def _pack(bucket: int, who: np.ndarray, code: np.ndarray, settled: bool) -> tuple:
    """Anchors sorted by text; each text once, with its number of anchors."""
    head = np.flatnonzero(np.diff(who, prepend=who[0] ^ np.uint64(1))) if len(who) else np.zeros(0, np.int64)
    return bucket, who[head].tobytes(), np.diff(np.append(head, len(who))).astype(np.int32).tobytes(), code.tobytes(), settled


def _packed(part: np.ndarray, who: np.ndarray, code: np.ndarray, parts: int, settled: bool) -> list[tuple]:
    """Rows by part, in each the texts with their anchors."""
    order = np.lexsort((who, part))
    part, who, code = part[order], who[order], code[order]
    edge = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
    return [_pack(int(part[a]), who[a:b], code[a:b], settled) for a, b in zip(edge[:-1], edge[1:])]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("who", pa.binary()), ("count", pa.binary()), ("code", pa.binary()), ("settled", pa.bool_())])


def _marker(plan: Repeats, buckets: int):
    """Rows (tag, text) -> packed anchors."""

    def found(tags: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        items = items_of(data, offsets, plan.unit)
        at, code = anchors(items.value, items.first, plan)
        return code, tags[np.searchsorted(items.first, at, "right") - 1]

    def mark(code: np.ndarray, who: np.ndarray) -> list[tuple]:
        if not len(code):
            return []
        order = np.lexsort((who, code))
        code, who = code[order], who[order]
        same_code = np.append(False, code[1:] == code[:-1])
        same_both = same_code & np.append(False, who[1:] == who[:-1])
        group = np.cumsum(~same_code) - 1
        twice = np.zeros(group[-1] + 1, bool)
        if plan.within:
            twice[group[same_both]] = True
        texts = np.bincount(group, weights=~same_both)
        shared = (texts > 1) | twice
        known = shared[group] & ~same_both
        # what this task knows to be shared needs no answer
        rows = _packed((who[known] % np.uint64(buckets)).astype(np.int32), who[known], code[known], buckets, True)
        # others are told of it once, with the number of texts; what one text has is asked for
        heads = np.flatnonzero(~same_code)
        one = heads[~shared]
        rows += _packed((B.mix(code[one]) % np.uint64(buckets)).astype(np.int32), who[one], code[one], buckets, False)
        c, many = code[heads[shared]], np.maximum(texts[shared], 2).astype(np.int32)
        part = (B.mix(c) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        c, many, part = c[order], many[order], part[order]
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=buckets))
        return rows + [(int(part[a]), b"", many[a:b].tobytes(), c[a:b].tobytes(), False) for a, b in zip(edge[:-1], edge[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            data, offsets = B.buffers(batch.column(1))
            parts = [found(tags[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in B.slices(offsets)]
            if rows := mark(*(np.concatenate(x) for x in zip(*parts))) if parts else []:
                yield _batch(rows, _PACKED_ARROW)

    return run


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All binaries of a column as one array; a binary column already holds them back to back."""
    return B.buffers(column)[0].view(kind)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(text, anchor) of packed rows."""
    count = _joined(table.column("count"), np.int32)
    return np.repeat(_joined(table.column("who"), np.uint64), count), _joined(table.column("code"), np.uint64)


def _sharer(plan: Repeats, parts: int):
    """A bucket's packed anchors -> those that are shared, packed by part of the texts; in parts below 0 the hot ones, by their numbers of texts."""

    def run(table: pa.Table) -> pa.Table:
        done = table.column("settled").combine_chunks().to_numpy(zero_copy_only=False)
        names = pc.equal(pc.binary_length(table.column("who")), 0).combine_chunks().to_numpy(zero_copy_only=False)
        settled, asked, told = (table.filter(pa.array(f)) for f in (done, ~done & ~names, ~done & names))
        del table
        who, code = _unpacked(asked)
        many = _joined(told.column("count"), np.int32)
        many = np.concatenate([np.ones(len(who), np.int32), many])
        code = np.concatenate([code, _joined(told.column("code"), np.uint64)])
        who = np.concatenate([who, np.zeros(len(code) - len(who), np.uint64)])
        del asked, told
        rows: list[tuple] = []
        if len(code):
            order = np.argsort(code, kind="stable")
            who, many, code = who[order], many[order], code[order]
            head = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            total = np.add.reduceat(many, head)
            other = np.maximum.reduceat(who, head) != np.minimum.reduceat(who, head)  # exact copies are one text
            sure = np.maximum.reduceat(many, head) > 1
            shared = np.repeat(other | sure, np.diff(np.append(head, len(code)))) & (who != 0)
            rows = _packed((who[shared] % np.uint64(parts)).astype(np.int32), who[shared], code[shared], parts, True)
            level = np.where(total >= plan.hot, -1 - np.log2(np.maximum(total // plan.hot, 1)).astype(np.int64), 0)
            rows += [(int(x), b"", b"", code[head][level == x].tobytes(), True) for x in np.unique(level[level < 0])]
        found = [_batch(rows, _PACKED_ARROW)] if rows else []
        return pa.Table.from_batches([*settled.cast(_PACKED_ARROW).to_batches(), *found], _PACKED_ARROW)

    return run


def _gather_codes(table: pa.Table) -> pa.Table:
    """A part's packed anchors -> (tag, codes): the shared anchors of each text."""
    out = pa.schema([("tag", pa.int64()), ("codes", pa.binary())])
    who, code = _unpacked(table)
    order = np.argsort(who, kind="stable")
    who, code = who[order], code[order]
    edge = np.append(np.flatnonzero(np.append(True, who[1:] != who[:-1])), len(who)) if len(who) else np.zeros(1, np.int64)
    rows = [(t, code[a:b].tobytes()) for t, a, b in zip(who[edge[:-1]].view(np.int64).tolist(), edge[:-1], edge[1:])]
    return pa.Table.from_batches([_batch(rows, out)] if rows else [], out)


_SENT = "shard int, kind int, anchor binary, doc binary, who binary, lo binary, rel binary, items binary, size binary, data binary"
_SENT_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("anchor", "doc", "who", "lo", "rel", "items", "size", "data"))])
#: Numbers of a context; its bytes travel compressed, and a row's sizes tell how long they are.
_KINDS = {"anchor": np.uint64, "doc": np.int64, "who": np.int64, "lo": np.int32, "rel": np.int32, "items": np.int32, "size": np.int32}


def _equal(items: Items, a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether the ``n`` items from ``a`` and the ``m`` items from ``b`` are the same bytes."""
    size = items.end[a + n - 1] - items.start[a]
    same = (n == m) & (size == items.end[b + m - 1] - items.start[b])
    some = np.flatnonzero(same)
    if len(some):
        pieces = [gather(items.data, items.start[x[some]], size[some]) for x in (a, b)]
        same[some] = np.bincount(np.repeat(np.arange(len(some)), size[some]), weights=pieces[0] != pieces[1], minlength=len(some)) == 0
    return same


def _cutter(plan: Repeats, shards: int, hot: np.ndarray):
    """Rows (id, tag, text, codes) -> contexts by shard, and intervals that are settled here."""

    def cut(tags: np.ndarray, ids: np.ndarray, codes: list, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        items = items_of(data, offsets, plan.unit)
        at, code = anchors(items.value, items.first, plan)
        if not len(at):
            return
        doc = np.searchsorted(items.first, at, "right") - 1
        # which anchors are shared: codes are listed by document
        listed = [np.frombuffer(x, np.uint64) for x in codes]
        known = B.mix(np.concatenate(listed) + B.mix(B.repeat_index(np.array(list(map(len, listed)))).astype(np.uint64)))
        kept = np.isin(B.mix(code + B.mix(doc.astype(np.uint64))), known)
        lo, hi = reigns(at, code, doc, items.first, plan)
        use = np.flatnonzero(kept & (lo <= hi))
        at, code, doc, lo, hi = (x[use] for x in (at, code, doc, lo, hi))
        prefix = B.prefix_hash(items.value)
        if len(hot):  # single windows, dealt by their own hash
            single = np.isin(code, hot)
            reps = np.where(single, hi - lo + 1, 1)
            index = np.repeat(np.arange(len(at)), reps)
            nth = np.arange(len(index)) - np.repeat(np.cumsum(reps) - reps, reps)
            at, code, doc, single = at[index], code[index], doc[index], single[index]
            lo = lo[index] + nth
            hi = np.where(single, lo, hi[index])
            code = np.where(single, B.span_hash(prefix, lo, lo + plan.window), code)
        what = B.mix(B.span_hash(prefix, lo, hi + plan.window) + (at - lo).astype(np.uint64))
        order = np.lexsort((lo, tags[doc], ids[doc], what))
        at, code, doc, lo, hi, what = (x[order] for x in (at, code, doc, lo, hi, what))
        again = np.append(False, what[1:] == what[:-1])
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(what)))) if len(what) else np.zeros(0, np.int64)
        width = hi - lo + plan.window
        # an equal context stands earlier, so all its windows do
        settled = ids[doc] > ids[doc][head]
        if plan.within:
            settled |= again & np.append(False, (tags[doc][1:] == tags[doc][:-1]) & (ids[doc][1:] == ids[doc][:-1]))
        s = np.flatnonzero(settled)
        settled[s] = _equal(items, lo[s], lo[head[s]], width[s], width[head[s]]) & (at[s] - lo[s] == at[head[s]] - lo[head[s]])
        base = items.first[doc]
        s = np.flatnonzero(settled)
        if len(s):
            part = (tags[doc[s]].view(np.uint64) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            s, part = s[order], part[order]
            edge = np.flatnonzero(np.diff(part, prepend=-1, append=shards))
            for a, b in zip(edge[:-1], edge[1:]):
                x = s[a:b]
                yield int(part[a]), 1, b"", ids[doc[x]].tobytes(), tags[doc[x]].tobytes(), (lo - base)[x].astype(np.int32).tobytes(), b"", width[x].astype(np.int32).tobytes(), b"", b""
        s = np.flatnonzero(~settled)
        part = (B.mix(code[s] + np.uint64(1)) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        s, part = s[order], part[order]
        begin = items.start[lo[s]]
        size = items.end[lo[s] + width[s] - 1] - begin
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=shards))
        for a, b in zip(edge[:-1], edge[1:]):
            x = s[a:b]
            columns = (code[x], ids[doc[x]], tags[doc[x]], (lo - base)[x].astype(np.int32), (at - lo)[x].astype(np.int32), width[x].astype(np.int32), size[a:b].astype(np.int32))
            yield int(part[a]), 0, *(c.tobytes() for c in columns), pa.compress(gather(items.data, begin[a:b], size[a:b]).tobytes(), "zstd", asbytes=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, offsets = B.buffers(batch.column(2))
            for i, j in B.slices(offsets):
                codes = batch.column(3).slice(i, j - i).to_pylist()
                rows = list(cut(tags[i:j], ids[i:j], codes, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                if rows:
                    yield _batch(rows, _SENT_ARROW)

    return run


def intervals(doc: np.ndarray, who: np.ndarray, start: np.ndarray, width: int, covered: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, ...]:
    """Covered windows, listed by context (``run``) in order -> (doc, who, start, length) of their unions."""
    i = np.flatnonzero(covered)
    if not len(i):
        return doc[:0], who[:0], start[:0], start[:0]
    head = np.flatnonzero(np.append(True, (np.diff(i) != 1) | (np.diff(run[i]) != 0)))
    tail = np.append(head[1:], len(i)) - 1
    a, b = i[head], i[tail]
    return doc[a], who[a], start[a], start[b] - start[a] + width


_COVERED = "part int, doc binary, who binary, start binary, size binary"
_COVERED_ARROW = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("doc", "who", "start", "size"))])


def _solver(plan: Repeats, parts: int):
    """A shard's contexts -> covered intervals, packed by part of the documents."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").combine_chunks().to_numpy(zero_copy_only=False)
        settled = table.filter(pa.array(kind == 1))
        found = [(_joined(settled.column("doc"), np.int64), _joined(settled.column("who"), np.int64), _joined(settled.column("lo"), np.int32).astype(np.int64), _joined(settled.column("items"), np.int32).astype(np.int64))]
        sent = table.filter(pa.array(kind == 0))
        sizes = [int(np.frombuffer(x, np.int32).sum()) for x in sent.column("size").to_pylist()]
        data = np.empty(sum(sizes), np.uint8)
        at = 0
        for raw, size in zip(sent.column("data"), sizes):
            data[at : at + size] = np.frombuffer(pa.decompress(raw.as_buffer(), size, "zstd"), np.uint8)
            at += size
        every = Contexts(*(_joined(sent.column(c), k) for c, k in _KINDS.items()), data)
        del table, settled, sent
        order = np.argsort(every.anchor, kind="stable")
        code = every.anchor[order]
        head = np.append(True, code[1:] != code[:-1]) if len(code) else np.zeros(0, bool)
        group = np.cumsum(head) - 1
        order, group = order[(many := np.bincount(group)[group] > 1)], group[many]  # an anchor that stands alone has no partner
        mass = np.cumsum(every.size[order])
        while len(order):
            cut = int(np.searchsorted(mass, mass[0] + plan.chunk_bytes))
            cut = int(np.searchsorted(group, group[min(cut, len(group) - 1)], "right")) if cut < len(group) else len(group)
            some = every.take(order[:cut])
            order, group, mass = order[cut:], group[cut:], mass[cut:]
            n = some.items - plan.window + 1
            index = B.repeat_index(n)
            nth = np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n)
            found.append(intervals(some.doc[index], some.who[index], some.lo[index].astype(np.int64) + nth, plan.window, plan.solve(some, plan), index))
        doc, who, start, size = (np.concatenate(x) for x in zip(*found))
        part = (who.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, doc, who, start, size = part[order], doc[order], who[order], start[order].astype(np.int32), size[order].astype(np.int32)
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
        rows = [(int(part[a]), doc[a:b].tobytes(), who[a:b].tobytes(), start[a:b].tobytes(), size[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])]
        return pa.Table.from_batches([_batch(rows, _COVERED_ARROW)] if rows else [], _COVERED_ARROW)

    return run


def _gather_spans(table: pa.Table) -> pa.Table:
    """A part's packed intervals -> (id, tag, spans): those of each document, as pairs of start and length."""
    out = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("spans", pa.binary())])
    doc, who, start, size = (_joined(table.column(c), k) for c, k in (("doc", np.int64), ("who", np.int64), ("start", np.int32), ("size", np.int32)))
    order = np.lexsort((who, doc))
    doc, who, pairs = doc[order], who[order], np.stack([start[order], size[order]], axis=1)
    edge = np.append(np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (doc[1:] != doc[:-1]))), len(who)) if len(who) else np.zeros(1, np.int64)
    rows = [(int(doc[a]), int(who[a]), pairs[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])]
    return pa.Table.from_batches([_batch(rows, out)] if rows else [], out)


def _hot_anchors(shared: DataFrame) -> np.ndarray:
    """At most MAX_HOT anchors, those of the most texts, whole levels at a time."""
    levels = shared.where("bucket < 0").groupBy("bucket").agg((F.sum(F.octet_length("code")) / 8).alias("n")).orderBy("bucket").collect()  # one row for each doubling
    least, total = 0, 0
    for r in levels:
        total += r.n
        if total > MAX_HOT:
            break
        least = r.bucket
    hot = [r.code for r in shared.where(F.col("bucket") <= least).select("code").collect()] if least < 0 else []
    return np.sort(np.frombuffer(b"".join(hot), np.uint64))


def covered_items(docs: DataFrame, plan: Repeats, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, rows, several).

    texts: (id, tag, text, spans) for the first document of every distinct text; spans is a binary of
    pairs of int32 (start, length) in items, or null. rows: (key, id, tag, first, salt) for
    every row of ``docs``, with the id of its text's first document: ``first`` tells whether it is this; any other has an
    equal text at a smaller key. several: (s_id, s_tag) of texts that more than one row has. Rows take what
    is known of their text through :func:`per_row`.
    """
    own = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    own = own.withColumn("id", F.coalesce(F.col("key").cast("long"), F.lit(int(LAST)))).withColumn("tag", F.xxhash64("text"))
    light = materialize(own.select("key", "id", "tag", F.xxhash64(F.lit(1), "text").alias("more"), F.octet_length("text").alias("bytes")), "repeat-rows")
    total = light.agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, -(-total // BUCKET_BYTES))

    marked = own.select("tag", "text").mapInArrow(_marker(plan, parts), _PACKED)
    shared = materialize(marked.groupBy("bucket").applyInArrow(_sharer(plan, parts), _PACKED), "repeat-anchors")
    hot = _hot_anchors(shared)

    first = light.groupBy("tag", "more").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    asked = shared.where("bucket >= 0").groupBy("bucket").applyInArrow(_gather_codes, "tag long, codes binary")
    asked = first.join(asked, "tag").select("id", "tag", "codes")
    base = own.select("id", "tag", "text")
    if not light.groupBy("tag", "id").count().where("count > 1").isEmpty():
        base = base.dropDuplicates(["id", "tag"])  # repeated rows are one document
    sent = base.join(asked, ["id", "tag"]).select("id", "tag", "text", "codes").mapInArrow(_cutter(plan, parts, hot), _SENT)
    covered = sent.groupBy("shard").applyInArrow(_solver(plan, parts), _COVERED)
    spans = covered.groupBy("part").applyInArrow(_gather_spans, "id long, tag long, spans binary")
    chosen = first.select("id", "tag").join(spans, ["id", "tag"], "left")
    # the same columns as above, so that the texts are exchanged once for both joins
    texts = base.join(chosen, ["id", "tag"]).select("id", "tag", "text", "spans")
    copied = first.where("n > 1").select(F.col("tag").alias("f_tag"), F.col("more").alias("f_more"), F.col("id").alias("f_id"), F.explode(_salts()).alias("f_salt"))
    salt = F.pmod(F.xxhash64("key", "bytes"), F.lit(SALTS)).cast("int")
    same = (F.col("tag") == F.col("f_tag")) & (F.col("more") == F.col("f_more")) & (F.col("salt") == F.col("f_salt"))
    named = light.withColumn("salt", salt).join(copied, same, "left")
    rows = named.select(
        "key", F.coalesce("f_id", "id").alias("id"), "tag", (F.col("f_id").isNull() | (F.col("id") == F.col("f_id"))).alias("first"),
        F.when(F.col("f_id").isNull(), F.lit(0)).otherwise(F.col("salt")).alias("salt"),
    )
    several = first.where("n > 1").select(F.col("id").alias("s_id"), F.col("tag").alias("s_tag"))
    return texts, rows, several


def _salts():
    return F.sequence(F.lit(0), F.lit(SALTS - 1))


def per_row(rows: DataFrame, found: DataFrame, several: DataFrame) -> DataFrame:
    """Rows with what was found for their text (by ``id`` and ``tag``); texts with many rows are copied under salts, so that no task gets all."""
    salts = F.when(F.col("s_id").isNull(), F.array(F.lit(0))).otherwise(_salts())
    copied = found.join(several, (found["id"] == several["s_id"]) & (found["tag"] == several["s_tag"]), "left")
    return rows.join(copied.withColumn("salt", F.explode(salts)).drop("s_id", "s_tag"), ["id", "tag", "salt"]).drop("salt")


def merged(spans: bytes | None, n: int) -> np.ndarray:
    """Flags of the n items that the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    if spans:
        pairs = np.frombuffer(spans, np.int32).reshape(-1, 2).astype(np.int64)
        np.add.at(steps, pairs[:, 0], 1)
        np.add.at(steps, pairs[:, 0] + pairs[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0
