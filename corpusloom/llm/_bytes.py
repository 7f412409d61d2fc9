"""Vectorised kernels over the UTF-8 buffers of Arrow string columns.

All functions take many documents at once: ``data`` holds their bytes back to back and
``offsets`` (one more than documents) tells where each begins. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes handled at once; temporaries take about 60 times as much memory.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit depends on all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: One random value a byte, by rule.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", BASE), ("down", INVERSE)):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U64))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any span of ``values``."""
    _, down = POWERS.take(len(values))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * down, dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each span [start, end); equal spans have equal hashes wherever they stand."""
    up, _ = POWERS.take(len(prefix))
    return mix((prefix[end] - prefix[start]) * up[start] + (end - start).astype(U64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary column; data starts at offset 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "")
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, where, what = column.buffers()
    n = len(column)
    if n == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together; a longer document stands alone, whole."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): spans of maximal runs of non-separators, and the index of each document's first word (one more than documents)."""
    inside = ~separator[data]
    begin, finish = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        finish[:-1] &= ~inside[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        begin[edge] = inside[edge]
        finish[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return start, end, np.searchsorted(start, offsets)


def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``edges``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def repeat_index(counts: np.ndarray) -> np.ndarray:
    """0,0,..,1,1,..: the index of the group of each item."""
    return np.repeat(np.arange(len(counts)), counts)


def first_seen(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(earlier, repeated): whether an equal key stands earlier in the same group, and whether it stands there at least twice."""
    n = len(keys)
    earlier, repeated = np.zeros(n, bool), np.zeros(n, bool)
    if n == 0:
        return earlier, repeated
    mixed = mix(keys + mix(group.astype(U64) + U64(1)))
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    earlier[order[1:]] = same
    repeated[order[1:]] = same
    repeated[order[:-1]] |= same
    return earlier, repeated


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the n positions that lie in a window [s, s+width) of some start."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:-1]) > 0
