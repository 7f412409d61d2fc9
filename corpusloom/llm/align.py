"""Cross-tokenizer alignment through products of sparse incidence matrices.

Two tokenizers cut the same bytes. Each has a token-byte incidence matrix, in compressed rows built
by hand: row i lists the bytes of token i. The product A times B transposed, row by row after
Gustavson (a row of the result is the merged rows of the second factor that the entries of the
first one's row name), holds the number of bytes that a token of A shares with a token of B: the
overlap links. Where tokens of both end at one byte a group ends; the product of the two
token-group incidence matrices holds the shared-group links.

How often an id pair is linked is counted in documents. A task gathers its texts into blocks of
bounded size and asks once per block for each pair; counts meet the questions through an exchange
by pair, answers go back to their block. The links themselves never travel: a block keeps, packed,
each document's pairs by their place in the block's list.

Scale: memory follows the block (4 MB of text) and the stretch that is multiplied at once. A longer
text is encoded slice by slice, cut before a space between letters or digits, where neither
tokenizer's pieces can reach across; a run without any such place is encoded whole. A pair occurs at most once per block, so no pair is a hot key among the questions. The best
counts have one row per id of A, which bounds what is broadcast.

Defined results: texts that are null or empty, or whose tokens' bytes differ from the text behind a
space, have no tokens: all zeros, the hash of groups is ''. Equal texts each count as a document,
repeated rows and null keys too; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _bytes as B
from ._store import materialize

#: Where the tokenizers' files are, on every worker.
FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a block, characters that are encoded and multiplied at once, characters of a slice at least.
BLOCK_BYTES, STRETCH, SLICE = 4 << 20, 1 << 19, 1 << 17
#: Entries of a product that are expanded at once.
EXPANDED = 1 << 21
#: An id pair is a * 2**PAIR_BITS + b.
PAIR_BITS = 20

# Fixed value: how byte-level tokenizers cut texts before they merge.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")

# ------------------------------------------------------------------------------------ sparse matrices


class Rows(NamedTuple):
    """A sparse 0-1 matrix by rows: row i has ones in the columns at[start[i] : start[i + 1]]."""

    start: np.ndarray
    at: np.ndarray
    columns: int


def by_bytes(size: np.ndarray) -> Rows:
    """Token-byte incidence of consecutive tokens of the given sizes."""
    start = np.concatenate([[0], np.cumsum(size)])
    return Rows(start, np.arange(start[-1]), int(start[-1]))


def by_groups(group: np.ndarray, groups: int) -> Rows:
    """Token-group incidence: every token is in one group."""
    return Rows(np.arange(len(group) + 1), group, groups)


def transposed(m: Rows) -> Rows:
    """The same ones by columns: a counting sort of the entries."""
    start = np.concatenate([[0], np.cumsum(np.bincount(m.at, minlength=m.columns))])
    rows = np.repeat(np.arange(len(m.start) - 1), np.diff(m.start))
    return Rows(start, rows if (m.at[1:] >= m.at[:-1]).all() else rows[np.argsort(m.at, kind="stable")], len(m.start) - 1)


def row_sizes(a: Rows, b: Rows) -> np.ndarray:
    """Entries that each row of the product expands to, before equal columns are merged."""
    total = np.concatenate([[0], np.cumsum(np.diff(b.start)[a.at])])
    return total[a.start[1:]] - total[a.start[:-1]]


def product(a: Rows, b: Rows, expanded: int = EXPANDED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of a times b, by rows, columns rising; blocks of rows that expand to about ``expanded`` entries."""
    work = np.concatenate([[0], np.cumsum(row_sizes(a, b))])
    r, n = 0, len(a.start) - 1
    while r < n:
        stop = min(n, max(r + 1, int(np.searchsorted(work, work[r] + expanded, "right")) - 1))
        named = a.at[a.start[r] : a.start[stop]]
        wide = b.start[named + 1] - b.start[named]
        row = np.repeat(np.repeat(np.arange(r, stop), np.diff(a.start[r : stop + 1])), wide)
        column = b.at[np.arange(len(row)) + np.repeat(b.start[named] - (np.cumsum(wide) - wide), wide)]
        key = row * b.columns + column
        if (key[1:] < key[:-1]).any():
            key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        yield key[first] // max(1, b.columns), key[first] % max(1, b.columns), np.diff(np.append(first, len(key)))
        r = stop


# ----------------------------------------------------------------------------------------- tokenizers


class _Coders:
    """Both tokenizers, and the bytes of every token."""

    def __init__(self, folder: str, file_a: str, file_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(f"{folder}/{file_a}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{file_b}")
        # byte-level alphabet: visible Latin-1 characters stand for themselves, the rest for 256, 257, ...
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        # where ids rise with the order of merges, they are ranks, and the quicker library gives the same ids
        with open(f"{folder}/{file_a}", encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        ranks = {self.bytes_a[i]: i for i in vocabulary.values()}
        plain = sorted(i for token, i in vocabulary.items() if len(token) == 1)
        ordered = made == sorted(made) and plain == list(range(256)) and len(ranks) == 256 + len(made)
        self.quick = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}) if ordered else None
        pieces = [self.b.id_to_piece(i) for i in range(self.b.piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def encode(self, slices: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each slice, which begins with a space; None where their bytes aren't those of the slice."""
        out = []
        if self.quick and max(map(len, slices)) <= 4 * SLICE:  # longer ones are runs without a cut
            a = self.quick.encode_ordinary_batch(slices, num_threads=1)
        else:
            a = (e.ids for e in self.a.encode_batch_fast(slices, add_special_tokens=False))
        b = self.b.encode([s[1:] for s in slices], num_threads=1)  # it adds the space
        for text, x, y in zip(slices, a, b):
            raw = text.encode()
            same = b"".join([self.bytes_a[i] for i in x]) == raw == b"".join([self.bytes_b[i] for i in y])
            out.append((np.array(x, np.int64), np.array(y, np.int64)) if same else None)
        return out


@functools.lru_cache(1)
def _coders(folder: str, file_a: str, file_b: str) -> _Coders:
    return _Coders(folder, file_a, file_b)


def _slices(text: str, size: int) -> Iterator[str]:
    """A text behind a space, cut before spaces between letters or digits."""
    at, text = 0, " " + text
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


# -------------------------------------------------------------------------------------------- stretches


class _Stretch(NamedTuple):
    """The tokens of some slices, and of each the number of tokens in either."""

    a: np.ndarray
    b: np.ndarray
    edges_a: np.ndarray
    edges_b: np.ndarray

    @classmethod
    def of(cls, slices: list[tuple[np.ndarray, np.ndarray]]) -> _Stretch:
        a, b = zip(*slices)
        edges = [np.concatenate([[0], np.cumsum([len(x) for x in side])]) for side in (a, b)]
        return cls(np.concatenate(a), np.concatenate(b), *edges)


class _Aligned:
    """Links and groups of a stretch. Slices end where tokens of both do, so nothing reaches from one into the next."""

    def __init__(self, s: _Stretch, size_a: np.ndarray, size_b: np.ndarray) -> None:
        self.s = s
        bytes_a, bytes_b = by_bytes(size_a[s.a]), by_bytes(size_b[s.b])
        common = np.intersect1d(bytes_a.start[1:], bytes_b.start[1:], assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, bytes_a.start[1:]), np.searchsorted(common, bytes_b.start[1:])
        self.groups_a, self.groups_b = by_groups(self.group_a, len(common)), by_groups(self.group_b, len(common))
        self.overlaps = [np.concatenate(x) for x in zip(*product(bytes_a, transposed(bytes_b)))]  # at most one link a byte

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Shared-group links (token of A, token of B, 1), some rows at a time."""
        return product(self.groups_a, transposed(self.groups_b))

    def counts(self) -> np.ndarray:
        """By slice: groups, overlap links, shared-group links."""
        s = self.s
        last = np.concatenate([[-1], self.group_a])[s.edges_a]
        links = B.per_doc(np.bincount(self.overlaps[0], minlength=len(s.a)), s.edges_a)
        return np.stack([np.diff(last), links, B.per_doc(row_sizes(self.groups_a, transposed(self.groups_b)), s.edges_a)])

    def text(self) -> tuple[bytes, np.ndarray]:
        """Groups as ``a1,a2|b1;`` one after the other, and where each slice's begin."""
        s, ga, gb = self.s, self.group_a, self.group_b
        ids, sign = np.empty(len(s.a) + len(s.b), np.int64), np.full(len(s.a) + len(s.b), ord(","), np.uint8)
        at_a = np.arange(len(ga)) + np.searchsorted(gb, ga, "left")
        at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")
        ids[at_a], ids[at_b] = s.a, s.b
        sign[at_a[np.append(ga[1:] != ga[:-1], True)]] = ord("|")
        sign[at_b[np.append(gb[1:] != gb[:-1], True)]] = ord(";")
        digits, length = _digits(int(ids.max()))
        rows, size = digits[ids], length[ids]
        rows[np.arange(len(ids)), size] = sign
        ends = np.concatenate([[0], np.cumsum(size + 1)])
        return rows[np.arange(rows.shape[1]) <= size[:, None]].tobytes(), ends[s.edges_a + s.edges_b]


@functools.lru_cache(4)
def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0, 1, ... as rows of bytes with room for a sign, and their number."""
    width = len(str(most)) + 1
    text = [str(i) for i in range(10 ** (width - 1))]
    return np.frombuffer("".join(t.ljust(width) for t in text).encode(), np.uint8).reshape(-1, width), np.array([len(t) for t in text])


class _Text:
    """What is known of a document so far."""

    def __init__(self) -> None:
        self.fine, self.numbers, self.hash = True, np.zeros(5, np.int64), None
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def settle(self) -> tuple[np.ndarray, np.ndarray, str]:
        """(pairs, times, groups_sha256): distinct pairs in order, how often each, and the hash."""
        if not self.fine or not self.pairs:
            self.numbers[:] = 0
            return np.zeros(0, np.int64), np.zeros(0, np.int64), ""
        if len(self.pairs) == 1:
            return self.pairs[0], self.times[0], self.hash.hexdigest()
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, place, np.concatenate(self.times))
        return pairs, times, self.hash.hexdigest()


def _stretches(texts: list[str | None], coders: _Coders, slice_size: int) -> Iterator[tuple[list[int], list[tuple[np.ndarray, np.ndarray] | None]]]:
    """(documents, tokens) of slices, about STRETCH characters at a time."""
    held, of, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _slices(text, slice_size) if text else ():
            held.append(piece)
            of.append(i)
            size += len(piece)
            if size > STRETCH:
                yield of, coders.encode(held)
                held, of, size = [], [], 0
    if held:
        yield of, coders.encode(held)


def _measure(texts: list[str | None], coders: _Coders, slice_size: int) -> list[_Text]:
    out = [_Text() for _ in texts]
    for of, slices in _stretches(texts, coders, slice_size):
        for i, s in zip(of, slices):
            out[i].fine &= s is not None
        good = [(i, s) for i, s in zip(of, slices) if s is not None]
        if not good:
            continue
        s = _Stretch.of([s for _, s in good])
        aligned = _Aligned(s, coders.size_a, coders.size_b)
        numbers, (said, begin) = aligned.counts(), aligned.text()
        row, column, _ = aligned.overlaps
        code = (np.searchsorted(s.edges_a, row, "right") - 1 << 2 * PAIR_BITS) | (s.a[row] << PAIR_BITS) | s.b[column]
        code, times = np.unique(code, return_counts=True)
        edges = np.searchsorted(code, np.arange(len(good) + 1) << 2 * PAIR_BITS)
        code &= (1 << 2 * PAIR_BITS) - 1
        for k, (i, tokens) in enumerate(good):
            text = out[i]
            text.numbers += (len(tokens[0]), len(tokens[1]), *numbers[:, k])
            text.pairs.append(code[edges[k] : edges[k + 1]])
            text.times.append(times[edges[k] : edges[k + 1]])
            if text.hash is None:
                text.hash = hashlib.sha256()
            else:
                text.hash.update(b";")
            text.hash.update(said[begin[k] : begin[k + 1] - 1])
    return out


# ------------------------------------------------------------------------------------------- operators


def token_links(docs: DataFrame, shared: bool = False, key: str = "doc_id", text: str = "text", folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """(key, a_at, b_at, a_id, b_id, n_bytes): all overlap links, or all shared-group links with ``n_bytes`` null; tokens are numbered from 0 in each document."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(folder, file_a, file_b)
        for batch in batches:
            for at in range(batch.num_rows):
                value = batch.column(1)[at].as_py()
                # the first pass tells whether the whole text has tokens
                if not value or not all(s is not None for _, part in _stretches([value], coders, SLICE) for s in part):
                    continue
                before = np.zeros(2, np.int64)
                for _, slices in _stretches([value], coders, SLICE):
                    s = _Stretch.of(slices)
                    aligned = _Aligned(s, coders.size_a, coders.size_b)
                    for row, column, size in aligned.shared() if shared else [aligned.overlaps]:
                        keys = batch.column(0).take(pa.array(np.full(len(row), at)))
                        size = pa.nulls(len(row), pa.int64()) if shared else pa.array(size)
                        yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (row + before[0], column + before[1], s.a[row], s.b[column])), size], names=["key", "a_at", "b_at", "a_id", "b_id", "n_bytes"])
                    before += len(s.a), len(s.b)

    fields = [T.StructField(c, T.LongType()) for c in ("a_at", "b_at", "a_id", "b_id", "n_bytes")]
    return narrow.mapInArrow(run, T.StructType([narrow.schema[0], *fields])).withColumnRenamed("key", key)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


def _packed(values: np.ndarray) -> bytes:
    """Small integers, compressed by planes of bytes, behind their number."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


def alignments(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B, block_bytes: int = BLOCK_BYTES, slice_size: int = SLICE) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256) of every row."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item = T.StructType([T.StructField("key", narrow.schema[0].dataType), *(T.StructField(c, T.LongType()) for c in _NUMBERS), T.StructField("sha", T.StringType()), T.StructField("pairs", T.IntegerType())])
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(item)), T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType()),
         T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.LongType()))]
    )

    def block_of(number: int, keys: pa.Array, texts: list[_Text]) -> pa.RecordBatch:
        pairs, times, sha = zip(*(t.settle() for t in texts))
        listed, place = np.unique(np.concatenate(pairs), return_inverse=True)
        size = np.array([len(p) for p in pairs])
        step = np.diff(place, prepend=0)
        first = (np.cumsum(size) - size)[size > 0]
        step[first] = place[first]  # places rise within a document
        numbers = np.stack([t.numbers for t in texts])
        columns = [keys, *(pa.array(numbers[:, c]) for c in range(len(_NUMBERS))), pa.array(sha, pa.string()), pa.array(size.astype(np.int32))]
        items = pa.StructArray.from_arrays(columns, names=["key", *_NUMBERS, "sha", "pairs"])
        listing = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        held = np.bincount(place, minlength=len(listed))
        cells = [pa.array([number]), listing(items), pa.array([_packed(step)], pa.binary()), pa.array([_packed(np.concatenate(times))], pa.binary()), listing(pa.array(listed)), listing(pa.array(held))]
        return pa.RecordBatch.from_arrays(cells, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, number = _coders(folder, file_a, file_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = B.buffers(batch.column(1))
            for a, b in B.slices(offsets, block_bytes):
                yield block_of(number, batch.column(0).slice(a, b - a), _measure(batch.column(1).slice(a, b - a).to_pylist(), coders, slice_size))
                number += 1

    blocks = materialize(narrow.mapInArrow(run, schema), "alignment-blocks")
    told = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.held").alias("n"))
    counts = materialize(told.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    first = F.shiftright("pair", PAIR_BITS)
    best = counts.groupBy(first.alias("a_id")).agg(F.max("n").alias("most"))  # one row for each id of A
    counts = counts.join(F.broadcast(best), first == F.col("a_id")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    asked = blocks.select(F.col("block").alias("asking"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("asking", "place", "n", "best")

    out = T.StructType([T.StructField(key, narrow.schema[0].dataType), *(T.StructField(c, T.LongType()) for c in (*_NUMBERS, "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType())])

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.combine_chunks()
        items = row["docs"].combine_chunks().flatten()
        size = np.asarray(items.field("pairs")).astype(np.int64)
        n, good = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        where = right["place"].to_numpy()
        n[where], good[where] = right["n"].to_numpy(), right["best"].to_numpy().astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(size)])
        step, times = (_unpacked(row[c][0].as_py()) for c in ("places", "times"))
        total = np.concatenate([[0], np.cumsum(step)])
        place = total[1:] - np.repeat(total[edges[:-1]], size)
        sums = [pa.array(B.per_doc(times * x[place], edges)) for x in (good, n)]
        return pa.Table.from_arrays([items.field("key"), *(items.field(c) for c in _NUMBERS), *sums, items.field("sha")], names=out.names)

    return blocks.select("block", "docs", "places", "times").groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(settle, out)


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    found = alignments(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
