"""Substring deduplication with repeated-phrase automata.

Every window of words is dealt to one shard by the lowest hash among its phrases (see ``_repeats``),
with the words around it; windows whose lowest phrase no second text has can't recur and stay
behind. A shard confirms the recurring passages by counts of window hashes, compiles them into an
Aho-Corasick automaton over words, each word one symbol, and streams all texts it was dealt through
the automaton. What the automaton locates, and nothing else, decides: all but the first occurrence
of a passage's window cover their words. Hashes that collide only add passages without a second
occurrence.

So each window is read by one automaton only: documents times all automata would be quadratic.

Defined results: a null text has no words; of equal documents the one with the smallest id keeps
its words, and rows that share an id never remove each other's words unless the window repeats
within one text; a null id counts as larger than all ids; texts shorter than the window stay; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._repeats import Contexts, Repeats, covered_items, merged, per_row

WINDOW = 20
GRAM = 8
#: Symbols that one character can tell apart, with room for what is skipped.
SYMBOLS = 1_000_000


def _symbols(words: list[str]) -> tuple[str, int]:
    """(text, width): the words as symbols of ``width`` characters, equal words as equal symbols, none with character 0 first."""
    table: dict[str, int] = {}
    number = np.fromiter((table.setdefault(w, len(table) + 1) for w in words), np.int64, len(words))
    width = 1 if len(table) < SYMBOLS else 2
    digits = np.stack([number % SYMBOLS + (width - 1), number // SYMBOLS][:width], axis=1).reshape(-1)
    digits += np.where(digits >= 0xD800, 0x800, 0)  # no surrogates
    return digits.astype(np.uint32).tobytes().decode("utf-32-le"), width


def solve(c: Contexts, plan: Repeats) -> np.ndarray:
    """Whether each window of each context also starts earlier: in a smaller document, or before in its own."""
    windows = c.items.astype(np.int64) - plan.window + 1
    covered = np.zeros(int(windows.sum()), bool)
    # words of the contexts; every context is its words joined by one space
    start, end, first = B.word_spans(c.data, c.edges)
    before = np.cumsum(windows) - windows
    index = B.repeat_index(windows)
    begin = first[index] + np.arange(len(index)) - before[index]
    # passages that recur, confirmed by the counts of their windows' hashes
    words = B.prefix_hash(B.span_hash(B.prefix_hash(B.BYTE_VALUE[c.data]), start, end))
    code = B.span_hash(words, begin, begin + plan.window)
    order = np.argsort(code)
    same = code[order][1:] == code[order][:-1]
    recurring = begin[order[np.append(same, False) | np.append(False, same)]]
    if not len(recurring):
        return covered
    # the automaton of their words
    raw = c.data.tobytes().decode("latin-1")  # one character a byte
    text, width = _symbols([raw[a:b] for a, b in zip(start.tolist(), end.tolist())])
    automaton = ahocorasick.Automaton()
    for k, passage in enumerate(dict.fromkeys(text[b : b + plan.window * width] for b in (recurring * width).tolist())):
        automaton.add_word(passage, k)
    automaton.make_automaton()
    # all contexts run through it; it tells every occurrence
    which, stop = [], []
    for i, (a, b) in enumerate(zip((first[:-1] * width).tolist(), (first[1:] * width).tolist())):
        for last, k in automaton.iter(text, a, b):
            which.append(k)
            stop.append(last)
    hit, stop = np.array(which, np.int64), np.array(stop, np.int64) + 1
    hit, stop = hit[stop % width == 0], stop[stop % width == 0]
    at = stop // width - plan.window
    owner = np.searchsorted(first, at, "right") - 1
    place = c.lo[owner] + at - first[owner]
    order = np.lexsort((place, c.who[owner], c.doc[owner], hit))
    hit, doc, who = hit[order], c.doc[owner][order], c.who[owner][order]
    again = np.append(False, hit[1:] == hit[:-1])[: len(hit)]
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(hit)))) if len(hit) else hit
    late = doc > doc[head]
    late[1:] |= again[1:] & (doc[1:] == doc[:-1]) & (who[1:] == who[:-1])
    covered[(before[owner] + at - first[owner])[order[late]]] = True
    return covered


PLAN = Repeats("word", WINDOW, GRAM, within=True, solve=solve)
_OUT = "id long, tag long, n_words long, n_removed long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = B.buffers(batch.column(2))
        raw, rows = data.tobytes(), []
        for i, spans in enumerate(batch.column(3).to_pylist()):
            words = raw[offsets[i] : offsets[i + 1]].split()
            gone = merged(spans, len(words))
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
            rows.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, zip(*rows))], names=["id", "tag", "n_words", "n_removed", "kept_sha256"])


def repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", plan: Repeats = PLAN) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) for every row."""
    texts, rows, several = covered_items(docs, plan, key, text)
    cut = texts.mapInArrow(_cut, _OUT)
    whole = ~F.col("first") & (F.col("n_words") >= plan.window)  # all of it stands in a smaller document
    return per_row(rows, cut, several).select(
        F.col("key").alias(key), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def op6_phrases(spark, sf_dir: str) -> DataFrame:
    return repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
