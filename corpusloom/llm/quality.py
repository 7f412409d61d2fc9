"""Quality rules: clean line by line first, then judge the document by what it lost.

Every line that has a word is tested for punctuation, navigation and boilerplate. Failing lines
are removed; a document that loses more than ``max_lost`` per cent of its word characters, or
that fails the base rules (too short, too repetitive), is rejected. Rules look at one line or one
document only, so the work is a single pass over the table without any exchange.

Defined results: a null or empty text has no words and fails the base rules; a document without a
failing line keeps its text unchanged, otherwise its surviving lines are joined by a newline;
repeated rows are judged one by one; an empty table gives an empty table. Columns other than the
text are passed through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _bytes as B


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    max_lost_percent: int = 50
    #: Marks ([#*$%&|<>] and !) in a line: at least so many, and over one for two words.
    min_marks: int = 3
    #: Separators (| and >) in a line: at least so many, and one for three words or more.
    min_separators: int = 3


#: A line that holds one of these phrases, in any case of A-Z, is boilerplate.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "released under the",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of use",
    "this work is licensed",
)
#: A line of prose ends with one of these characters.
TERMINAL = (".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "。", "！", "？")

_SYMBOLS = "#*$%&|<>"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _set(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_SYMBOL, _MARK, _SEPARATOR = _set(_SYMBOLS), _set(_SYMBOLS + "!"), _set("|>")
_ENDS = {n: np.array([int.from_bytes(t.encode(), "big") for t in TERMINAL if len(t.encode()) == n], np.int64) for n in (1, 2, 3)}


def _ends_prose(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the bytes before each ``end`` are a terminal character."""
    wide = data.astype(np.int64)
    code, out = np.zeros(len(end), np.int64), np.zeros(len(end), bool)
    for n in (1, 2, 3):
        code = code + (wide[np.maximum(end - n, 0)] << (8 * (n - 1)))
        out |= np.isin(code, _ENDS[n])
    return out


@dataclass
class Measured:
    counts: dict[str, np.ndarray]
    base_failed: np.ndarray
    kept: np.ndarray
    line_doc: np.ndarray
    line_start: np.ndarray
    line_end: np.ndarray
    line_ok: np.ndarray


def measure(data: np.ndarray, offsets: np.ndarray, rules: QualityRules) -> Measured:
    """Counts, verdicts and line verdicts of a slice of documents."""
    n_docs = len(offsets) - 1
    start, end, first = B.word_spans(data, offsets)
    n_words = np.diff(first)
    doc = B.repeat_index(n_words)
    inside = ~B.SPACE[data]
    chars = B.per_doc(inside & ((data & 0xC0) != 0x80), offsets)

    # lines that have a word
    breaks = np.flatnonzero(data == 10)
    line_of_word = np.searchsorted(breaks, start) + doc
    head = np.flatnonzero(np.diff(line_of_word, prepend=-1)) if len(start) else np.zeros(0, np.int64)
    line_words = np.diff(np.append(head, len(start)))
    line_doc = doc[head]
    padded = np.concatenate([[-1], breaks, [len(data)]])
    at = np.searchsorted(breaks, start[head])
    line_start = np.maximum(padded[at] + 1, offsets[line_doc])
    line_end = np.minimum(padded[at + 1], offsets[line_doc + 1])
    prefix = B.prefix_hash(B.BYTE_VALUE[data])
    repeated_line, _ = B.first_seen(B.span_hash(prefix, line_start, line_end), line_doc)

    def within(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return total[line_end] - total[line_start]

    marks, separators = within(_MARK), within(_SEPARATOR)
    ok = _ends_prose(data, end[head + line_words - 1]) if len(head) else np.zeros(0, bool)
    ok &= (marks < rules.min_marks) | (2 * marks <= line_words)
    ok &= (separators < rules.min_separators) | (3 * separators < line_words)
    ok &= ~repeated_line
    lowered = data.tobytes().lower()
    for phrase in map(str.encode, BOILERPLATE):
        found = lowered.find(phrase)
        while found >= 0:
            line = int(np.searchsorted(line_start, found, "right")) - 1
            if line >= 0 and found + len(phrase) <= line_end[line]:
                ok[line] = False
            found = lowered.find(phrase, found + 1)

    # words in windows that are found twice or more in the document
    k = rules.window
    word_hash = B.span_hash(prefix, start, end)
    last = first[1:][doc]
    begins = np.flatnonzero(np.arange(len(start)) + k <= last)
    _, twice = B.first_seen(B.span_hash(B.prefix_hash(word_hash), begins, begins + k), doc[begins])
    in_repeat = B.covered(begins[twice], k, len(start))

    char_total = np.concatenate([[0], np.cumsum(inside & ((data & 0xC0) != 0x80))])
    lost = np.bincount(line_doc, weights=np.where(ok, 0, char_total[line_end] - char_total[line_start]), minlength=n_docs)[:n_docs].astype(np.int64)
    counts = {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": B.per_doc(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_doc[repeated_line], minlength=n_docs)[:n_docs],
        "n_repeat_words": B.per_doc(in_repeat, first),
    }
    failed = (n_words < rules.min_words) | (100 * counts["n_repeat_words"] > rules.max_repeat_percent * n_words)
    kept = ~failed & (100 * lost <= rules.max_lost_percent * chars)
    counts["lost_chars"] = lost
    return Measured(counts, failed, kept, line_doc, line_start, line_end, ok)


def quality_measures(docs: DataFrame, rules: QualityRules = QualityRules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, counts, lost_chars, base_failed, kept."""
    narrow = docs.select(docs[key], docs[text].alias("text"))
    fields = [narrow.schema[0], *(T.StructField(c, T.LongType()) for c in (*_COUNTS, "lost_chars")), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.buffers(batch.column(1))
            for i, j in B.slices(offsets):
                m = measure(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], rules)
                columns = [pa.array(m.counts[c].astype(np.int64)) for c in (*_COUNTS, "lost_chars")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns, pa.array(m.base_failed), pa.array(m.kept)], names=[f.name for f in fields])

    return narrow.mapInArrow(run, T.StructType(fields))


def clean_documents(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents that pass, with their failing lines removed; ``length``, if present, follows the text."""
    where = docs.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.buffers(batch.column(where))
            for i, j in B.slices(offsets):
                piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                m = measure(piece, at, rules)
                keep = np.flatnonzero(m.kept)
                if not len(keep):
                    continue
                raw, texts = piece.tobytes(), []
                low, high = np.searchsorted(m.line_doc, keep), np.searchsorted(m.line_doc, keep, "right")
                for d, a, b in zip(keep, low, high):
                    if m.line_ok[a:b].all():
                        texts.append(raw[at[d] : at[d + 1]].decode())
                    else:
                        texts.append(b"\n".join(raw[m.line_start[x] : m.line_end[x]] for x in range(a, b) if m.line_ok[x]).decode())
                columns = [c.slice(i, j - i).take(pa.array(keep)) for c in batch.columns]
                columns[where] = pa.array(texts, batch.schema.field(where).type)
                if counted is not None:
                    columns[counted] = pa.array([len(t) for t in texts], batch.schema.field(counted).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_measures(docs).select("doc_id", *_COUNTS, "base_failed", "kept")


OP5_SQL = (
    r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM w),
lines AS (SELECT doc_id, unnest(range(len(a))) AS no, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM w)),
l AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
        length(regexp_replace(line, '[^#*$%&|<>!]', '', 'g')) AS marks, length(regexp_replace(line, '[^|>]', '', 'g')) AS separators,
        length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        row_number() OVER (PARTITION BY doc_id, line ORDER BY no) > 1 AS again
      FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
j AS (SELECT doc_id, count(*) FILTER (again)::BIGINT AS n_dup_lines,
        coalesce(sum(chars) FILTER (NOT (regexp_matches(line, '[.!?:;"''\)\]…”’»。！？][\x20\x09-\x0D]*$') AND (marks < 3 OR 2 * marks <= words)
          AND (separators < 3 OR 3 * separators < words) AND NOT again
          AND NOT regexp_matches(line, '(?i)(__PHRASES__)'))), 0) AS lost FROM l GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM h) GROUP BY doc_id),
a AS (SELECT b.*, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM b LEFT JOIN j USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= 50 * word_chars AS kept
FROM a
"""
).replace("__PHRASES__", "|".join(BOILERPLATE))
