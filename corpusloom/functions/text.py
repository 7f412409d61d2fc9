"""Text normalisation as Column functions: everything stays inside the JVM."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECTION = "\n<SECTION:BODY>\n"
#: Tab, vertical tab, form feed, and the spaces of Unicode (category Zs).
BLANKS = "\t\x0b\x0c " + "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
#: Replacements in this order; article numbers (제9조) stay as they are.
PLACEHOLDERS = (
    (r"제\s*\d{4}-\d+\s*호", "<DOCNO>"),
    (r"[가-힣A-Za-z]{2,15}-\d{2,}(?:\(\d{4}\))?", "<DOCNO>"),
    (r"\d{4}[가-힣]{1,3}\d+", "<CASE_NO>"),
    (r"\d{2,4}-\d{3,4}-\d{4}", "<PHONE>"),
    (r"\d{4}\s*[.\-/]\s*\d{1,2}\s*[.\-/]\s*\d{1,2}\.?", "<DATE>"),
    (r"\d{4}년\s*\d{1,2}월\s*\d{1,2}일", "<DATE>"),
    (r"\d{1,3}(?:,\d{3})+\s*원|\d+\s*(?:만|억)\s*원|\d+\s*원", "<MONEY>"),
    (r"\d+\s*명", "<COUNT>"),
)
#: What a text must have for the replacement of the same place to find anything.
NEEDED = ("호", "-", "[0-9][가-힣]", "-", "[0-9]\\s*[./-]", "년", "원", "명")
NUMBER = {"compat": r"\d+(?!\s*(?:조|항|호))", "strict": r"\d++(?!\s*(?:조|항|호))"}


def _with(text: Column, function) -> Column:
    """``function(text)``, with the text bound to a variable, so that it is computed once however often it is used."""
    return F.transform(F.array(text), function)[0]


def _where(text: Column, part: str, function) -> Column:
    """``function(text)`` where the text has ``part``, which is quick to find; else the text."""
    return _with(text, lambda t: F.when(t.contains(part), function(t)).otherwise(t))


def _has(text: Column, *parts: str) -> Column:
    return functools.reduce(Column.__or__, (text.contains(p) for p in parts))


def _blank_edges(text: Column) -> Column:
    """Whether a line may begin or end with a blank: a space does, or there are other blanks."""
    wide = [c for c in BLANKS if ord(c) > 127]
    return _has(text, "\n ", " \n", "\t", "\x0b", "\x0c") | text.startswith(" ") | text.endswith(" ") | ((F.octet_length(text) > F.length(text)) & _has(text, *wide))


def canonical(text: Column) -> Column:
    """One kind of line break, lines trimmed, runs of blanks and of empty lines reduced to one."""
    text = _where(F.coalesce(text, F.lit("")), "\r", lambda t: F.regexp_replace(t, r"\r\n?", "\n"))
    text = _with(text, lambda t: F.when(_blank_edges(t), F.array_join(F.transform(F.split(t, "\n"), lambda line: F.trim(line, F.lit(BLANKS))), "\n")).otherwise(t))
    text = _with(text, lambda t: F.when(_has(t, "  ", "\t", "\u00a0"), F.regexp_replace(t, "[ \t\u00a0]{2,}|[\t\u00a0]", " ")).otherwise(t))
    text = _where(text, "\n\n\n", lambda t: F.regexp_replace(t, r"\n{3,}", "\n\n"))
    return F.trim(text, F.lit("\n"))


def combined(title: Column, body: Column) -> Column:
    return F.concat(canonical(title), F.lit(SECTION), canonical(body))


def raw_hash(title: Column, body: Column) -> Column:
    return F.sha2(combined(title, body), 256)


def with_placeholders(text: Column, numbers: str = "compat") -> Column:
    """Typed placeholders for what varies between copies of a form.

    ``compat`` keeps only the last digit of an article number of several digits; ``strict`` all.
    """

    def replaced(said: Column) -> Column:
        for (pattern, by), needed in zip(PLACEHOLDERS, NEEDED):
            found = (lambda t: t.contains(needed)) if len(needed) == 1 else (lambda t: t.rlike(needed))  # noqa: B023
            said = _with(said, lambda t: F.when(found(t), F.regexp_replace(t, pattern, by)).otherwise(t))  # noqa: B023
        return F.regexp_replace(said, NUMBER[numbers], "<NUM>")

    # every pattern needs a digit, which most texts don't have
    return _with(text, lambda t: F.when(t.rlike("[0-9]"), replaced(t)).otherwise(t))


def normalized_hash(text: Column, agency: Column, numbers: str = "compat") -> Column:
    """Hash of a :func:`combined` text without what varies between copies."""
    named = F.when(F.coalesce(agency, F.lit("")) == "", text).otherwise(F.replace(text, agency, F.lit("<AGENCY>")))
    return F.sha2(with_placeholders(named, numbers), 256)


def bucket(value: Column, edges: tuple[int, ...]) -> Column:
    """"0", "0-2", "3-5", .. or "11+"; edges are the upper ends."""
    label = F.when(value == 0, F.lit("0"))
    low = 0
    for edge in edges:
        label = label.when(value <= edge, F.lit(f"{low}-{edge}"))
        low = edge + 1
    return label.otherwise(F.lit(f"{low}+"))


def paragraph_bucket(body: Column) -> Column:
    return bucket(F.size(F.filter(F.split(F.coalesce(body, F.lit("")), r"\n\s*\n"), lambda p: p.rlike(r"\S"))), (2, 5, 10))


def list_bucket(body: Column) -> Column:
    return bucket(F.size(F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), lambda p: p.rlike(r"^\s*(?:\d{1,3}[.)]|[①-⑳]|[가-힣]\.)\s+"))), (2, 5, 10))


def length_bucket(body: Column) -> Column:
    return bucket(F.length(F.coalesce(body, F.lit(""))), (200, 500, 1000, 2000, 4000))


def structure_fingerprint(template: Column, doc_type: Column, body: Column, version: str = "v1") -> Column:
    """Hash of a flat object with sorted keys, as canonical JSON."""
    value = F.to_json(F.struct(length_bucket(body).alias("body_length_bucket"), F.coalesce(doc_type, F.lit("")).alias("doc_type"), list_bucket(body).alias("numbered_list_count_bucket"), paragraph_bucket(body).alias("paragraph_count_bucket"), F.coalesce(template, F.lit("")).alias("template_id")))
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(F.lit(f'{{"normalization_version":"{version}","value":'), value, F.lit("}")), 256))


def without_garbage(text: Column) -> Column:
    """No control characters but line breaks and tabs, no replacement or private-use characters."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F\\x{FFFD}\\x{E000}-\\x{F8FF}]", "")


def safe_stem(raw: Column, fallback: Column) -> Column:
    """A file name's stem without characters that file systems refuse."""
    value = F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r'[<>:"/\\|?*\x00-\x1F]', "_"), r"^[ .]+|[ .]+$", "")
    value = F.when(F.lower(value).endswith(".pdf"), F.regexp_replace(value, r"(?i)\.pdf$|[ .]+\.pdf$", "")).otherwise(value)
    return F.when(value == "", fallback).otherwise(value)


def nfc(text: Column) -> Column:
    """Unicode NFC; only texts with combining marks or jamo go through Python, as Arrow batches, all others as nulls."""
    odd = (F.octet_length(text) > F.length(text)) & text.rlike("[\\x{0300}-\\x{036F}\\x{1100}-\\x{11FF}\\x{3099}\\x{309A}\\x{0340}\\x{212B}]")

    def normal(said: pd.Series) -> pd.Series:
        return said.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.coalesce(F.pandas_udf(normal, T.StringType())(F.when(odd, text)), text)


def to_nfc(df: DataFrame, column: str) -> DataFrame:
    """The table with one column in Unicode NFC."""
    return df.withColumn(column, nfc(F.col(column)))


#: White space at the ends of texts, as Python strips it.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def stripped(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITE))
