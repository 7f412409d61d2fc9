"""JSON as Column functions: canonical text whose hash names a value, and look-ups in JSON of unknown shape.

Canonical: keys in code point order, no blanks, only quotes, backslashes and control characters
escaped, strings in Unicode NFC, fractions rounded to twelve places and written as short as reads
back. All but rare values stay in the JVM: a row with characters that NFC may change, or with a
fraction that isn't plain, goes through Python as an Arrow batch.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "canonical-json-v1"
PLACES = 12
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


#: Stretches between characters that NFC changes are told at once where they are so long.
STRETCH = 128


def _class(ranges: list[tuple[int, int]], negated: bool = False) -> str:
    return ("[^" if negated else "[") + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


@functools.lru_cache(1)
def _changeable() -> tuple[str, str]:
    """Two classes of characters: those that NFC changes, or that may join one before them; and these with all in between but for long stretches.

    The first has some hundred ranges, which are tried one by one for each character; the second few.
    """
    odd = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and (unicodedata.combining(chr(i)) or 0x1160 <= i <= 0x11FF or not unicodedata.is_normalized("NFC", chr(i)))]
    # vowel signs and the like have no combining class but do compose with the letter before them; what alone stands for another character composes with nothing
    odd += {ord(apart[-1]) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and not 0xAC00 <= i < 0xD7A4 and len(apart := unicodedata.normalize("NFD", chr(i))) > 1}
    ranges: list[list[int]] = []
    for i in sorted(set(odd)):
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    edges = [(-1, -1), *ranges, (0x110000, 0x110000)]
    calm = [(a[1] + 1, b[0] - 1) for a, b in zip(edges, edges[1:]) if b[0] - a[1] > STRETCH]
    return _class(ranges), _class(calm, negated=True)


def changeable(text: Column) -> Column:
    """Whether NFC may change a text; what is told by its length, or by a small class, goes no further."""
    exact, near = _changeable()
    # bound to a variable, as a text that is made of many parts must be made once
    return F.transform(F.array(text), lambda t: (F.octet_length(t) > F.length(t)) & t.rlike(near) & t.rlike(exact))[0]


def _quoted(text: Column) -> Column:
    said = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    rare = said
    for c in map(chr, range(32)):
        rare = F.replace(rare, F.lit(c), F.lit(_SHORT.get(c, f"\\u{ord(c):04x}")))
    return F.concat(F.lit('"'), F.when(said.rlike("[\\x00-\\x1F]"), rare).otherwise(said), F.lit('"'))


def _plain(x: Column) -> Column:
    """Whether a fraction has at most six places and is neither large nor tiny, or is no number."""
    return F.isnan(x) | (F.abs(x) == float("inf")) | ((F.abs(x) < 1e9) & (x == F.round(x, 6)) & ((x == 0) | (F.abs(x) >= 1e-3)))


def _fraction(x: Column) -> Column:
    shown = F.regexp_replace(F.abs(x).try_cast("decimal(22,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    signed = F.concat(F.when(x.cast("string").startswith("-"), "-").otherwise(""), shown)
    return F.when(F.isnan(x), "NaN").when(x == float("inf"), "Infinity").when(x == float("-inf"), "-Infinity").otherwise(signed)


def _text(x: Column, kind: T.DataType, fraction=_fraction) -> Column:
    if isinstance(kind, T.StructType):
        parts = []
        for n, name in enumerate(sorted(kind.names)):
            parts += [F.lit(("," if n else "") + json.dumps(name, ensure_ascii=False) + ":"), _text(x[name], kind[name].dataType, fraction)]
        out = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(x, lambda e: _text(e, kind.elementType, fraction)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_keys(x), lambda k: k))
        out = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda k: F.concat(_quoted(k), F.lit(":"), _text(F.element_at(x, k), kind.valueType, fraction))), ","), F.lit("}"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        out = fraction(x.cast("double"))
    elif isinstance(kind, (T.BooleanType, T.IntegralType)):
        out = x.cast("string")
    else:
        out = _quoted(x.cast("string"))
    return F.coalesce(out, F.lit("null"))


def _unusual(x: Column, kind: T.DataType) -> Column | None:
    """Whether a value holds fractions that aren't plain; None where its type has none."""
    if isinstance(kind, T.StructType):
        found = [u for f in kind.fields if (u := _unusual(x[f.name], f.dataType)) is not None]
        return functools.reduce(Column.__or__, found) if found else None
    if isinstance(kind, T.ArrayType):
        return None if _unusual(x, kind.elementType) is None else F.coalesce(F.exists(x, lambda e: _unusual(e, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return None if _unusual(x, kind.valueType) is None else F.coalesce(F.exists(F.map_values(x), lambda e: _unusual(e, kind.valueType)), F.lit(False))
    return F.coalesce(~_plain(x.cast("double")), F.lit(False)) if isinstance(kind, (T.DoubleType, T.FloatType)) else None


def _normal(value):
    if isinstance(value, str):
        return unicodedata.normalize("NFC", value)
    if isinstance(value, float):
        return round(value, PLACES)
    if isinstance(value, list):
        return [_normal(v) for v in value]
    return {unicodedata.normalize("NFC", k): _normal(v) for k, v in value.items()} if isinstance(value, dict) else value


def canonical_json(value: Column, kind: T.DataType, normal: bool = True) -> Column:
    """Canonical JSON of a value of a known type; with ``normal`` false strings stay as they are and fractions must be plain.

    Null values are written as null. Numbers without a fraction, booleans, strings, fractions, and
    structs, arrays and maps of them; other types by their text.
    """
    quick = _text(value, kind)
    if not normal:
        return quick
    given = _text(value, kind, lambda x: x.cast("string"))  # JSON, with fractions as Python reads them

    def slow(said: pd.Series) -> pd.Series:
        dump = functools.partial(json.dumps, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        return said.map(lambda s: dump(_normal(json.loads(s))), na_action="ignore")

    rare = changeable(quick)
    fractions = _unusual(value, kind)
    rare = rare if fractions is None else rare | fractions
    return F.coalesce(F.pandas_udf(slow, T.StringType())(F.when(rare, given)), quick)


def canonical_digest(value: Column, kind: T.DataType, version: str = VERSION) -> Column:
    """SHA-256 of the canonical JSON of a value and the version of these rules."""
    return F.sha2(F.concat(F.lit('{"normalization_version":' + json.dumps(version) + ',"value":'), canonical_json(value, kind), F.lit("}")), 256)


# ------------------------------------------------------------------------------------- unknown shapes


def at(document: Column, path: str) -> Column:
    """What JSON (a variant) holds at a path, as a variant; null where a step is missing or isn't an object."""
    return F.try_variant_get(document, path, "variant")


def said(value: Column) -> Column:
    """A variant's string; null where it is anything else."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def items(value: Column) -> Column:
    """A variant's list; null where it is anything else."""
    return F.when(F.schema_of_variant(value).startswith("ARRAY<"), F.try_variant_get(value, "$", "array<variant>"))
