"""Quotes found again in their texts, whatever became of the white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: All that Python takes for white space.
_SPACE = r"(?U)[\s\x1c-\x1f]"


def condensed(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE + "+", "")


def located(text: Column, quote: Column) -> Column:
    """(state, offset): *found* and where the quote begins in the text, from 0; or *not found*, *ambiguous* (it stands there twice, perhaps overlapping), *empty*, without an offset."""

    def where(pair: Column) -> Column:
        said, wanted = pair["t"], pair["q"]
        first = F.instr(said, wanted)
        state = F.when(wanted == "", "empty").when(first == 0, "not found").when(F.position(wanted, said, first + 1) > 0, "ambiguous").otherwise("found")
        # the only place: what stands before its characters in the text, with white space between any two
        pattern = F.concat(F.lit("(?sU)^(.*?)"), F.regexp_replace(wanted, r"(?s)(.)", r"\\Q$1\\E[\\s\\x1c-\\x1f]*"))
        return F.struct(state.alias("state"), F.when(state == "found", F.length(F.call_function("regexp_extract", pair["raw"], pattern, F.lit(1)))).cast("long").alias("offset"))

    pair = F.struct(condensed(text).alias("t"), condensed(quote).alias("q"), F.coalesce(text, F.lit("")).alias("raw"))
    return F.transform(F.array(pair), where)[0]


def assertion_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``error``: subject, value and link of an assertion must each be found once in its block, all in one block, and the link must hold the other two.

    Columns: subject, value and link with the suffixes _quote, _block and _text, the text of the
    block (null where there is no such block).
    """
    names = ("subject", "value", "link")
    marked = rows.withColumn("_at", F.struct(*(located(F.col(f"{n}_text"), F.col(f"{n}_quote"))["state"].alias(n) for n in names)))
    rules = []
    for n in names:
        state = F.col(f"_at.{n}")
        rules += [F.when(F.col(f"{n}_text").isNull(), F.lit(f"{n}: unknown block")), F.when(state != "found", F.concat(F.lit(f"{n}: "), state))]
    block = lambda n: F.col(f"{n}_block")
    link = condensed(F.col("link_quote"))
    rules.append(F.when(~block("subject").eqNullSafe(block("value")) | ~block("subject").eqNullSafe(block("link")), "spans of several blocks"))
    rules += [F.when(~F.contains(link, condensed(F.col(f"{n}_quote"))), F.lit(f"link lacks the {n}")) for n in ("subject", "value")]
    return marked.select(*rows.columns, F.coalesce(*rules).alias("error"))
