"""Words that speak for a clause or a status, looked for line by line in one pass."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.dims import CLAUSE_WORDS, MONEY, NOT_COUNTED, STATUS_RULES

#: Clauses for which an amount of money is evidence, too.
MONEY_CLAUSES = ("5", "7")
#: Between words that were found; no word has it.
_SEP = "\x1f"


def _without(text: Column, phrases: Sequence[str]) -> Column:
    for phrase in sorted(phrases, key=len, reverse=True):
        text = F.replace(text, F.lit(phrase), F.lit(""))
    return text


def keyword_evidence(lines: DataFrame, text: str = "text", words: Mapping[str, Sequence[str]] = CLAUSE_WORDS, not_counted: Mapping = NOT_COUNTED) -> DataFrame:
    """``lines`` without their text, a row for each clause with evidence: (clause, words, money, score).

    A word counts where the text has it outside of the phrases in which it means something else, and
    unless a longer word that counts holds it. Longer words score more, money one more. Each word is
    looked for once; names and scores come from the words that were found.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    found = {}
    for clause, listed in words.items():
        hits = [F.when(F.contains(_without(said, not_counted.get((clause, w), ())), F.lit(w)), w) for w in listed]
        found[clause] = F.concat_ws(_SEP, *hits)
    rest = [c for c in lines.columns if c != text]
    hit = lines.select(*rest, F.struct(*(array.alias(f"c{clause}") for clause, array in found.items())).alias("_hits"), said.rlike(MONEY).alias("_money"))
    # most lines have nothing and go here
    hit = hit.where(F.col("_money") | (F.concat(*(F.col(f"_hits.c{clause}") for clause in words)) != ""))

    def evidence(clause: str) -> Column:
        array = F.filter(F.split(F.col(f"_hits.c{clause}"), _SEP), lambda w: w != "")
        own = F.filter(array, lambda w: ~F.exists(array, lambda o: (o != w) & F.contains(o, w)))
        money = F.col("_money") if clause in MONEY_CLAUSES else F.lit(False)
        score = F.aggregate(own, F.lit(0), lambda acc, w: acc + F.least(F.lit(4), F.lit(2) + F.floor(F.length(w) / 4).cast("int"))) + F.when(money, 1).otherwise(0)
        return F.struct(F.lit(clause).alias("clause"), F.array_join(own, ",").alias("words"), money.alias("money"), score.alias("score"))

    each = hit.select(*rest, F.explode(F.array(*(evidence(c) for c in words))).alias("_e"))
    return each.select(*rest, "_e.*").where("words <> '' OR money")


def _first(rows: DataFrame, most: int, by: Sequence[str], *order: str) -> DataFrame:
    """The first ``most`` rows of each group."""
    return rows.withColumn("_nth", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_nth") <= most).drop("_nth")


def withholding_reasons(lines: DataFrame, quotes: int = 3, chars: int = 120) -> DataFrame:
    """(doc, clause, reason) of ``lines`` (line_key, doc, text): the first quotes of the first lines with evidence, which travel with it."""
    quoted = keyword_evidence(lines.select("line_key", "doc", "text", F.substring("text", 1, chars).alias("quote"))).select("doc", "clause", "line_key", "quote")
    first = _first(quoted, quotes, ("doc", "clause"), "line_key", "quote")
    said = F.transform(F.array_sort(F.collect_list(F.struct("line_key", "quote"))), lambda x: x["quote"])
    return first.groupBy("doc", "clause").agg(F.array_join(said, "; ").alias("said")).select("doc", "clause", F.concat(F.lit("제"), "clause", F.lit("호: "), "said").alias("reason"))


def status_hints(lines: DataFrame, most: int, rules: Mapping[str, Sequence[tuple[str, Sequence[str]]]] = STATUS_RULES) -> DataFrame:
    """(doc_type, doc, line_key, status) of ``lines`` (line_key, doc, doc_type, text): each line and status of its type once, the first ``most`` of a document.

    A line meets only the words of its own type, so all types are looked for in one pass.
    """
    hints = F
    for kind, statuses in rules.items():
        found = (F.when(functools.reduce(Column.__or__, (F.contains("text", F.lit(w)) for w in words)), F.struct(F.lit(n).alias("nth"), F.lit(status).alias("status"))) for n, (status, words) in enumerate(statuses))
        hints = hints.when(F.col("doc_type") == kind, F.array(*found))
    each = lines.select("doc_type", "doc", "line_key", F.explode(F.array_compact(hints)).alias("_h")).select("doc_type", "doc", "line_key", "_h.*")
    return _first(each, most, ("doc",), "line_key", "nth").drop("nth")


def status_cells(hints: DataFrame, cells: DataFrame) -> DataFrame:
    """``cells`` (doc_type, status) with (spans, documents, state) of their :func:`status_hints`, counted document by document first."""
    docs = hints.groupBy("doc", "doc_type", "status").agg(F.count("line_key").alias("n"))
    counted = docs.groupBy("doc_type", "status").agg(F.sum("n").alias("_spans"), F.count("doc").alias("_docs"))
    spans, documents = (F.coalesce(c, F.lit(0)).cast("long") for c in ("_spans", "_docs"))
    joined = cells.join(counted, ["doc_type", "status"], "left")
    return joined.select("doc_type", "status", spans.alias("spans"), documents.alias("documents"), F.when(spans == 0, "zero_matches").otherwise("counted").alias("state"))
