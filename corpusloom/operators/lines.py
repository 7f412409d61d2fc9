"""Order-dependent line operators: folds over ordered arrays, and the few that need Python."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import stripped

MOST_LINES, GAP = 40, 0.8
_SEGMENT = "struct<first_pos:bigint,lines:bigint,page:bigint,block_id:bigint,x0:bigint,y0:bigint,x1:bigint,y1:bigint,last:bigint,text:string>"


def merge_wrapped(lines: DataFrame, boilerplate: str | None = None, within_blocks: bool = True) -> DataFrame:
    """Join wrapped lines of a block: (doc_id, first_pos, lines, y1, text_sha).

    A line joins the segment above if it is close below it, overlaps it sideways and the segment has
    fewer than 40 lines. The segment's box grows with it, so that this is a fold over the page's
    lines in order, not a comparison of neighbours. Blank lines, and lines that the boolean column
    ``boilerplate`` marks, end a segment and are in none. Lines without a box or a block stay alone.
    Without ``within_blocks`` blocks don't matter, and blank lines are lines like any other.
    """
    skip = (stripped(F.coalesce("text", F.lit(""))) == "") | (F.coalesce(boilerplate, F.lit(False)) if boilerplate else F.lit(False))
    lines = lines.select("doc_id", "page", F.struct("pos", "block_id", F.coalesce("text", F.lit("")).alias("text"), "x0", "y0", "x1", "y1", (skip if within_blocks else F.lit(False)).alias("skip")).alias("line"))
    pages = lines.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    none = F.lit(None).cast(_SEGMENT)
    start = F.struct(F.array().cast(f"array<{_SEGMENT}>").alias("done"), none.alias("cur"))

    def begin(line):
        return F.struct(line["pos"].alias("first_pos"), F.lit(1).cast("long").alias("lines"), F.lit(0).cast("long").alias("page"), line["block_id"].alias("block_id"), *(line[c].alias(c) for c in ("x0", "y0", "x1", "y1")), line["pos"].alias("last"), line["text"].alias("text")).cast(_SEGMENT)

    def step(acc, line):
        cur = acc["cur"]
        gap = line["y0"] - cur["y1"]
        fits = (
            cur.isNotNull() & (cur["lines"] < MOST_LINES) & ((cur["block_id"] == line["block_id"]) if within_blocks else F.lit(True)) & (gap >= -0.5)
            & (gap <= F.greatest(cur["y1"] - cur["y0"], F.lit(1)) * GAP) & (F.least(cur["x1"], line["x1"]) - F.greatest(cur["x0"], line["x0"]) > 0)
        )
        space = F.when(cur["text"].endswith(" ") | line["text"].startswith(" "), "").otherwise(" ")
        joined = F.struct(
            cur["first_pos"].alias("first_pos"), (cur["lines"] + 1).alias("lines"), cur["page"].alias("page"), cur["block_id"].alias("block_id"),
            F.least(cur["x0"], line["x0"]).alias("x0"), cur["y0"].alias("y0"), F.greatest(cur["x1"], line["x1"]).alias("x1"), line["y1"].alias("y1"),
            line["pos"].alias("last"), F.concat(cur["text"], space, line["text"]).alias("text"),
        ).cast(_SEGMENT)
        closed = F.when(cur.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(cur)))
        blank = line["skip"]
        return F.struct(F.when(blank | ~F.coalesce(fits, F.lit(False)), closed).otherwise(acc["done"]).alias("done"), F.when(blank, none).when(F.coalesce(fits, F.lit(False)), joined).otherwise(begin(line)).alias("cur"))

    folded = F.aggregate("lines", start, step, lambda acc: F.when(acc["cur"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["cur"]))))
    each = pages.select("doc_id", F.explode(folded).alias("s"))
    return each.select("doc_id", "s.first_pos", "s.lines", "s.y1", F.sha2("s.text", 256).alias("text_sha"))


# Marks behind which a line that is too long is cut.
BREAKS = (" ", "\t", "|", ".", "。", "!", "?", "！", "？", ";", "；")
#: Characters of a line at most.
MOST_CHARS = 4096


def _pieces(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` characters that make up the text: cut behind the last mark, or hard where that is before the middle."""
    out, at = [], 0
    while len(text) - at > most:
        cut = max(text.rfind(mark, at, at + most) for mark in BREAKS) + 1 - at
        cut = cut if cut >= most // 2 else most
        out.append(text[at : at + cut])
        at += cut
    return [*out, text[at:]] if at < len(text) else out


def split_long(docs: DataFrame, most: int = MOST_CHARS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_id, text): the lines of every text, numbered from 0, none longer than ``most`` characters.

    All kinds of line breaks are one; blank lines don't count; nothing of the others is dropped or rewritten.
    """
    narrow = docs.select(F.col(key).alias("key"), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\r\n?", "\n").alias("text"))
    # a text without a long line stays in the JVM
    long = narrow.where(F.length("text") > most)
    lines = F.filter(F.split("text", "\n"), lambda t: stripped(t) != "")
    short = narrow.where(F.length("text") <= most).select("key", F.posexplode(lines).alias("line_id", "text")).select("key", F.col("line_id").cast("long").alias("line_id"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, said in zip(batch.key, batch.text):
                pieces = [p for line in said.split("\n") if line.strip() for p in _pieces(line, most)]
                yield pd.DataFrame({"key": [k] * len(pieces), "line_id": range(len(pieces)), "text": pieces})

    cut = long.mapInPandas(run, T.StructType([long.schema[0], T.StructField("line_id", T.LongType()), T.StructField("text", T.StringType())]))
    return short.unionByName(cut).withColumnRenamed("key", key)


def cell_lines(items: DataFrame, most: int = 120) -> DataFrame:
    """(l_orderkey, line, n_rows): rows of cells written with bars, flushed before a line grows past ``most``."""
    cells = F.concat_ws(" | ", F.col("l_linenumber").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"), F.format_string("%.2f", "l_extendedprice"))
    rows = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", cells.alias("cells")))).alias("rows"))
    state = "struct<done:array<string>,cur:string>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur")).cast(state)

    def step(acc, row):
        longer = F.when(acc["cur"] == "", row["cells"]).otherwise(F.concat(acc["cur"], F.lit(" || "), row["cells"]))
        full = (acc["cur"] != "") & (F.length(longer) > most)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"]).alias("done"), F.when(full, row["cells"]).otherwise(longer).alias("cur")).cast(state)

    flushed = F.aggregate("rows", start, step, lambda acc: F.when(acc["cur"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["cur"]))))
    return rows.select("l_orderkey", F.posexplode(flushed).alias("line", "said")).select("l_orderkey", "line", "said")


def fragment_presence(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, kept): whether a turn's text survives in the next one, whole or, if long, as a subsequence."""
    nxt = turns.select(F.col("conv_id"), (F.col("turn") - 1).alias("turn"), F.col("text").alias("later"))
    pairs = turns.select("conv_id", "turn", "text").join(nxt, ["conv_id", "turn"])

    def has(part: str, whole: str) -> bool:
        part, whole = "".join(part.split()), "".join(whole.split())
        if part in whole:
            return True
        if len(part) < 20:
            return False
        starts = [i for i, c in enumerate(whole) if c == part[0]] if len(part) < 80 else [0]
        for i in starts:
            it = iter(whole[i : i + len(part) + 256] if len(part) < 80 else whole)
            if all(c in it for c in part):
                return True
        return False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"conv_id": b.conv_id, "turn": b.turn, "kept": [has(x or "", y or "") for x, y in zip(b.text, b.later)]})

    return pairs.mapInPandas(run, "conv_id long, turn long, kept boolean")


def primary_attachment(parts: DataFrame) -> DataFrame:
    """(brand, chosen, score): of a brand's names that most like its type; the first of equals wins."""
    pairs = parts.select("p_partkey", "p_brand", "p_type", "p_name")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(score=[difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(b.p_type, b.p_name)])[["p_partkey", "p_brand", "p_name", "score"]]

    scored = pairs.mapInPandas(run, "p_partkey long, p_brand string, p_name string, score double")
    best = scored.groupBy("p_brand").agg(F.max_by(F.struct("p_name", "score"), F.struct("score", -F.col("p_partkey"))).alias("b"))
    return best.select(F.col("p_brand").alias("brand"), F.col("b.p_name").alias("chosen"), F.col("b.score").alias("score"))
