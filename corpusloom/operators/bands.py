"""Spans of a page put together to lines by bands of height: first-match clustering in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped

#: Spans whose tops differ by less than this are on one line.
HEIGHT = 3.0


def band_lines(spans: DataFrame, page: Sequence[str], order: str = "pos", x: str = "x", y: str = "y", text: str = "text", height: float = HEIGHT) -> DataFrame:
    """(page.., line, spans, text) of spans (page.., order, x, y, text): lines from top to bottom, parts from left to right.

    A span, in order, joins the first band that was opened whose top is less than ``height`` away,
    or else opens a band with its own top. Bands may overlap, so this is no partition of the page
    by y: which bands there are depends on the order. A band's top never moves, and a span that
    opened one is in it; so the tops alone are folded, and each span then looks up its band among
    all of them, as a band that was opened later comes later in the list.

    Blank spans don't count; a null coordinate is 0; ties in y and x keep the order; equal
    orders go by x, y and text. A page is one
    row's array, as its spans meet in one fold.
    """
    said = stripped(F.coalesce(F.col(text), F.lit("")))
    at = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    rows = spans.select(*page, F.struct(F.col(order).alias("o"), at(x).alias("x"), at(y).alias("y"), said.alias("t")).alias("span")).where("span.t <> ''")
    pages = rows.groupBy(*page).agg(F.array_sort(F.collect_list("span")).alias("spans"))
    near = lambda top, y: F.abs(top - y) < F.lit(height)
    none = F.array().cast("array<double>")
    tops = F.aggregate("spans", none, lambda acc, s: F.when(F.exists(acc, lambda top: near(top, s["y"])), acc).otherwise(F.concat(acc, F.array(s["y"]))))
    pages = pages.withColumn("tops", tops)
    # bands by (top, order of opening); the place of a band is its line
    bands = F.array_sort(F.transform("tops", lambda top, i: F.struct(top.alias("top"), i.alias("i"))))
    placed = F.transform("spans", lambda s: F.struct(F.array_position(F.transform("tops", lambda top: near(top, s["y"])), True).alias("band"), s["x"].alias("x"), s["o"].alias("o"), s["t"].alias("t")))
    pages = pages.select(*page, bands.alias("bands"), F.array_sort(placed).alias("placed"))
    lines = F.transform("bands", lambda b, n: F.struct((n + 1).cast("long").alias("line"), F.filter("placed", lambda s: s["band"] == b["i"] + 1).alias("parts")))
    each = pages.select(*page, F.explode(lines).alias("l"))
    joined = F.array_join(F.transform("l.parts", lambda s: s["t"]), " ")
    return each.select(*page, "l.line", F.size("l.parts").cast("long").alias("spans"), joined.alias("text"))
