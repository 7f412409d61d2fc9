"""What stands around a line or a passage, within bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import stripped

#: Neighbours on each side, and characters of each.
RADIUS, CLIP = 2, 240
#: Characters of a context together, and at most whatever the anchor needs.
BUDGET, CEILING = 1200, 3600


def clipped(text: Column, most: int = CLIP) -> Column:
    """A stripped text of at most ``most`` characters; of a longer one the last is an ellipsis."""
    bare = stripped(F.coalesce(text, F.lit("")))
    return F.when(F.length(bare) > most, F.concat(F.substring(bare, 1, most - 1), F.lit("…"))).otherwise(bare)


def line_context(lines: DataFrame, doc: str = "doc_id", order: str = "pos", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc, order, context): each line with its neighbours, marked as before, target or behind, a line each."""
    by = W.partitionBy(doc).orderBy(order)
    short = lines.select(doc, order, clipped(F.col(text)).alias("t"))
    near = lambda mark, c: F.when(c.isNotNull(), F.concat(F.lit(mark), c))
    parts = [near("[이전] ", F.lag("t", n).over(by)) for n in range(radius, 0, -1)] + [near("[대상] ", F.col("t"))] + [near("[다음] ", F.lead("t", n).over(by)) for n in range(1, radius + 1)]
    return short.select(doc, order, F.concat_ws("\n", *parts).alias("context"))


def budgeted_context(lines: DataFrame, anchors: DataFrame, doc: str = "doc_id", budget: int = BUDGET, ceiling: int = CEILING) -> DataFrame:
    """(doc, first_pos, last_pos, lines, context) of anchors (doc, first_pos, last_pos) in lines (doc, pos, block_id, text).

    The blocks that the anchor touches always stay, whole. What they leave of the budget is halved
    for both sides; there whole blocks are taken, from the anchor outwards, up to the first that
    doesn't fit. A line counts its characters and one more. A run of lines with one block is a
    block; a line without one is a block of its own. A context is cut at ``ceiling`` characters.
    """
    by = W.partitionBy(doc).orderBy("pos")
    fresh = F.when(F.col("block_id").isNotNull() & F.col("block_id").eqNullSafe(F.lag("block_id").over(by)), 0).otherwise(1)
    placed = lines.select(doc, "pos", "text", "block_id", fresh.alias("fresh")).select(doc, "pos", F.coalesce("text", F.lit("")).alias("text"), F.sum("fresh").over(by).alias("b"))
    blocks = placed.groupBy(F.col(doc).alias("b_doc"), "b").agg(F.sum(F.length("text") + 1).alias("n"))
    at = lambda name: placed.select(F.col(doc).alias(f"{name}_doc"), F.col("pos").alias(f"{name}_pos"), F.col("b").alias(name))
    first, last = at("lo"), at("hi")
    found = anchors.select(doc, "first_pos", "last_pos").join(first, (F.col(doc) == F.col("lo_doc")) & (F.col("first_pos") == F.col("lo_pos"))).join(last, (F.col(doc) == F.col("hi_doc")) & (F.col("last_pos") == F.col("hi_pos")))
    found = found.select(doc, "first_pos", "last_pos", "lo", "hi")
    # every block has a character at least, so no more than the budget's number of them can be taken
    near = found.join(blocks, (F.col(doc) == F.col("b_doc")) & F.col("b").between(F.col("lo") - budget, F.col("hi") + budget))
    own = F.col("b").between(F.col("lo"), F.col("hi"))
    anchor = W.partitionBy(doc, "first_pos", "last_pos")
    side = F.when(own, 0).when(F.col("b") < F.col("lo"), 1).otherwise(2)
    near = near.withColumn("side", side).withColumn("rest", F.greatest(F.lit(0), F.lit(budget) - F.sum(F.when(own, F.col("n")).otherwise(0)).over(anchor)))
    upto = F.sum("n").over(W.partitionBy(doc, "first_pos", "last_pos", "side").orderBy(F.abs(F.col("b") - F.col("lo"))))
    half = F.floor(F.col("rest") / 2)
    kept = near.withColumn("upto", upto).where(own | (F.col("upto") <= F.when(F.col("side") == 1, half).otherwise(F.col("rest") - half)))
    said = placed.select(F.col(doc).alias("s_doc"), F.col("b").alias("s_b"), "pos", "text")
    rows = kept.join(said, (F.col(doc) == F.col("s_doc")) & (F.col("b") == F.col("s_b"))).groupBy(doc, "first_pos", "last_pos").agg(F.count(F.lit(1)).alias("lines"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("said"))
    return rows.select(doc, "first_pos", "last_pos", "lines", F.substring(F.array_join(F.transform("said", lambda s: s["text"]), "\n"), 1, ceiling).alias("context"))
