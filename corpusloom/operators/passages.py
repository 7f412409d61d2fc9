"""Passages against what their documents say now: furniture of pages, masks, candidates, cells, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped, without_garbage
from .ranking import numbered_within

#: Pages on which furniture stands at least, their share, and the share of one text, or of numbers, in its place.
MIN_PAGES, PAGE_SHARE, SAME_SHARE = 3, 0.3, 0.8
# The kinds of dashes around page numbers, and runs that hide something.
NUMERIC = r"^[\-‐‑‒–—−－]?\s*[0-9ivxlcdmIVXLCDM]+\s*[\-‐‑‒–—−－]?$"
MASKS = r"\*{2,}|○{2,}|●{2,}"
#: Characters of the context of a mask.
MASK_CONTEXT = 60
#: Characters of a file name's stem.
MOST_NAME = 120


def _numeric(text: Column) -> Column:
    return stripped(text).rlike(NUMERIC)


def marked_furniture(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``lines`` (doc, page, text, x0, y0, ..) with (cleaned_text, is_boilerplate): headers, footers and numbers that come back page by page.

    A document with any geometry is judged by places: a rounded (x0, y0) on at least MIN_PAGES pages
    and PAGE_SHARE of them, where SAME_SHARE of the lines have one text, or are numbers. Its lines
    without a place are never furniture. A document without any geometry is judged by its texts, all
    numbers counting as one. Counts are taken per place or text, so no page or document is gathered.
    """
    said = F.coalesce("text", F.lit(""))
    shown = F.when(F.col("x0").isNotNull() & F.col("y0").isNotNull(), F.struct(F.rint("x0").alias("x"), F.rint("y0").alias("y")))
    own = lines.select("*", said.alias("_t"), shown.alias("_slot"), F.when(_numeric(said), F.lit("\0#")).otherwise(said).alias("_key"))
    docs = own.groupBy(F.col(doc).alias("_d")).agg(F.count_distinct("page").alias("_pages"), F.bool_or(F.col("_slot").isNotNull()).alias("_placed"))
    common = lambda seen: (F.col(seen) >= MIN_PAGES) & (F.col(seen) / F.col("_pages") >= PAGE_SHARE)
    # texts of a place are counted first, then the places
    texts = own.where("_slot IS NOT NULL").groupBy(doc, "_slot", "_t").agg(F.count(F.lit(1)).alias("n"), F.collect_set("page").alias("pages"))
    slots = texts.groupBy(F.col(doc).alias("_sd"), F.col("_slot").alias("_s")).agg(
        F.sum("n").alias("n"), F.max("n").alias("same"), F.sum(F.when(_numeric(F.col("_t")), F.col("n")).otherwise(0)).alias("numbers"), F.size(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("_seen")
    )
    slots = slots.where((F.col("same") / F.col("n") >= SAME_SHARE) | (F.col("numbers") / F.col("n") >= SAME_SHARE)).join(docs, F.col("_sd") == F.col("_d")).where(common("_seen")).select("_sd", "_s")
    keys = own.groupBy(F.col(doc).alias("_kd"), F.col("_key").alias("_k")).agg(F.count_distinct("page").alias("_on")).join(docs.where("NOT _placed"), F.col("_kd") == F.col("_d")).where(common("_on")).select("_kd", "_k")
    joined = own.join(slots, (F.col(doc) == F.col("_sd")) & (F.col("_slot") == F.col("_s")), "left").join(keys, (F.col(doc) == F.col("_kd")) & (F.col("_key") == F.col("_k")), "left")
    return joined.select(*lines.columns, without_garbage(F.col("_t")).alias("cleaned_text"), (F.col("_s").isNotNull() | F.col("_k").isNotNull()).alias("is_boilerplate"))


def mask_slot(text: Column) -> Column:
    """The first masked run of a text in the middle of its context, with an ellipsis where that is cut; null without a mask."""
    before = F.length(F.regexp_extract(text, rf"(?s)^(.*?)(?:{MASKS})", 1))
    start = F.greatest(F.lit(0), before - MASK_CONTEXT // 2)
    cut = stripped(F.replace(F.substring(text, start + 1, F.lit(MASK_CONTEXT)), F.lit("\n"), F.lit(" ")))
    said = F.concat(F.when(start > 0, "…").otherwise(""), cut, F.when(start + MASK_CONTEXT < F.length(text), "…").otherwise(""))
    return F.when(text.rlike(MASKS), said)


def joined_lines(lines: Column) -> Column:
    """Lines put together with a blank between two unless one of them has it."""
    glue = lambda acc, t: F.concat(acc, F.when((acc == "") | acc.endswith(" ") | t.startswith(" "), "").otherwise(" "), t)
    return F.aggregate(lines, F.lit(""), glue)


def revalidated(candidates: DataFrame, lines: DataFrame) -> DataFrame:
    """``candidates`` with ``error``: what of a candidate (candidate_id, doc_id, extraction_id, line_ids, text, text_sha256, page) isn't so any more.

    ``lines`` (doc_id, extraction_id, line_id, page, cleaned_text, is_boilerplate) are the current
    ones; an id that occurs twice in a document makes its candidates void. A candidate's lines are
    joined in its own order; it has as many rows as it has ids.
    """
    said = lambda broken, text: F.when(broken, F.lit(text))
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    now = lines.groupBy(F.col("doc_id").alias("_d")).agg(F.max("extraction_id").alias("_extraction"))
    known = lines.groupBy(F.col("doc_id").alias("_ld"), F.col("line_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"), F.first("page").alias("_page"), F.first(F.coalesce("cleaned_text", F.lit(""))).alias("_t"), F.bool_or("is_boilerplate").alias("_furniture"))
    # a row is told by 128 bits of what makes it, and copies of one go where they meet the line, without an exchange of their own
    own = F.to_json(F.struct("candidate_id", "doc_id", "text_sha256", "line_ids"), {"ignoreNullFields": "false"})
    # texts are compared by their SHA-256, so that a candidate's own stays where it is
    marked = candidates.select("*", F.substring(F.unhex(F.sha2(own, 256)), 1, 16).alias("_row"), F.unhex(F.sha2("text", 256)).alias("_said"), (F.sha2("text", 256) != F.col("text_sha256")).alias("_altered"), (F.col("text").isNull() | F.col("text_sha256").isNull()).alias("_untold"))
    asked = marked.select("_row", "doc_id", "page", F.posexplode("line_ids").alias("_at", "_asked"))
    met = asked.join(known, (F.col("doc_id") == F.col("_ld")) & (F.col("_asked") == F.col("_id")), "left").drop("_ld").distinct()
    of = met.groupBy("_row").agg(
        F.count_if(F.col("_id").isNull()).alias("_gone"), F.count_if(F.col("_n") > 1).alias("_double"), F.count_if(F.col("_furniture")).alias("_furniture"), F.count_if(~F.col("_page").eqNullSafe(F.col("page"))).alias("_elsewhere"),
        F.array_sort(F.collect_list(F.struct("_at", "_t"))).alias("_lines"),
    )
    of = of.withColumnRenamed("_row", "_m")
    both = marked.join(now, F.col("doc_id") == F.col("_d"), "left").join(of, F.col("_row").eqNullSafe(F.col("_m")), "left")
    error = F.coalesce(
        said(none(F.col("candidate_id")), "no candidate_id"), said(none(F.col("extraction_id")), "no extraction_id"), said(F.coalesce(F.size("line_ids"), F.lit(0)) <= 0, "no line_ids"), said(F.col("_untold"), "no text"),
        said(F.col("_altered"), "text_sha256 differs"), said(F.col("_d").isNull(), "no extraction"), said(F.col("_extraction") != F.col("extraction_id"), "stale extraction_id"),
        said(F.col("_gone") > 0, "lines not found"), said(F.col("_double") > 0, "line_id twice"), said(F.col("_furniture") > 0, "boilerplate line"),
        said(F.unhex(F.sha2(joined_lines(F.transform("_lines", lambda x: x["_t"])), 256)) != F.col("_said"), "line text differs"), said(F.col("_elsewhere") > 0, "page differs"),
    )
    return both.select(*candidates.columns, error.alias("error"))


def cell_measures(candidates: DataFrame, statuses: DataFrame, cells: DataFrame, ruled: tuple[str, ...]) -> DataFrame:
    """``cells`` (clause_no, subclause, doc_type) with (state, span_candidates, matching_docs, by_status).

    ``candidates`` (clause_no, subclause, doc_type, doc) count as spans, their documents once; these
    meet the administrative ``statuses`` (doc, status) of documents. *no_rule*: the document type
    isn't one of those ``ruled``; *zero_matches*: none of the documents has a status; else
    *counted*, with documents by status. Copies of a document's status count once.
    """
    cell = ["clause_no", "subclause", "doc_type"]
    spans = candidates.groupBy(*cell).agg(F.count(F.lit(1)).alias("_spans"))
    docs = candidates.select(*cell, "doc").distinct()
    counted = docs.groupBy(*cell).agg(F.count(F.lit(1)).alias("_docs"))
    held = docs.join(statuses.select("doc", "status").distinct(), "doc").groupBy(*cell, "status").agg(F.count(F.lit(1)).alias("n"))
    by = held.groupBy(*cell).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("_by"))
    joined = cells.join(spans, cell, "left").join(counted, cell, "left").join(by, cell, "left")
    rule = F.col("doc_type").isin(*ruled)
    state = F.when(~rule, "no_rule").when(F.col("_by").isNull(), "zero_matches").otherwise("counted")
    zero = F.lit(0).cast("long")
    return joined.select(*cells.columns, state.alias("state"), F.coalesce("_spans", zero).alias("span_candidates"), F.coalesce("_docs", zero).alias("matching_docs"), F.when(rule, F.col("_by")).alias("by_status"))


def without_label(title: Column) -> Column:
    """A title without labels in brackets in front of it."""
    return stripped(F.regexp_replace(stripped(F.coalesce(title, F.lit(""))), r"(?U)^(?:\s*[\[(（][^\])）]*[\])）]\s*)+", ""))


def file_stem_of(title: Column, fallback: Column) -> Column:
    """A title as a file name: brackets go, dashes are hyphens, blanks are underscores, at most 120 characters; ``fallback`` where nothing is left."""
    name = F.regexp_replace(stripped(F.coalesce(title, F.lit(""))), r"[\[\]()（）]", "")
    name = F.regexp_replace(F.regexp_replace(name, "[—–]", "-"), r"(?U)^\s+|\s+$", "")
    name = F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", "_"), r"(?U)[^\w.-]", "")
    edges = F.lit("._-")
    name = F.btrim(F.substring(F.btrim(name, edges), 1, MOST_NAME), edges)
    return F.when(name != "", name).otherwise(F.coalesce(fallback, F.lit("")))


def file_names(rows: DataFrame, order: str = "id", title: str = "title", fallback: str = "id") -> DataFrame:
    """``rows`` with ``file_name``: the title's stem, and ``_2``, ``_3``, .. for rows that share it, in order; a stem that many share is numbered in ranges."""
    based = rows.withColumn("_base", file_stem_of(F.col(title), F.col(fallback).cast("string")))
    placed = numbered_within(based, "_base", F.col(order).asc(), name="_nth")
    return placed.select(*rows.columns, F.when(F.col("_nth") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("_"), "_nth")).alias("file_name"))


def chosen(key: Column, seed: int | str, ratio: float) -> Column:
    """Whether a row belongs to the share ``ratio`` of all, by the first 32 bits of the hash of seed and key; none for a ratio of 0 or less."""
    if ratio <= 0:
        return F.lit(False)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0) < ratio
