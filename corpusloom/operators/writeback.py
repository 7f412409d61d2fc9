"""What was generated or rendered, matched with the rows it belongs to.

Nothing is looked up by a stored link: names and coordinates are computed again from the record, and
what doesn't fit is told by its reason and counted, never passed over.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.text import safe_stem

RENDERED = ("ok", "ok_truncated")
GENERATED = "gen_"


def file_stem(path: Column) -> Column:
    """The last part of a path without its suffix; a leading dot begins no suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def generated_url(document_id: Column, clause: Column, subclause: Column) -> Column:
    """The URL of a generated document: the same for the same source and target."""
    return F.concat(F.lit("synthetic://source-generation/"), document_id, F.lit("/"), F.coalesce(clause, F.lit("none")), F.lit("-"), F.coalesce(subclause, F.lit("none")))


def match_renders(records: DataFrame, renders: DataFrame, rows: DataFrame, root: str, ok: Collection[str] = RENDERED) -> DataFrame:
    """(record_id, document_id, outcome, status, body_file_path): where each record's rendering goes.

    ``records`` (record_id, source, source_path, clause_no, subclause_key), ``renders`` (nth,
    document_id, status, pdf), ``rows`` (source, source_url). A record's document id is the stem of
    its source's file; of several renderings of one id the last counts. Outcomes: *gated* (not
    rendered, status ``missing`` if it isn't in the manifest; the row keeps no path), *outside* (the
    file isn't below ``root``), *no row* (nothing was stored under the record's key), *filled*, and
    *unclaimed* for renderings that no record names (record_id null).
    """
    root = root.rstrip("/") + "/"
    stem = file_stem(F.col("source_path"))
    named = records.select("record_id", safe_stem(stem, F.when(F.coalesce(stem, F.lit("")) != "", stem).otherwise("generated-document")).alias("document_id"), F.concat(F.lit(GENERATED), "source").alias("gen_source"), "clause_no", "subclause_key")
    named = named.withColumn("gen_url", generated_url(F.col("document_id"), F.col("clause_no"), F.col("subclause_key")))
    last = renders.where("coalesce(document_id, '') <> ''").groupBy(F.col("document_id").alias("rendered_id")).agg(F.max_by(F.struct("status", "pdf"), "nth").alias("x"))
    last = last.select("rendered_id", F.coalesce("x.status", F.lit("")).alias("status"), F.col("x.pdf").alias("pdf"))
    stored = rows.select(F.col("source").alias("row_source"), F.col("source_url").alias("row_url")).distinct()
    both = named.join(last, named["document_id"] == last["rendered_id"], "full")
    both = both.join(stored, (F.col("gen_source") == F.col("row_source")) & (F.col("gen_url") == F.col("row_url")), "left")
    status = F.coalesce("status", F.lit("missing"))
    below = F.col("pdf").startswith(root) & ~F.contains("pdf", F.lit("/../")) & ~F.col("pdf").endswith("/..")
    outcome = (
        F.when(F.col("document_id").isNull(), "unclaimed")
        .when(~status.isin(*ok) | F.col("pdf").isNull(), "gated")
        .when(~below, "outside")
        .when(F.col("row_url").isNull(), "no row")
        .otherwise("filled")
    )
    return both.select("record_id", F.coalesce("document_id", "rendered_id").alias("document_id"), outcome.alias("outcome"), status.alias("status"), F.when(outcome == "filled", F.substring("pdf", len(root) + 1, 1 << 30)).alias("body_file_path"))


def outcomes(matched: DataFrame) -> DataFrame:
    """(outcome, status, n): the account of a run; the status is told for gated records only."""
    return matched.groupBy("outcome", F.when(F.col("outcome") == "gated", F.col("status")).otherwise("").alias("status")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------- coordinates


def decoded(index: Column, radices: Column) -> Column:
    """The digits of a number in mixed radices, the last axis fastest."""
    start = F.struct(index.cast("long").alias("rest"), F.array().cast("array<long>").alias("digits"))
    step = lambda acc, radix: F.struct(F.floor(acc["rest"] / radix).cast("long").alias("rest"), F.concat(F.array((acc["rest"] % radix).cast("long")), acc["digits"]).alias("digits"))
    return F.aggregate(F.reverse(radices), start, step, lambda acc: acc["digits"])


def encoded(digits: Column, radices: Column) -> Column:
    """The number of which :func:`decoded` gives the digits."""
    return F.aggregate(F.arrays_zip(digits.alias("d"), radices.alias("r")), F.lit(0).cast("long"), lambda acc, x: acc * x["r"] + x["d"])


def track_id(subclause: Column, agency: Column, seed: Column, index: Column) -> Column:
    """The id of a document that has no source: the coordinates from which it can be made again."""
    return F.concat(F.lit("c-track/"), subclause, F.lit("/"), agency, F.lit("/seed"), seed.cast("string"), F.lit("-case"), index.cast("string"))


def _number(value: Column) -> Column:
    """A variant's whole number, also if it is written as a string."""
    kind = F.schema_of_variant(value)
    text = F.when(kind.isin("BIGINT", "STRING"), F.try_variant_get(value, "$", "string"))
    return F.trim(text).try_cast("long")


def rebuild_frames(records: DataFrame, templates: DataFrame, version: str, contract: str, accepted: Collection[str] = (), record: str = "record") -> DataFrame:
    """``records`` with (template, seed, case_index, digits, picked, document_id, older_contract, failure).

    ``record`` is JSON text (template, template_version, seed, case_index, document or
    response.document). ``templates`` (template, axes) has the values of every axis of a template,
    ``subclause/agency``; the numbers of values are the radices, which differ from template to
    template. A frame is decoded from its coordinate and encoded again as a proof. Failures, the
    first that holds: *malformed*, *no template*, *unknown template*, *old template version* (unless
    ``accepted``; a record without a version passes), *no number*, *out of range*, *no document*. Older
    contracts are read and told, not refused.
    """
    doc = F.col("_doc")  # parsed once
    text = lambda path: F.try_variant_get(doc, path, "string")
    responded = J.at(doc, "$.response").isNotNull()
    body = F.when(responded, J.at(doc, "$.response.document")).otherwise(J.at(doc, "$.document"))
    read = records.withColumn("_doc", F.try_parse_json(F.col(record))).select(
        *records.columns,
        F.struct(
            doc.isNotNull().alias("parsed"), text("$.template").alias("template"), F.coalesce(text("$.template_version"), F.lit("")).alias("version"),
            _number(J.at(doc, "$.seed")).alias("seed"), _number(J.at(doc, "$.case_index")).alias("case_index"),
            F.coalesce(F.schema_of_variant(body).startswith("OBJECT<"), F.lit(False)).alias("has_document"), F.coalesce(F.try_variant_get(body, "$.contract_version", "string"), F.lit("")).alias("contract"),
        ).alias("_r"),
    )
    known = templates.select(F.col("template").alias("_known"), F.col("axes").alias("_axes"))
    joined = read.join(known, F.col("_r.template") == F.col("_known"), "left")
    radices = F.transform("_axes", lambda values: F.size(values).cast("long"))
    index, count = F.col("_r.case_index"), F.aggregate(radices, F.lit(1).cast("long"), lambda acc, n: acc * n)
    failure = (
        F.when(~F.col("_r.parsed"), "malformed")
        .when(F.coalesce("_r.template", F.lit("")) == "", "no template")
        .when(F.col("_known").isNull(), "unknown template")
        .when(~F.col("_r.version").isin("", version, *accepted), "old template version")
        .when(index.isNull() | F.col("_r.seed").isNull(), "no number")
        .when((index < 0) | (index >= count), "out of range")
        .when(~F.col("_r.has_document"), "no document")
    )
    placed = joined.withColumn("_failure", failure).withColumn("_digits", F.when(F.col("_failure").isNull(), decoded(index, radices)))
    proven = F.when(F.col("_digits").isNotNull() & (encoded(F.col("_digits"), radices) != index), "does not encode back").otherwise(F.col("_failure"))
    fine = F.col("_digits").isNotNull()
    picked = F.transform("_digits", lambda d, i: F.get(F.get(F.col("_axes"), i), d.cast("int")))
    name = lambda k: F.when(F.instr("_r.template", "/") > 0, F.substring_index("_r.template", "/", 1) if k == 0 else F.expr("substr(_r.template, instr(_r.template, '/') + 1)")).otherwise(F.col("_r.template") if k == 0 else F.lit(""))
    older = F.when(fine & ~F.col("_r.contract").isin("", contract), F.col("_r.contract"))
    return placed.select(
        *records.columns, F.col("_r.template").alias("template"), F.col("_r.seed").alias("seed"), index.alias("case_index"), F.col("_digits").alias("digits"), picked.alias("picked"),
        F.when(fine, track_id(name(0), name(1), F.col("_r.seed"), index)).alias("document_id"), older.alias("older_contract"), proven.alias("failure"),
    )
