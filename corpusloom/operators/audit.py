"""Audit of generated rows: contract, duplicates, coverage, formats, samples, as DataFrames.

Hashes and lengths are taken right behind the scan, so bodies never travel; every group keeps a
bounded state (counts and the two smallest ids), whatever its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..store import written

CLASSES = ("C", "S")


def _blank(column: str):
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"(?U)^\s+|\s+$", "") == ""


def row_errors(rows: DataFrame, cell_keys: DataFrame) -> DataFrame:
    """``rows`` with (error_code, error_field), null for valid rows; the first rule that fails wins.

    Only rows of status ok are tested in depth. ``cell_keys`` has the planned coverage_cell_key.
    """
    known = cell_keys.select(F.col("coverage_cell_key").alias("_known")).distinct()
    ok = F.col("status") == "ok"
    joined = rows.join(known, rows["coverage_cell_key"] == known["_known"], "left")
    code = (
        F.when(_blank("row_id"), F.struct(F.lit("missing_field").alias("code"), F.lit("row_id").alias("field")))
        .when(_blank("status"), F.struct(F.lit("missing_field").alias("code"), F.lit("status").alias("field")))
        .when(ok & ~F.coalesce(F.col("cso_classification"), F.lit("")).isin(*CLASSES), F.struct(F.lit("unknown_enum").alias("code"), F.lit("cso_classification").alias("field")))
        .when(ok & _blank("body_text"), F.struct(F.lit("empty_body").alias("code"), F.lit("body_text").alias("field")))
        .when(ok & _blank("coverage_cell_key"), F.struct(F.lit("missing_field").alias("code"), F.lit("coverage_cell_key").alias("field")))
        .when(ok & F.col("_known").isNull(), F.struct(F.lit("unknown_cell").alias("code"), F.lit("coverage_cell_key").alias("field")))
    )
    return joined.withColumn("_e", code).select(*rows.columns, F.col("_e.code").alias("error_code"), F.col("_e.field").alias("error_field"))


def summaries(rows: DataFrame, numbers: str = "compat", columns: tuple[str, ...] = ()) -> DataFrame:
    """Valid ok rows without their bodies: ids, seeds, hashes, fingerprint, body length.

    Only ``columns``, if named. They are written once, as every metric derives from these few columns and the texts are long.
    """
    said = rows.where("status = 'ok'").withColumn("said", X.combined(X.nfc(F.col("title")), X.nfc(F.col("body_text"))))
    narrow = said.select(
        "row_id", "arrival", "clause_no", "document_status", "coverage_cell_key", "template_id", "agency_category", "seed_candidate_id", "seed_extraction_id",
        F.length(F.coalesce("body_text", F.lit(""))).cast("long").alias("body_length"),
        F.sha2("said", 256).alias("raw_hash"),
        X.normalized_hash(F.col("said"), F.col("ordering_agency"), numbers).alias("normalized_hash"),
        X.structure_fingerprint(F.col("template_id"), F.col("doc_type"), F.col("body_text")).alias("fingerprint"),
    )
    return written(narrow.select(*columns) if columns else narrow, "audit-summary")


def duplicate_groups(summary: DataFrame, metric: str, column: str) -> DataFrame:
    """Groups of two or more: size, smallest row, and the pair of the two smallest rows."""
    summary = summary.select(column, "row_id", "seed_candidate_id", "seed_extraction_id")
    size = summary.groupBy(column).agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    first = W.partitionBy(column).orderBy("row_id")
    two = summary.withColumn("n", F.row_number().over(first)).where("n <= 2")
    pair = two.groupBy(column).agg(
        F.min_by("row_id", "n").alias("row_id_a"), F.max_by("row_id", "n").alias("row_id_b"),
        (F.min_by("seed_candidate_id", "n") == F.max_by("seed_candidate_id", "n")).alias("shared_candidate"),
        (F.min_by("seed_extraction_id", "n") == F.max_by("seed_extraction_id", "n")).alias("shared_extraction"),
    )
    return size.join(pair, column).select(
        F.lit(metric).alias("metric"), F.concat(F.lit(f"{metric}:"), F.col(column)).alias("group_id"),
        F.col("row_id_a").alias("representative_row_id"), "group_size", (F.col("group_size") > 2).alias("pair_rows_truncated"),
        "row_id_a", "row_id_b", "shared_candidate", "shared_extraction",
    )


def all_duplicates(summary: DataFrame) -> DataFrame:
    return duplicate_groups(summary, "raw_exact", "raw_hash").unionByName(duplicate_groups(summary, "normalized_exact", "normalized_hash"))


def coverage_actual(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Planned cells with what was attempted and produced. ``cells``: coverage_cell_key, planned_target."""
    done = rows.where(F.coalesce("coverage_cell_key", F.lit("")) != "").groupBy("coverage_cell_key").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("status") == "ok").alias("k"))
    both = cells.join(done, "coverage_cell_key", "left")
    attempted, ok = F.coalesce("a", F.lit(0)), F.coalesce("k", F.lit(0))
    target = F.col("planned_target")
    return both.select(
        "coverage_cell_key", "planned_target",
        attempted.alias("attempted"), ok.alias("actual_ok"), (attempted - ok).alias("error_count"),
        F.greatest(F.lit(0), target - ok).alias("shortage"), F.greatest(F.lit(0), ok - target).alias("overfill"),
        F.when(target > 0, ok / target).alias("fill_rate"),
        F.when(target == 0, "not_applicable").when(ok > target, "overfill").when(ok < target, "shortage").otherwise("filled").alias("coverage_status"),
    )


def upper_median(summary: DataFrame, group: str) -> DataFrame:
    """(group, median): the element in the middle, the upper of two, from the counts of each length."""
    counted = summary.groupBy(group, "body_length").agg(F.count(F.lit(1)).alias("n"))
    by = W.partitionBy(group)
    upto = counted.withColumn("upto", F.sum("n").over(by.orderBy("body_length"))).withColumn("total", F.sum("n").over(by))
    return upto.where(F.col("upto") > F.floor(F.col("total") / 2)).groupBy(group).agg(F.min("body_length").alias("median"))


def central_row(summary: DataFrame, group: str) -> DataFrame:
    """(group, row_id): the row of each group next to its median length, of equals that with the smallest hash and id."""
    near = summary.join(upper_median(summary, group), group)
    place = F.struct(F.abs(F.col("body_length") - F.col("median")).alias("distance"), "normalized_hash", "row_id")
    return near.groupBy(group).agg(F.min(place).alias("place")).select(group, F.col("place.row_id").alias("row_id"))


def content_samples(rows: DataFrame, summary: DataFrame, axes: dict[str, tuple[str, ...]]) -> DataFrame:
    """(sample_rank, sample_axis, sample_value, sample_status, row_id, and the rest of the row): for each value of each axis the row next to the median length.

    ``axes`` names the columns and their values, in order; a value without rows is *missing*, with an
    empty id. A row may stand for several values. Only the chosen rows' texts are read again.
    """
    spark = rows.sparkSession
    wanted = [(i, axis, value) for i, (axis, value) in enumerate(((a, v) for a, values in axes.items() for v in values), 1)]
    cells = spark.createDataFrame(wanted, "sample_rank long, sample_axis string, sample_value string")
    chosen = None
    for axis, values in axes.items():
        one = central_row(summary.where(F.col(axis).isin(*values)), axis).select(F.lit(axis).alias("c_axis"), F.col(axis).alias("c_value"), F.col("row_id").alias("c_id"))
        chosen = one if chosen is None else chosen.unionByName(one)
    found = cells.join(chosen, (F.col("sample_axis") == F.col("c_axis")) & (F.col("sample_value") == F.col("c_value")), "left").drop("c_axis", "c_value")
    found = written(found, "content-samples")  # a row a value
    full = rows.join(F.broadcast(found.select(F.col("c_id").alias("row_id")).distinct()), "row_id", "left_semi")
    status = F.when(F.col("c_id").isNull(), "missing").otherwise("ok")
    return found.join(full, F.col("c_id") == F.col("row_id"), "left").select("sample_rank", "sample_axis", "sample_value", status.alias("sample_status"), F.coalesce("c_id", F.lit("")).alias("row_id"), *(c for c in rows.columns if c != "row_id"))


def central_rows(summary: DataFrame, group: str) -> DataFrame:
    """Rows of each group in the order of their distance from its median length; ``place`` counts from 1."""
    near = summary.join(upper_median(summary, group), group).withColumn("distance", F.abs(F.col("body_length") - F.col("median")))
    return near.withColumn("place", F.row_number().over(W.partitionBy(group).orderBy("distance", "normalized_hash", "row_id")))


def audit_summary(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: counts, coverage, duplicates, formats and the status of the run."""
    tested = row_errors(rows, cells)
    good = tested.where("error_code IS NULL")
    summary = summaries(good)
    errors = tested.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("error_code").isNotNull()).alias("row_errors"))
    covered = coverage_actual(good, cells).agg(
        F.sum("attempted").alias("attempted"), F.sum("actual_ok").alias("actual_ok"), F.sum("shortage").alias("shortage"),
        F.count_if(F.col("coverage_status") == "filled").alias("cells_filled"), F.count_if(F.col("coverage_status") == "shortage").alias("cells_short"),
    )
    doubled = all_duplicates(summary).agg(
        F.count_if(F.col("metric") == "raw_exact").alias("raw_groups"), F.count_if(F.col("metric") == "normalized_exact").alias("normalized_groups"),
        F.coalesce(F.max("group_size"), F.lit(0)).alias("largest_group"),
    )
    formats = summary.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("arrival").alias("first")).agg(
        F.count(F.lit(1)).alias("fingerprints"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_format"), F.max_by("fingerprint", F.struct("n", -F.col("first"))).alias("largest_fingerprint")
    )
    one = errors
    for part in (covered, doubled, formats):  # each a single row
        one = one.join(F.broadcast(part))
    status = F.when(F.col("actual_ok") == 0, "failed").when((F.col("row_errors") > 0) | (F.col("shortage") > 0), "degraded").otherwise("complete")
    return one.withColumn("run_status", status)
