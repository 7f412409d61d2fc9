"""Gates, validators and run accounts: which rows may be kept, and why others may not.

The Spark side is written with DataFrame functions; the SQL that checks it is written apart, from
the rules. Every validator returns its first error as text, null for a row that passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.dims import FORM_BUCKETS, LEAVES, STATUS_RULES, leaf_rows, status_rows
from ..sources.views import registry
from .dialect import check_sql, spark_query, text, values

#: Version of the settings that an extraction's id covers.
SETTINGS = "v2"

QUERIES, _SQL = {}, {}


def _query(sql):
    def add(f):
        QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_query(lambda d: f"SELECT * FROM {registry(d)} r")(spark, sf_dir)


def _nth(x: Column, names: tuple) -> Column:
    """The entry of ``names`` at ``x``, counted from 0."""
    return F.element_at(F.array(*map(F.lit, names)), (x + 1).cast("int"))


def _first_error(*rules: tuple[Column, str]) -> Column:
    """The text of the first rule that is broken."""
    return F.coalesce(*(F.when(broken, F.lit(said)) for broken, said in rules))


# ------------------------------------------------------------------------------------------ gates


@_query(
    lambda d: f"""SELECT source, doc_type, CASE WHEN status IS NULL OR NOT (status = 'complete' OR (status = 'partial' AND allow_partial)) THEN 'not complete'
WHEN coalesce(run_id, '') = '' THEN 'no run_id' WHEN counts IS NULL THEN 'no counts' WHEN coalesce(rule_version, '') = '' THEN 'no rule_version' END AS error
FROM (SELECT source, doc_type, source = 'asia' AS allow_partial, CASE WHEN min(id) % 4 = 0 THEN 'partial' WHEN min(id) % 4 = 1 THEN NULL ELSE 'complete' END AS status,
CASE WHEN max(id) % 3 > 0 THEN concat('run-', max(id)) END AS run_id, CASE WHEN count(*) % 5 > 0 THEN count(*) END AS counts, CASE WHEN max(price) > 1000 THEN 'r1' ELSE '' END AS rule_version
FROM {registry(d)} r GROUP BY source, doc_type) x"""
)
def manifest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests must be complete (partial only where that is allowed) and name their run, counts and rules."""
    rows = _registry(spark, sf_dir).groupBy("source", "doc_type").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"), F.max("price").alias("price"))
    manifests = rows.select(
        "source",
        "doc_type",
        (F.col("source") == "asia").alias("allow_partial"),
        F.when(F.col("low") % 4 == 0, "partial").when(F.col("low") % 4 != 1, "complete").alias("status"),
        F.when(F.col("high") % 3 > 0, F.concat(F.lit("run-"), "high")).alias("run_id"),
        F.when(F.col("n") % 5 > 0, F.col("n")).alias("counts"),
        F.when(F.col("price") > 1000, "r1").otherwise("").alias("rule_version"),
    )
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    complete = F.col("status").eqNullSafe("complete") | (F.col("allow_partial") & F.col("status").eqNullSafe("partial"))
    return manifests.select("source", "doc_type", _first_error((~complete, "not complete"), (empty("run_id"), "no run_id"), (F.col("counts").isNull(), "no counts"), (empty("rule_version"), "no rule_version")).alias("error"))


# ------------------------------------------------------------------------------------- validators

_CLASSES, _CLAUSES = ("C", "S", "S"), ("1", "3", "5", "6", "8", None)
_SUBS = ("legal_secret", "life_body", "audit_inspection", "personnel_pii", "cornering", None, "unit_cost")
_GRADES = (None, None, None, "2급")


def _sql_nth(x: str, names: tuple) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {'NULL' if n is None else text(n)}" for i, n in enumerate(names)) + " END"


@_query(
    lambda d: f"""SELECT id, CASE WHEN grade IS NOT NULL AND class <> 'C' THEN 'grade needs C' WHEN id % 4 = 2 THEN 'statuses repeat'
WHEN (clause IS NULL) <> (sub IS NULL) THEN 'clause and subclause go together'
WHEN clause IS NULL AND (class <> 'S' OR id % 4 = 0) THEN 'no clause needs S and a status'
WHEN clause IS NOT NULL AND class <> CASE WHEN clause <= '4' THEN 'C' ELSE 'S' END THEN 'clause has another class'
WHEN clause IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {values(sorted({(c, s) for _, c, s, _ in leaf_rows()}), 'clause, sub')} v WHERE v.clause = x.clause AND v.sub = x.sub) THEN 'subclause of another clause' END AS error
FROM (SELECT id, {_sql_nth('id % 3', _CLASSES)} AS class, {_sql_nth('(id // 3) % 6', _CLAUSES)} AS clause, {_sql_nth('(id // 2) % 7', _SUBS)} AS sub, {_sql_nth('(id // 5) % 4', _GRADES)} AS grade FROM {registry(d)} r) x"""
)
def target_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets must agree in class, clause, subclause, statuses and grade."""
    at = lambda n, m: F.floor(F.col("id") / n) % m
    statuses = F.array(F.array().cast("array<string>"), F.array(F.lit("a")), F.array(F.lit("a"), F.lit("a")), F.array(F.lit("a"), F.lit("b")))
    rows = _registry(spark, sf_dir).select(
        "id",
        _nth(at(1, 3), _CLASSES).alias("class"),
        _nth(at(3, 6), _CLAUSES).alias("clause"),
        _nth(at(2, 7), _SUBS).alias("sub"),
        F.element_at(statuses, (F.col("id") % 4 + 1).cast("int")).alias("statuses"),
        _nth(at(5, 4), _GRADES).alias("grade"),
    )
    leaves = F.array(*(F.lit(f"{c}/{sub}") for c, groups in LEAVES.items() for sub, _ in groups))
    free, legal = F.col("clause").isNull(), F.col("clause").isNotNull()
    return rows.select(
        "id",
        _first_error(
            (F.col("grade").isNotNull() & (F.col("class") != "C"), "grade needs C"),
            (F.size("statuses") != F.size(F.array_distinct("statuses")), "statuses repeat"),
            (free != F.col("sub").isNull(), "clause and subclause go together"),
            (free & ((F.col("class") != "S") | (F.size("statuses") == 0)), "no clause needs S and a status"),
            (legal & (F.col("class") != F.when(F.col("clause") <= "4", "C").otherwise("S")), "clause has another class"),
            (legal & ~F.array_contains(leaves, F.concat_ws("/", "clause", "sub")), "subclause of another clause"),
        ).alias("error"),
    )


_NOTES = (("audit_inspection", "no value"), ("life_body", "no date"), ("petitioner_pii", "  "), ("unheard_of", "x"), ("cornering", "no name"))


@_query(
    lambda d: f"""SELECT r.id, coalesce(string_agg(v.sub, ',' ORDER BY v.nth), '') AS kept FROM {registry(d)} r LEFT JOIN {values([(i, s, m) for i, (s, m) in enumerate(_NOTES)], 'nth, sub, missing')} v
ON v.nth < r.id % 6 AND (r.id % 4 = 3 OR (r.id % 4 = 0 AND trim(v.missing) <> '' AND v.sub IN ({', '.join(sorted({text(s) for k, _, s, _ in leaf_rows() if k == 'S'}))}))) GROUP BY r.id"""
)
def near_miss_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes on what was lacking stay only with class O, if not blank and about a subclause of S.

    With an unknown class they are left alone, as that is for another check to tell.
    """
    every = F.array(*(F.struct(F.lit(s).alias("sub"), F.lit(m).alias("missing")) for s, m in _NOTES))
    rows = _registry(spark, sf_dir).select("id", _nth(F.col("id") % 4, ("O", "S", "C", "?")).alias("class"), F.slice(every, F.lit(1), (F.col("id") % 6).cast("int")).alias("notes"))
    subs = sorted({s for k, _, s, _ in leaf_rows() if k == "S"})
    usable = F.filter("notes", lambda n: (F.trim(n["missing"]) != "") & n["sub"].isin(subs))
    none = F.filter("notes", lambda n: F.lit(False))
    kept = F.when(F.col("class") == "O", usable).when(F.col("class").isin("C", "S"), none).otherwise(F.col("notes"))
    return rows.select("id", F.array_join(F.transform(kept, lambda n: n["sub"]), ",").alias("kept"))


# ----------------------------------------------------------------------------- look-ups and choices


@_query(lambda d: f"SELECT id, form, bucket FROM (SELECT id, {_sql_nth(f'id % {len(FORM_BUCKETS)}', tuple(FORM_BUCKETS))} AS form FROM {registry(d)} r) x JOIN {values(list(FORM_BUCKETS.items()), 'f, bucket')} v ON x.form = v.f")
def document_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one of six buckets for each document form; a form without a bucket is an error, never null."""
    rows = _registry(spark, sf_dir).select("id", _nth(F.col("id") % len(FORM_BUCKETS), tuple(FORM_BUCKETS)).alias("form"))
    bucket = F.create_map(*(F.lit(x) for pair in FORM_BUCKETS.items() for x in pair))[F.col("form")]
    return rows.select("id", "form", F.coalesce(bucket, F.raise_error(F.concat(F.lit("form without a bucket: "), "form")).cast("string")).alias("bucket"))


_AXIS_TYPES = (*STATUS_RULES, "notice")


@_query(lambda d: f"SELECT x.doc_type, coalesce(v.status, '') AS status, count(*) AS documents FROM (SELECT {_sql_nth(f'id % {len(_AXIS_TYPES)}', _AXIS_TYPES)} AS doc_type FROM {registry(d)} r) x LEFT JOIN {values([(k, s) for k, _, s in status_rows()], 'kind, status')} v ON v.kind = x.doc_type GROUP BY 1, 2")
def admin_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per type and administrative status of the type; a type without statuses has one blank cell."""
    rows = _registry(spark, sf_dir).groupBy(_nth(F.col("id") % len(_AXIS_TYPES), _AXIS_TYPES).alias("doc_type")).agg(F.count(F.lit(1)).alias("documents"))
    kinds = F.create_map(*(x for kind in STATUS_RULES for x in (F.lit(kind), F.array(*(F.lit(s) for k, _, s in status_rows() if k == kind)))))
    return rows.select("doc_type", F.explode(F.coalesce(kinds[F.col("doc_type")], F.array(F.lit("")))).alias("status"), "documents").groupBy("doc_type", "status").agg(F.sum("documents").alias("documents"))


@_query(lambda d: f"SELECT ordering_agency, concat('{{', string_agg(concat('\"', doc_type, '\":', n), ',' ORDER BY doc_type), '}}') AS counters FROM (SELECT ordering_agency, doc_type, CAST(count(*) AS VARCHAR) AS n FROM {registry(d)} r GROUP BY 1, 2) x GROUP BY 1")
def type_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of an agency as a map sorted by key, written as JSON."""
    counts = _registry(spark, sf_dir).groupBy("ordering_agency", "doc_type").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("doc_type", "n")))
    return counts.groupBy("ordering_agency").agg(F.to_json(F.map_from_entries(pairs)).alias("counters"))


@_query(
    lambda d: f"""SELECT r.id, (SELECT min(p.id) FROM {registry(d)} p WHERE p.source = r.source AND p.body_file_path LIKE concat('data/', r.source, '/', r.doc_type, '/%/', CAST(r.id AS VARCHAR), '_%')) AS matched_id FROM {registry(d)} r"""
)
def path_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the smallest id of a path like its own source, type and id."""
    return first_like(_registry(spark, sf_dir).select("id", "source", "doc_type", "body_file_path"))


def first_like(rows: DataFrame) -> DataFrame:
    """(id, matched_id) of rows (id, source, doc_type, body_file_path): the smallest id of the paths LIKE source/type/%/id_%, where ``_`` stands for any character.

    An id meets every proper prefix of a path's file name, by equality, and the pattern is verified
    afterwards. Paths that share folder and prefix count once, so a short id that many names begin
    with is no hot key. Sources must hold no ``%``, ids are digits.
    """
    parts = F.split("body_file_path", "/")
    names = rows.select("id", F.array_join(F.slice(parts, 1, 3), "/").alias("folder"), F.explode(F.slice(parts, F.lit(5), F.greatest(F.size(parts) - 4, F.lit(0)))).alias("name"))
    digits = F.length(F.regexp_extract("name", r"^\d*", 0))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(digits, F.length("name") - 1)), lambda n: F.substring(F.col("name"), F.lit(1), n))
    keyed = names.where("name <> ''").select("id", "folder", F.explode(prefixes).alias("prefix")).where("prefix <> ''").groupBy("folder", "prefix").agg(F.min("id").alias("found"))
    asked = rows.select("id", F.col("id").cast("string").alias("prefix"), F.concat_ws("/", F.lit("data"), "source", "doc_type").alias("pattern"))
    hits = asked.join(keyed, "prefix").where("folder LIKE pattern").groupBy("id").agg(F.min("found").alias("matched_id"))
    return rows.select("id").join(hits, "id", "left")


# --------------------------------------------------------------------------------------- run accounts


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the id that an extraction would have now, and the one in the cache."""
    rows = _registry(spark, sf_dir).select("id", "source", "body_file_path")
    made = lambda version: F.sha2(F.concat_ws("|", "body_file_path", F.lit(version)), 256)
    cached = rows.where(F.col("id") % 3 < 2).select(F.col("id").alias("cached_key"), F.when(F.col("id") % 3 == 0, made(SETTINGS)).otherwise(made("v1")).alias("cached_id"))
    return rows.select("*", made(SETTINGS).alias("extraction_id")).join(cached, F.col("id") == F.col("cached_key"), "left")


@_query(lambda d: f"SELECT id, sha256(concat(body_file_path, '|', '{SETTINGS}')) AS extraction_id, id % 3 = 1 AS replaces FROM {registry(d)} r WHERE id % 3 <> 0")
def stale_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must be extracted again: no cached result, or one of other bytes or settings."""
    return _extractions(spark, sf_dir).where(~F.col("extraction_id").eqNullSafe(F.col("cached_id"))).select("id", "extraction_id", F.col("cached_id").isNotNull().alias("replaces"))


@_query(
    lambda d: f"""SELECT source, count(*) AS total, count(*) FILTER (WHERE id % 97 <> 0 AND id % 3 <> 0) AS processed, count(*) FILTER (WHERE id % 97 <> 0 AND id % 3 = 0) AS skipped,
count(*) FILTER (WHERE id % 97 <> 0 AND id % 10 > 1) AS succeeded, count(*) FILTER (WHERE id % 97 = 0 OR id % 10 <= 1) AS failed, CASE WHEN bool_or(id % 97 = 0 OR id % 10 <= 1) THEN 'partial' ELSE 'complete' END AS status
FROM {registry(d)} r GROUP BY source"""
)
def extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account of a run: an exception is a failure without an action; errors and quarantine fail after it."""
    state = F.when(F.col("id") % 97 == 0, "exception").otherwise(_nth(F.col("id") % 10, ("error", "quarantine", "needs_ocr", *["ok"] * 7)))
    rows = _extractions(spark, sf_dir).select("source", state.alias("state"), F.col("extraction_id").eqNullSafe(F.col("cached_id")).alias("current"))
    ran, failed = F.col("state") != "exception", F.col("state").isin("exception", "error", "quarantine")
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ran & ~F.col("current")).alias("processed"),
        F.count_if(ran & F.col("current")).alias("skipped"),
        F.count_if(~failed).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.when(F.bool_or(failed), "partial").otherwise("complete").alias("status"),
    )


@_query(
    lambda d: f"""SELECT id, CASE WHEN id % 4 = 1 THEN concat(body_file_path, '.new') WHEN id % 2 = 1 THEN NULL ELSE body_file_path END AS path, id % 4 = 3 AS waiting FROM {registry(d)} r"""
)
def backfill_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queued downloads that succeed give their row a path and leave the queue; failures wait on."""
    rows = _registry(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, F.col("body_file_path")).alias("stored"), "body_file_path")
    queue = rows.where(F.col("stored").isNull()).select(F.col("id").alias("queued"), F.when(F.col("id") % 4 == 1, F.concat("body_file_path", F.lit(".new"))).alias("fetched"))
    joined = rows.join(queue, rows["id"] == queue["queued"], "left")
    return joined.select("id", F.coalesce("fetched", "stored").alias("path"), (F.col("queued").isNotNull() & F.col("fetched").isNull()).alias("waiting"))


ORACLE = {name: check_sql(sql) for name, sql in _SQL.items()}
