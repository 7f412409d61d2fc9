"""Audit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDERS
from ..operators import audit as A
from ..operators import sampling as S
from ..sources.dims import STATUSES
from ..sources.views import audit_rows
from .dialect import DUCK, Spark, check_sql, spark_query

#: Every planned cell of the audit has this target.
TARGET = 12


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_query(lambda d: f"SELECT * FROM {audit_rows(d)}")(spark, sf_dir)


def plan_of(d: Spark) -> str:
    """Planned cells: those of the rows with an even clause, and one that nothing fills."""
    return f"(SELECT DISTINCT coverage_cell_key, CAST({TARGET} AS BIGINT) AS planned_target FROM {audit_rows(d)} WHERE clause_no IN ('2', '4', '6', '8', '1') UNION ALL SELECT 'C|1|legal_secret|none|central_ministry|-', CAST(0 AS BIGINT))"


def cells_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_query(lambda d: f"SELECT * FROM {plan_of(d)}")(spark, sf_dir)


# ------------------------------------------------------------------------ the same in DuckDB's SQL


def _canonical(x: str) -> str:
    blank = r"[\p{Zs}\t\x0B\f]"
    x = f"regexp_replace(nfc_normalize(coalesce({x}, '')), '\\r\\n?', chr(10), 'g')"
    x = f"regexp_replace({x}, '(?m)^{blank}+|{blank}+$', '', 'g')"
    x = f"regexp_replace({x}, '[ \\t\\x{{00A0}}]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({x}, '\\A\\n+|\\n+\\z', '', 'g')"


def _placeholders(x: str) -> str:
    for pattern, by in PLACEHOLDERS:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    x = f"regexp_replace({x}, '\\d+(\\d\\s*(?:조|항|호))', '<NUM>\\1', 'g')"
    for i in range(10):  # no look-ahead there: digits that stay are hidden meanwhile
        x = f"regexp_replace({x}, '{i}(\\s*(?:조|항|호))', chr({0xE000 + i}) || '\\1', 'g')"
    x = f"regexp_replace({x}, '\\d+', '<NUM>', 'g')"
    hidden = " || ".join(f"chr({0xE000 + i})" for i in range(10))
    return f"translate({x}, {hidden}, '0123456789')"


_BLANK_BODY = "trim(regexp_replace(coalesce(body_text, ''), '\\s+', '', 'g')) = ''"


def _bucket(x: str, edges: tuple[int, ...]) -> str:
    low, parts = 0, [f"WHEN {x} = 0 THEN '0'"]
    for edge in edges:
        parts.append(f"WHEN {x} <= {edge} THEN '{low}-{edge}'")
        low = edge + 1
    return f"CASE {' '.join(parts)} ELSE '{low}+' END"


_PARAGRAPHS = "len(list_filter(string_split_regex(coalesce(body_text, ''), '\\n\\s*\\n'), lambda p: regexp_replace(p, '\\s+', '', 'g') <> ''))"
_ITEMS = "len(list_filter(string_split(coalesce(body_text, ''), chr(10)), lambda p: regexp_matches(p, '^\\s*(?:\\d{1,3}[.)]|[①-⑳]|[가-힣]\\.)\\s+')))"
_FINGERPRINT = (
    """concat('sha256:', sha256(concat('{"normalization_version":"v1","value":{"body_length_bucket":"', """
    + _bucket("length(coalesce(body_text, ''))", (200, 500, 1000, 2000, 4000))
    + """, '","doc_type":"', doc_type, '","numbered_list_count_bucket":"', """ + _bucket(_ITEMS, (2, 5, 10))
    + """, '","paragraph_count_bucket":"', """ + _bucket(_PARAGRAPHS, (2, 5, 10)) + """, '","template_id":"', coalesce(template_id, ''), '"}}')))"""
)


def _duck(sql: str) -> str:
    combined = f"concat({_canonical('title')}, chr(10), '<SECTION:BODY>', chr(10), {_canonical('body_text')})"
    head = f"""WITH aud AS (SELECT * FROM {audit_rows(DUCK)}), plan AS (SELECT * FROM {plan_of(DUCK)}),
tested AS (SELECT a.*, CASE WHEN a.status = 'ok' AND {_BLANK_BODY} THEN 'empty_body' WHEN a.status = 'ok' AND p.coverage_cell_key IS NULL THEN 'unknown_cell' END AS error_code,
  CASE WHEN a.status = 'ok' AND {_BLANK_BODY} THEN 'body_text' WHEN a.status = 'ok' AND p.coverage_cell_key IS NULL THEN 'coverage_cell_key' END AS error_field
  FROM aud a LEFT JOIN plan p ON a.coverage_cell_key = p.coverage_cell_key),
texts AS (SELECT *, {combined} AS said FROM aud WHERE status = 'ok'),
summary AS (SELECT *, CAST(length(coalesce(body_text, '')) AS BIGINT) AS body_length, sha256(said) AS raw_hash,
  sha256({_placeholders("replace(said, ordering_agency, '<AGENCY>')")}) AS normalized_hash, {_FINGERPRINT} AS fingerprint FROM texts),
good AS (SELECT * FROM summary WHERE row_id IN (SELECT row_id FROM tested WHERE error_code IS NULL)),
ranked AS (SELECT 'raw_exact' AS metric, raw_hash AS h, row_id, seed_candidate_id AS c, seed_extraction_id AS e FROM summary UNION ALL SELECT 'normalized_exact', normalized_hash, row_id, seed_candidate_id, seed_extraction_id FROM summary),
numbered AS (SELECT *, row_number() OVER (PARTITION BY metric, h ORDER BY row_id) AS n, count(*) OVER (PARTITION BY metric, h) AS group_size FROM ranked),
groups AS (SELECT metric, concat(metric, ':', h) AS group_id, min(row_id) FILTER (n = 1) AS row_id_a, min(row_id) FILTER (n = 2) AS row_id_b, max(group_size)::BIGINT AS group_size,
  min(c) FILTER (n = 1) = min(c) FILTER (n = 2) AS shared_candidate, min(e) FILTER (n = 1) = min(e) FILTER (n = 2) AS shared_extraction FROM numbered WHERE group_size > 1 GROUP BY metric, h),
done AS (SELECT coverage_cell_key, count(*) AS a, count(*) FILTER (status = 'ok') AS k FROM aud GROUP BY coverage_cell_key),
covered AS (SELECT p.coverage_cell_key, planned_target, coalesce(a, 0)::BIGINT AS attempted, coalesce(k, 0)::BIGINT AS actual_ok FROM plan p LEFT JOIN done USING (coverage_cell_key)),
medians AS (SELECT clause_no, body_length AS median FROM (SELECT clause_no, body_length, row_number() OVER (PARTITION BY clause_no ORDER BY body_length) AS n, count(*) OVER (PARTITION BY clause_no) AS t FROM summary) WHERE n = t // 2 + 1),
central AS (SELECT s.clause_no, row_id, abs(body_length - median) AS distance, row_number() OVER (PARTITION BY s.clause_no ORDER BY abs(body_length - median), normalized_hash, row_id) AS place FROM summary s JOIN medians m ON s.clause_no = m.clause_no)
"""
    return check_sql(lambda d: head + sql)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.summaries(rows_of(spark, sf_dir))


def _groups(metric: str, column: str):
    needed = (column, "row_id", "seed_candidate_id", "seed_extraction_id")
    return lambda s, d: A.duplicate_groups(A.summaries(rows_of(s, d), columns=needed), metric, column).drop("row_id_a", "row_id_b", "shared_candidate", "shared_extraction")


def _pairs(spark, sf_dir):
    return A.all_duplicates(_summary(spark, sf_dir)).select("metric", "row_id_a", "row_id_b", "shared_candidate", "shared_extraction")


def _errors(spark, sf_dir):
    return A.row_errors(rows_of(spark, sf_dir), cells_of(spark, sf_dir)).where("error_code IS NOT NULL").select("row_id", "error_code", "error_field")


def _seed_share(spark, sf_dir):
    counts = rows_of(spark, sf_dir).where("status = 'ok'").groupBy("seed_candidate_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("max_seed_source_share"))


def _formats(spark, sf_dir):
    by = _summary(spark, sf_dir).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("arrival").alias("first"))
    return by.agg(F.count(F.lit(1)).alias("distinct_fingerprints"), F.max_by("fingerprint", F.struct("n", -F.col("first"))).alias("largest_fingerprint"), F.max("n").alias("largest_count"), (F.max("n") / F.sum("n")).alias("largest_share"))


def _templates(spark, sf_dir):
    return _summary(spark, sf_dir).groupBy("agency_category", "template_id").agg(F.count(F.lit(1)).alias("n"))


#: The axes of the content samples: clauses, then administrative statuses.
_AXES = {"clause_no": tuple(str(i) for i in range(1, 9)), "document_status": STATUSES}


def _content_samples(spark, sf_dir):
    """A row for each clause and each status, as it is, or that there is none."""
    columns = ("row_id", "status", "cso_classification", "clause_no", "cso_subclause_key", "doc_type", "document_status", "coverage_cell_key", "title", "body_text")
    rows = rows_of(spark, sf_dir)
    summary = A.summaries(rows, columns=("clause_no", "document_status", "body_length", "normalized_hash", "row_id"))
    found = A.content_samples(rows.where("status = 'ok'").select(*columns), summary, _AXES)
    return found.withColumn("body_sha", F.sha2("body_text", 256)).drop("body_text", "status")


_QUOTA = 10


def _anomalies(spark, sf_dir):
    """The first ten anomalies in the order of priority, with their other reasons."""
    chosen = S.anomaly_samples(_summary(spark, sf_dir), A.coverage_actual(rows_of(spark, sf_dir), cells_of(spark, sf_dir)), _QUOTA)
    rows = [(i, s["row_id"], s["reason_code"], s["metric_value"], ",".join(s["others"])) for i, s in enumerate(chosen, 1)]
    return spark.createDataFrame(rows, "rank long, row_id string, reason string, metric_value double, secondary_reasons string")


def _review(spark, sf_dir):
    """The sample for review: rows whose labels contradict each other are forced, every third row has a file."""
    summary = _summary(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 1 AND doc_id % 4 = 0")
    forced = labels.select(F.concat(F.lit("row-"), "doc_id").alias("row_id"), F.lit("good and toxic").alias("reason"))
    files = summary.where("arrival % 3 = 0").select("row_id", F.concat("row_id", F.lit(".pdf")).alias("pdf_path"))
    return S.review_sample(summary, A.coverage_actual(rows_of(spark, sf_dir), cells_of(spark, sf_dir)), 30, forced, files)


QUERIES = {
    "raw_duplicate_groups": _groups("raw_exact", "raw_hash"),
    "normalized_duplicate_groups": _groups("normalized_exact", "normalized_hash"),
    "duplicate_pairs": _pairs,
    "row_contract_errors": _errors,
    "coverage_actual": lambda s, d: A.coverage_actual(rows_of(s, d), cells_of(s, d)),
    "max_seed_source_share": _seed_share,
    "structure_fingerprints": lambda s, d: _summary(s, d).select("row_id", "fingerprint", "body_length"),
    "format_concentration": _formats,
    "agency_template_counts": _templates,
    "content_samples": _content_samples,
    "anomaly_samples": _anomalies,
    "review_samples": lambda s, d: S.representative_samples(_summary(s, d), A.coverage_actual(rows_of(s, d), cells_of(s, d)), 20),
    "audit_review": _review,
    "audit_summary": lambda s, d: A.audit_summary(rows_of(s, d), cells_of(s, d)),
}
_GROUP = "SELECT metric, group_id, row_id_a AS representative_row_id, group_size, group_size > 2 AS pair_rows_truncated FROM groups WHERE metric = "
_COVERED = """greatest(0, planned_target - actual_ok) AS shortage, greatest(0, actual_ok - planned_target) AS overfill,
 CASE WHEN planned_target > 0 THEN actual_ok::DOUBLE / planned_target END AS fill_rate,
 CASE WHEN planned_target = 0 THEN 'not_applicable' WHEN actual_ok > planned_target THEN 'overfill' WHEN actual_ok < planned_target THEN 'shortage' ELSE 'filled' END AS coverage_status"""
ORACLE = {
    "raw_duplicate_groups": _duck(_GROUP + "'raw_exact'"),
    "normalized_duplicate_groups": _duck(_GROUP + "'normalized_exact'"),
    "duplicate_pairs": _duck("SELECT metric, row_id_a, row_id_b, shared_candidate, shared_extraction FROM groups"),
    "row_contract_errors": _duck("SELECT row_id, error_code, error_field FROM tested WHERE error_code IS NOT NULL"),
    "coverage_actual": _duck(f"SELECT coverage_cell_key, planned_target, attempted, actual_ok, attempted - actual_ok AS error_count, {_COVERED} FROM covered"),
    "max_seed_source_share": _duck("SELECT max(n)::DOUBLE / sum(n)::DOUBLE AS max_seed_source_share FROM (SELECT count(*) AS n FROM aud WHERE status = 'ok' GROUP BY seed_candidate_id)"),
    "structure_fingerprints": _duck("SELECT row_id, fingerprint, body_length FROM summary"),
    "format_concentration": _duck("SELECT count(*)::BIGINT AS distinct_fingerprints, arg_max(fingerprint, n * 1000000000000 - first) AS largest_fingerprint, max(n)::BIGINT AS largest_count, max(n)::DOUBLE / sum(n)::DOUBLE AS largest_share FROM (SELECT fingerprint, count(*) AS n, min(arrival) AS first FROM summary GROUP BY fingerprint)"),
    "agency_template_counts": _duck("SELECT agency_category, template_id, count(*)::BIGINT AS n FROM summary GROUP BY ALL"),
    "content_samples": _duck(
        f""", axes AS ({' UNION ALL '.join(f"SELECT {n} AS sample_rank, '{a}' AS sample_axis, '{v}' AS sample_value" for n, (a, v) in enumerate(((a, v) for a, vs in _AXES.items() for v in vs), 1))}),
members AS (SELECT 'clause_no' AS axis, clause_no AS val, row_id AS id, body_length AS n, normalized_hash AS h FROM summary UNION ALL SELECT 'document_status', document_status, row_id, body_length, normalized_hash FROM summary),
middles AS (SELECT axis, val, list_sort(list(n))[count(*) // 2 + 1] AS median FROM members GROUP BY axis, val),
near AS (SELECT axis, val, id, row_number() OVER (PARTITION BY axis, val ORDER BY abs(n - median), h, id) AS place FROM members JOIN middles USING (axis, val))
SELECT sample_rank, sample_axis, sample_value, CASE WHEN id IS NULL THEN 'missing' ELSE 'ok' END AS sample_status, coalesce(id, '') AS row_id, a.cso_classification, a.clause_no, a.cso_subclause_key, a.doc_type, a.document_status, a.coverage_cell_key, a.title, sha256(a.body_text) AS body_sha
FROM axes LEFT JOIN near ON axis = sample_axis AND val = sample_value AND place = 1 LEFT JOIN aud a ON a.row_id = id"""
    ),
    "anomaly_samples": _duck(
        """, cases AS (SELECT 1 AS priority, row_id_a AS row_id, group_size::DOUBLE AS metric_value, 'raw_exact_duplicate' AS reason, 0::DOUBLE AS second, '' AS third FROM groups WHERE metric = 'raw_exact'
UNION ALL SELECT 2, row_id_a, group_size::DOUBLE, 'normalized_duplicate', 0, '' FROM groups WHERE metric = 'normalized_exact'
UNION ALL SELECT 3, m.row_id, (planned_target - actual_ok)::DOUBLE / planned_target, 'coverage_shortage', -planned_target, c.coverage_cell_key FROM covered c JOIN (SELECT coverage_cell_key, min(row_id) AS row_id FROM summary GROUP BY 1) m ON c.coverage_cell_key = m.coverage_cell_key WHERE actual_ok < planned_target
UNION ALL SELECT 4, arg_min(row_id, {'d': abs(body_length - median), 'h': normalized_hash, 'i': row_id}), any_value(n)::DOUBLE, 'format_concentration', 0, '' FROM (SELECT *, list_sort(list(body_length) OVER (), 'ASC')[(count(*) OVER ()) // 2 + 1] AS median FROM summary JOIN
  (SELECT fingerprint, count(*) AS n, min(arrival) AS first FROM summary GROUP BY 1 ORDER BY n DESC, first LIMIT 1) f USING (fingerprint)) x
UNION ALL SELECT 5, min(row_id), count(*)::DOUBLE, 'shared_source', 0, '' FROM summary GROUP BY seed_candidate_id HAVING count(*) > 1),
placed AS (SELECT *, row_number() OVER (ORDER BY priority, metric_value DESC, second, third, row_id) AS place FROM cases),
firsts AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY place) AS nth FROM placed)
SELECT row_number() OVER (ORDER BY place) AS rank, row_id, reason, metric_value, coalesce((SELECT string_agg(reason, ',' ORDER BY priority) FROM (SELECT DISTINCT reason, priority, row_id FROM cases) c WHERE c.row_id = f.row_id AND c.reason <> f.reason), '') AS secondary_reasons
FROM firsts f WHERE nth = 1 ORDER BY rank LIMIT 10"""
    ),
    "audit_summary": _duck(
        """, good_rows AS (SELECT * FROM tested WHERE error_code IS NULL),
gdone AS (SELECT coverage_cell_key, count(*) AS a, count(*) FILTER (status = 'ok') AS k FROM good_rows GROUP BY 1),
gcov AS (SELECT planned_target, coalesce(a, 0) AS attempted, coalesce(k, 0) AS actual_ok FROM plan LEFT JOIN gdone USING (coverage_cell_key)),
ggroups AS (SELECT 'r' AS metric, count(*) AS n FROM good GROUP BY raw_hash HAVING count(*) > 1 UNION ALL SELECT 'n', count(*) FROM good GROUP BY normalized_hash HAVING count(*) > 1),
gforms AS (SELECT fingerprint, count(*) AS n, min(arrival) AS first FROM good GROUP BY fingerprint)
SELECT t.*, c.*, g.*, f.*, CASE WHEN actual_ok = 0 THEN 'failed' WHEN row_errors > 0 OR shortage > 0 THEN 'degraded' ELSE 'complete' END AS run_status FROM
(SELECT count(*)::BIGINT AS rows, count(error_code)::BIGINT AS row_errors FROM tested) t,
(SELECT sum(attempted)::BIGINT AS attempted, sum(actual_ok)::BIGINT AS actual_ok, sum(greatest(0, planned_target - actual_ok))::BIGINT AS shortage,
  count(*) FILTER (planned_target > 0 AND actual_ok = planned_target)::BIGINT AS cells_filled, count(*) FILTER (actual_ok < planned_target)::BIGINT AS cells_short FROM gcov) c,
(SELECT count(*) FILTER (metric = 'r')::BIGINT AS raw_groups, count(*) FILTER (metric = 'n')::BIGINT AS normalized_groups, coalesce(max(n), 0)::BIGINT AS largest_group FROM ggroups) g,
(SELECT count(*)::BIGINT AS fingerprints, coalesce(max(n), 0)::BIGINT AS largest_format, arg_max(fingerprint, n * 1000000000000 - first) AS largest_fingerprint FROM gforms) f"""
    ),
}
