"""Passages over the test tables: furniture, masks, candidates again, cells, names, shares.

The SQL that checks them is written apart, from the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import passages as P
from ..sources.dims import STATUS_RULES
from ..sources.views import page_lines, registry
from .dialect import check_sql, spark_query, text, values

QUERIES, _SQL = {}, {}


def _query(sql):
    def add(f):
        QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def _view(view):
    return lambda spark, sf_dir: spark_query(lambda d: f"SELECT * FROM {view(d)} v")(spark, sf_dir)


def _nth(x: str, names) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {'NULL' if n is None else text(n)}" for i, n in enumerate(names)) + " END"


def _placed_lines(d) -> str:
    """Lines of pages; every third document has no geometry, and a few lines of the others have none."""
    no = "doc_id % 3 = 0 OR pos % 17 = 5"
    return f"(SELECT doc_id, page, pos, text, CASE WHEN {no} THEN NULL ELSE x0 + 0.4 END AS x0, CASE WHEN {no} THEN NULL ELSE y0 - 0.3 END AS y0 FROM {page_lines(d)} p)"


_NUMBER = P.NUMERIC.replace("^", "^\\s*").replace("$", "\\s*$")


def _furniture_sql(d) -> str:
    return f"""WITH l AS (SELECT doc_id, page, pos, coalesce(text, '') AS t, round(x0) AS x, round(y0) AS y, regexp_matches(coalesce(text, ''), '{_NUMBER}') AS num FROM {_placed_lines(d)} v),
d AS (SELECT doc_id, count(DISTINCT page) AS pages, bool_or(x IS NOT NULL) AS placed FROM l GROUP BY doc_id),
t AS (SELECT doc_id, x, y, t, count(*) AS n FROM l WHERE x IS NOT NULL GROUP BY ALL), m AS (SELECT doc_id, x, y, max(n) AS same FROM t GROUP BY ALL),
s AS (SELECT doc_id, x, y, count(*) AS n, count(*) FILTER (num) AS numbers, count(DISTINCT page) AS seen FROM l WHERE x IS NOT NULL GROUP BY ALL),
f AS (SELECT s.doc_id, s.x, s.y FROM s JOIN m USING (doc_id, x, y) JOIN d USING (doc_id) WHERE seen >= {P.MIN_PAGES} AND seen::DOUBLE / pages >= {P.PAGE_SHARE} AND (same::DOUBLE / n >= {P.SAME_SHARE} OR numbers::DOUBLE / n >= {P.SAME_SHARE})),
k AS (SELECT l.doc_id, CASE WHEN num THEN '#' ELSE t END AS key FROM l JOIN d USING (doc_id) WHERE NOT placed GROUP BY l.doc_id, key, pages HAVING count(DISTINCT page) >= {P.MIN_PAGES} AND count(DISTINCT page)::DOUBLE / pages >= {P.PAGE_SHARE})
SELECT l.doc_id, l.pos, f.x IS NOT NULL OR k.key IS NOT NULL AS is_boilerplate FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.x = l.x AND f.y = l.y LEFT JOIN k ON k.doc_id = l.doc_id AND k.key = CASE WHEN num THEN '#' ELSE t END"""


@_query(_furniture_sql)
def page_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines come back page by page, by place or, without any geometry, by text."""
    return P.marked_furniture(_view(_placed_lines)(spark, sf_dir)).select("doc_id", "pos", "is_boilerplate")


_BLOCKS = "SELECT conv_id, turn, concat(coalesce(text, ''), CASE turn % 5 WHEN 0 THEN '**' WHEN 1 THEN concat(chr(10), '○○○ end') WHEN 2 THEN ' * ○ ●' WHEN 3 THEN '●●' ELSE '' END, coalesce(text, '')) AS t FROM {conversations}"


@_query(
    lambda d: f"""WITH b AS ({_BLOCKS}), m AS (SELECT conv_id, turn, t, length(regexp_extract(t, '(?s)^(.*?)(?:{P.MASKS})', 1)) AS before FROM b WHERE regexp_matches(t, '{P.MASKS}')), s AS (SELECT *, greatest(0, before - 30) AS start FROM m)
SELECT conv_id, turn, concat(CASE WHEN start > 0 THEN '…' ELSE '' END, trim(replace(substr(t, start + 1, 60), chr(10), ' ')), CASE WHEN start + 60 < length(t) THEN '…' ELSE '' END) AS context FROM s"""
)
def mask_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first masked run of each block, in the middle of its context."""
    blocks = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id", "turn", _BLOCKS.partition("turn, ")[2].rpartition(" FROM")[0])
    return blocks.select("conv_id", "turn", P.mask_slot(F.col("t")).alias("context")).where("context IS NOT NULL")


def _candidates(d) -> str:
    """Two lines of a document each, as they were found; some have changed since, in every way that a candidate can."""
    two = f"SELECT doc_id, page, pos, text AS a, lead(text) OVER (PARTITION BY doc_id ORDER BY pos) AS b, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM {page_lines(d)} p"
    joined = "concat(a, CASE WHEN a = '' OR a LIKE '% ' OR b LIKE ' %' THEN '' ELSE ' ' END, b)"
    said = f"CASE WHEN pos % 11 = 4 THEN concat({joined}, '!') ELSE {joined} END"
    return f"""(SELECT concat(CAST(doc_id AS STRING), '/', CAST(pos AS STRING)) AS candidate_id, doc_id, CASE WHEN doc_id % 13 = 0 THEN 'old' ELSE concat('e', CAST(doc_id AS STRING)) END AS extraction_id, pos, CASE WHEN pos % 7 = 5 THEN next + 100000 ELSE next END AS next,
{said} AS text, {d.sha(f"CASE WHEN pos % 19 = 6 THEN 'x' ELSE {said} END")} AS text_sha256, page FROM ({two}) t WHERE next IS NOT NULL)"""


@_query(
    lambda d: f"""WITH l AS (SELECT doc_id, pos, page, pos % 12 = 11 AS furniture FROM {page_lines(d)} p)
SELECT candidate_id, CASE WHEN c.pos % 19 = 6 THEN 'text_sha256 differs' WHEN c.doc_id % 13 = 0 THEN 'stale extraction_id' WHEN c.pos % 7 = 5 THEN 'lines not found' WHEN l.furniture OR m.furniture THEN 'boilerplate line' WHEN c.pos % 11 = 4 THEN 'line text differs'
WHEN l.page <> m.page THEN 'page differs' END AS error FROM {_candidates(d)} c JOIN l ON l.doc_id = c.doc_id AND l.pos = c.pos LEFT JOIN l m ON m.doc_id = c.doc_id AND m.pos = c.next"""
)
def candidate_revalidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates against the current lines of their documents: what isn't so any more."""
    found = _view(_candidates)(spark, sf_dir).withColumn("line_ids", F.array("pos", "next"))
    lines = _view(page_lines)(spark, sf_dir).select("doc_id", F.concat(F.lit("e"), "doc_id").alias("extraction_id"), F.col("pos").alias("line_id"), "page", F.col("text").alias("cleaned_text"), (F.col("pos") % 12 == 11).alias("is_boilerplate"))
    return P.revalidated(found, lines).select("candidate_id", "error")


_KINDS = ("report", "approval", "personnel", "unruled")


def _spans(d) -> str:
    at = lambda n, m: f"{d.whole('id', str(n))} % {m}"
    return f"(SELECT id, {_nth('id % 2', ('5', '7'))} AS clause_no, {_nth(at(2, 2), ('s1', 's2'))} AS subclause, {_nth(at(4, 4), _KINDS)} AS doc_type, {d.whole('id', '5')} AS doc FROM {registry(d)} r WHERE id % 6 <> 1 OR id % 9 = 0)"


_CELLS = [(c, s, k) for c in ("5", "7", "9") for s in ("s1", "s2") for k in _KINDS]


@_query(
    lambda d: f"""WITH c AS (SELECT * FROM {_spans(d)} v), t AS (SELECT DISTINCT doc, status FROM (SELECT doc, {_nth('id % 4', ('초안', '결재진행중', None, None))} AS status FROM c WHERE doc % 3 = 0 AND doc_type <> 'personnel') x WHERE status IS NOT NULL),
n AS (SELECT clause_no, subclause, doc_type, count(*) AS spans, count(DISTINCT doc) AS docs FROM c GROUP BY ALL), k AS (SELECT DISTINCT clause_no, subclause, doc_type, doc FROM c),
b AS (SELECT clause_no, subclause, doc_type, string_agg(concat(status, '=', n), ',' ORDER BY status) AS said FROM (SELECT clause_no, subclause, doc_type, status, count(*) AS n FROM k JOIN t USING (doc) GROUP BY ALL) y GROUP BY ALL)
SELECT v.clause_no, v.subclause, v.doc_type, CASE WHEN v.doc_type = 'unruled' THEN 'no_rule' WHEN said IS NULL THEN 'zero_matches' ELSE 'counted' END AS state, coalesce(spans, 0)::BIGINT AS span_candidates, coalesce(docs, 0)::BIGINT AS matching_docs, CASE WHEN v.doc_type <> 'unruled' THEN said END AS by_status
FROM {values(_CELLS, 'clause_no, subclause, doc_type')} v LEFT JOIN n USING (clause_no, subclause, doc_type) LEFT JOIN b USING (clause_no, subclause, doc_type)"""
)
def clause_admin_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause candidates of every cell, and the administrative statuses of their documents."""
    found = _view(_spans)(spark, sf_dir)
    status = F.when(F.col("id") % 4 == 0, "초안").when(F.col("id") % 4 == 1, "결재진행중")
    statuses = found.where("doc % 3 = 0 AND doc_type <> 'personnel'").select("doc", status.alias("status")).where("status IS NOT NULL")
    cells = spark.createDataFrame(_CELLS, "clause_no string, subclause string, doc_type string")
    out = P.cell_measures(found, statuses, cells, tuple(STATUS_RULES))
    return out.withColumn("by_status", F.array_join(F.transform(F.map_entries("by_status"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","))


_TITLES = ("[합성] 계획 (안) — 2024", "(초안)[검토] 결과 보고", "  공고 – 제 3호  ", "!!", "", None, "보고", "보고", "a" * 130)


@_query(
    lambda d: f"""WITH r AS (SELECT id, {_nth(f'id % {len(_TITLES)}', _TITLES)} AS title FROM {registry(d)} r),
b AS (SELECT id, title, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(coalesce(title, ''), '[\\[\\]()（）]', '', 'g')), '[—–]', '-', 'g'), '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g'), '[^\\p{{L}}\\p{{N}}_.-]', '', 'g'), '._-'), 1, 120) AS base FROM r),
c AS (SELECT id, title, CASE WHEN base = '' THEN CAST(id AS VARCHAR) ELSE base END AS base FROM b)
SELECT id, trim(regexp_replace(trim(coalesce(title, '')), '^(?:\\s*[\\[(（][^\\])）]*[\\])）]\\s*)+', '')) AS bare_title, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY id) = 1 THEN base ELSE concat(base, '_', row_number() OVER (PARTITION BY base ORDER BY id)) END AS file_name,
CAST(concat('0x', substr(sha256(concat('7:', id)), 1, 8)) AS BIGINT) / 4294967295.0 < 0.25 AS chosen FROM c"""
)
def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without labels, file names that don't repeat, and the quarter of the rows that a seed chooses."""
    rows = _view(lambda d: f"(SELECT id, {_nth(f'id % {len(_TITLES)}', _TITLES)} AS title FROM {registry(d)} r)")(spark, sf_dir)
    named = P.file_names(rows)
    return named.select("id", P.without_label(F.col("title")).alias("bare_title"), "file_name", P.chosen(F.col("id"), 7, 0.25).alias("chosen"))


ORACLE = {name: check_sql(sql) for name, sql in _SQL.items()}
