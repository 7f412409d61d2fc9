"""Disclosure rules over the test tables: what is kept, changed, named, quoted or deleted.

The SQL that checks them is written apart, from the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import disclosure as D
from ..operators import quotes as Q
from ..sources import files
from ..sources.dims import CONFLICTING_SUBCLAUSES, GRADE_BASES, GRADE_NAMES, GRADE_POSITIONS, GRADE_RANKS, NATIVE_SUBCLAUSES, SCENARIO_FIELDS
from ..sources.views import page_lines, registry
from .dialect import check_sql, spark_query, text, values

#: Share of graded documents that get a history of a higher grade, and the day that ends it.
HISTORY_RATIO, TODAY = 0.2, "1998-12-31"

QUERIES, _SQL = {}, {}


def _query(sql):
    def add(f):
        QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_query(lambda d: f"SELECT * FROM {registry(d)} r")(spark, sf_dir)


def _nth(x: Column, names: tuple) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (x + 1).cast("int"))


def _sql_nth(x: str, names: tuple) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {'NULL' if n is None else text(n)}" for i, n in enumerate(names)) + " END"


def _hash(salt: str) -> str:
    return f"CAST(concat('0x', substr(sha256(concat('{salt}/', CAST(id AS VARCHAR))), 1, 15)) AS BIGINT)"


# ------------------------------------------------------------------------------------------ gates


@_query(
    lambda d: """SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN CASE WHEN d.doc_id % 5 <> 0 THEN true WHEN d.doc_id % 7 = 0 THEN false ELSE l.toxic = 0 END ELSE false END, false) AS commits,
coalesce(l.quality = 1, false) AS commits_with_weak_masks FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""
)
def commit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which results become rows, without and with weakly restored masks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    status = F.when(F.col("quality") == 1, "accepted_s").when(F.col("quality") == 0, "rejected")
    route = F.when(F.col("doc_id") % 5 == 0, "mask_restoration").otherwise("direct")
    verdict = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("toxic") == 0, "accepted_s").otherwise("rejected")
    rows = docs.join(labels, "doc_id", "left")
    return rows.select("doc_id", D.commits(status, route, verdict).alias("commits"), D.commits(status, route, verdict, True).alias("commits_with_weak_masks"))


def _selection_sql(d) -> str:
    config = '{"max_selected_blocks":40,"policy_version":"p1"}'
    blocks = """string_agg(concat('{"block_id":"', block_id, '","page_number":', page, ',"text":', to_json(text), '}'), ',' ORDER BY pos)"""
    begin, end = '{"normalization_version":"canonical-json-v1","value":{"method":"front_relevance","selected_blocks":[', '"}}'
    return f"""WITH c AS (SELECT doc_id, pos, page, concat('p', page, ':b', pos) AS block_id, text FROM {page_lines(d)} p),
a AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN count(*) ELSE count(*) FILTER (pos % 5 = doc_id % 4) END + CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS n FROM c GROUP BY doc_id),
e AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'source changed' WHEN doc_id % 19 = 0 THEN 'selection config changed' WHEN n > 40 THEN concat('selected ', n, ' blocks; maximum is 40') WHEN doc_id % 11 = 0 THEN 'unknown block IDs: stray' WHEN n = 0 THEN 'no usable blocks' END AS error FROM a),
k AS (SELECT e.doc_id, pos, page, block_id, text FROM e JOIN c ON c.doc_id = e.doc_id WHERE error IS NULL AND (e.doc_id % 17 = 0 OR pos % 5 = e.doc_id % 4)),
f AS (SELECT doc_id, string_agg(block_id, ',' ORDER BY pos) AS block_ids, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages,
  sha256(concat('{begin}', {blocks}, '],"selection_config":{config},"source_document_id":', doc_id, ',"source_sha256":"', sha256(concat('doc', doc_id)), '{end}')) AS selection_sha256 FROM k GROUP BY doc_id)
SELECT e.doc_id, error, pages, block_ids, selection_sha256 FROM e LEFT JOIN f ON e.doc_id = f.doc_id"""


@_query(_selection_sql)
def final_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered block ids that are known, in the order of the source, with a digest of what they rest on; or why the answer is void."""
    lines = spark_query(lambda d: f"SELECT doc_id, pos, page, text FROM {page_lines(d)} p")(spark, sf_dir)
    candidates = lines.select("doc_id", "pos", F.col("page").alias("page_number"), F.concat(F.lit("p"), "page", F.lit(":b"), "pos").alias("block_id"), "text")
    docs = candidates.select("doc_id").distinct()
    source, config = F.sha2(F.concat(F.lit("doc"), "doc_id"), 256), F.struct(F.lit(D.MOST_BLOCKS).alias("max_selected_blocks"), F.lit("p1").alias("policy_version"))
    current = docs.select("doc_id", source.alias("source_sha256"), F.lit("c1").alias("config_sha256"), config.alias("config"))
    chosen = (F.col("doc_id") % 17 == 0) | (F.col("pos") % 5 == F.col("doc_id") % 4)
    ids = candidates.groupBy("doc_id").agg(F.collect_list(F.when(chosen, F.col("block_id"))).alias("ids"))  # stands for a model's answer, one row a document
    answers = ids.select(
        "doc_id", F.when(F.col("doc_id") % 13 == 0, "other").otherwise(source).alias("source_sha256"), F.when(F.col("doc_id") % 19 == 0, "c0").otherwise("c1").alias("config_sha256"),
        F.when(F.col("doc_id") % 11 == 0, F.concat("ids", F.array(F.lit("stray")))).otherwise(F.reverse("ids")).alias("block_ids"),
    )
    found = D.finalized_selections(answers, current, candidates)
    return found.withColumn("pages", F.array_join("pages", ",")).withColumn("block_ids", F.array_join("block_ids", ","))


_SPAN = "CASE WHEN turn % 7 = 0 THEN concat(chr(1), substr(text, 1, 5)) WHEN turn % 7 = 3 THEN substr(text, 3, 2) ELSE concat(' ', substr(text, 3, 12)) END"
_LINK = "substr(text, 1, CASE WHEN turn % 2 = 0 THEN 30 ELSE 20 END)"


def _assertion_sql(d) -> str:
    bare = lambda x: f"regexp_replace(coalesce({x}, ''), '\\s+', '', 'g')"
    state = lambda q: f"CASE WHEN {q} = '' THEN 'empty' WHEN instr(block, {q}) = 0 THEN 'not found' WHEN instr(substr(block, instr(block, {q}) + 1), {q}) > 0 THEN 'ambiguous' END AS {q}e"
    return f"""WITH x AS (SELECT conv_id, turn, {bare('text')} AS block, {bare(_SPAN)} AS s, {bare('substr(text, 16, 10)')} AS v, {bare(_LINK)} AS l, text IS NULL AS gone FROM {{conversations}}),
n AS (SELECT *, {state('s')}, {state('v')}, {state('l')} FROM x)
SELECT conv_id, turn, CASE WHEN gone THEN 'subject: unknown block' WHEN se IS NOT NULL THEN concat('subject: ', se) WHEN ve IS NOT NULL THEN concat('value: ', ve) WHEN le IS NOT NULL THEN concat('link: ', le)
WHEN turn % 5 = 0 THEN 'spans of several blocks' WHEN NOT contains(l, s) THEN 'link lacks the subject' WHEN NOT contains(l, v) THEN 'link lacks the value' END AS error FROM n"""


@_query(_assertion_sql)
def assertion_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject, value and link must each be found once, in one block, and the link must hold the other two."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id", "turn", "text", f"{_SPAN} AS subject_quote", "substr(text, 16, 10) AS value_quote", f"{_LINK} AS link_quote")
    other = F.when(F.col("turn") % 5 == 0, F.col("turn") + 1).otherwise(F.col("turn"))
    rows = turns.select("*", *(F.col("text").alias(f"{n}_text") for n in ("subject", "value", "link")), F.col("turn").alias("subject_block"), other.alias("value_block"), F.col("turn").alias("link_block"))
    return Q.assertion_errors(rows).select("conv_id", "turn", "error")


# ----------------------------------------------------------------------------------------- histories


def _history_sql(d) -> str:
    of = lambda names, salt: _sql_nth(f"{_hash(salt)} % {len(names)}", names)
    return f"""SELECT id, CASE WHEN grade = '2급' THEN '1급' ELSE {of(('1급', '2급'), 'grade')} END AS old_grade, {of(GRADE_BASES, 'basis')} AS basis_text,
CAST(produced + CAST(1 + {_hash('day')} % least(730, DATE '{TODAY}' - produced) AS INT) AS DATE) AS changed_on, {of(GRADE_POSITIONS, 'position')} AS position, {of(GRADE_RANKS, 'rank')} AS rank, {of(GRADE_NAMES, 'name')} AS name
FROM (SELECT id, production_date AS produced, {_sql_nth('id % 4', ('1급', '2급', '3급', None))} AS grade FROM {registry(d)} r) x WHERE grade IN ('2급', '3급') AND produced < DATE '{TODAY}' AND {_hash('history')} / 1152921504606846976.0 < {HISTORY_RATIO}"""


@_query(_history_sql)
def grade_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share of graded documents once had a higher grade: since when, why, and who signed."""
    rows = _registry(spark, sf_dir).select("id", F.col("production_date").alias("produced"), _nth(F.col("id") % 4, ("1급", "2급", "3급", None)).alias("grade"))
    return D.grade_histories(rows, TODAY, HISTORY_RATIO)


# ------------------------------------------------------------------------------------- personal values

_VALUES = ("주민등록번호: 900101-1234567", "연락처 010-1234-5678, 계좌 321-45-678901", "생년월일: 1990-01-02 가구원 현황", "가900101-1234567 검진결과", "신주소 인사사항 900101-5234567", "1900101-1234567", "900101-2234567_ 011-123-4567")


def _value_sql(d) -> str:
    patterns = {"res": "[0-9]{6}-[1-4][0-9]{6}", "tel": "01[016789]-[0-9]{3,4}-[0-9]{4}", "born": "(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}", "acc": "[0-9]{3}-[0-9]{2,4}-[0-9]{4,6}"}
    side = "[^\\p{L}\\p{N}_]"
    has = ", ".join(f"regexp_matches(t, '{side}{p}{side}') AS {c}" for c, p in patterns.items())
    return f"""WITH r AS (SELECT id, CASE WHEN id % 10 < 9 THEN id % 10 END AS n, concat(' ', {_sql_nth('id % 7', _VALUES)}, ' / ', {_sql_nth('(id // 7) % 7', _VALUES)}, ' ') AS t FROM {registry(d)} r),
h AS (SELECT id, coalesce(n, 0) AS n, t, {has} FROM r),
f AS (SELECT *, {_sql_nth('n', tuple(SCENARIO_FIELDS.get(i) for i in range(9)))} AS field FROM h)
SELECT id, concat_ws(' / ', CASE WHEN n IN (1, 3) THEN CASE WHEN NOT born THEN '생년월일 실제 값이 없음' END WHEN NOT res THEN '주민등록번호 형식의 합성 값이 없음' END, CASE WHEN n IN (0, 1) AND NOT tel THEN '개인 연락처 실제 값이 없음' END,
CASE WHEN n IN (1, 4) AND NOT acc THEN '계좌번호 실제 값이 없음' END, CASE WHEN NOT contains(t, field) THEN concat('시나리오 필수 필드 ', chr(39), field, chr(39), '가 없음') END) AS missing FROM f"""


@_query(_value_sql)
def scenario_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What texts on personal data lack for their scenario."""
    at = lambda n: _nth(F.floor(F.col("id") / n) % 7, _VALUES)
    rows = _registry(spark, sf_dir).select("id", F.when(F.col("id") % 10 < 9, F.col("id") % 10).alias("n"), F.concat_ws(" / ", at(1), at(7)).alias("t"))
    return rows.select("id", F.array_join(D.missing_values(F.col("t"), F.col("n")), " / ").alias("missing"))


# -------------------------------------------------------------------------------- agencies and contents

_POOLS = (("1", (("국방부", "외교부"), (), ("감사원",))), ("5", ((),)))
_LISTED = (("1", ("국가정보원", "국방부", "법무부")), ("5", ("감사원", "조달청")), ("6", ()))
_CLAUSE_AT = ("1", "5", "6", "9", None)


def _agency_sql(d) -> str:
    listed = "CASE clause_no WHEN '1' THEN ['국가정보원', '국방부', '법무부'] WHEN '5' THEN ['감사원', '조달청'] END"
    return f"""WITH r AS (SELECT id, {_sql_nth('id % 5', _CLAUSE_AT)} AS clause_no, CASE WHEN (id // 5) % 8 < 7 THEN (id // 5) % 8 END AS scenario FROM {registry(d)} r),
p AS (SELECT *, CASE WHEN clause_no = '1' AND scenario % 3 = 0 THEN ['국방부', '외교부'] WHEN clause_no = '1' AND scenario % 3 = 2 THEN ['감사원'] ELSE {listed} END AS pool FROM r),
a AS (SELECT *, pool[{_hash('agency')} % len(pool) + 1] AS agency FROM p)
SELECT id, agency, CASE WHEN pool IS NULL THEN concat('no agency for clause ', coalesce(clause_no, 'null')) END AS error, coalesce(clause_no = '1' AND scenario IN (0, 2, 5) AND agency <> '국방부', false) AS military FROM a"""


@_query(_agency_sql)
def scenario_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agency for every document from its scenario, else its clause, and whether its scenario is a tagged one."""
    rows = _registry(spark, sf_dir).select("id", _nth(F.col("id") % 5, _CLAUSE_AT).alias("clause_no"), F.when(F.floor(F.col("id") / 5) % 8 < 7, F.floor(F.col("id") / 5) % 8).alias("scenario"))
    pools = spark.createDataFrame([(c, [list(p) for p in ps]) for c, ps in _POOLS], "clause_no string, scenarios array<array<string>>")
    listed = spark.createDataFrame([(c, list(a)) for c, a in _LISTED], "clause_no string, agencies array<string>")
    tagged = spark.createDataFrame([("1", 0), ("1", 2), ("1", 5), ("5", 99)], "clause_no string, scenario long")
    return D.military_content(D.agencies(rows, pools, listed), tagged, ("국방부",)).select("id", "agency", "error", "military")


_POINTS = (("5", "audit_inspection", "report", ("조사 방법", "조치 계획"), ("일정",)), ("7", "unit_cost", "bid_notice", ("납품단가",), ()))


@_query(
    lambda d: f"""SELECT id, CASE WHEN id % 4 = 0 AND doc_type = 'report' THEN {text("핵심 비공개 사유로 '조사 방법·조치 계획'를 다루고, '일정'는 부수적으로만 곁들여라.")}
WHEN id % 4 = 1 AND doc_type = 'notice' THEN {text("핵심 비공개 사유로 '납품단가'를 다뤄라.")} END AS description FROM {registry(d)} r"""
)
def content_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a text of each leaf is about; null where nothing is declared."""
    leaf = _nth(F.col("id") % 4, ("audit_inspection", "unit_cost", "unheard_of", None))
    rows = _registry(spark, sf_dir).select("id", F.when(F.col("id") % 4 == 0, " 5").otherwise("7").alias("clause_no"), leaf.alias("subclause"), F.when(F.col("doc_type") == "notice", "bid_notice").otherwise(F.col("doc_type")).alias("doc_type"))
    points = spark.createDataFrame([(c, s, t, list(a), list(b)) for c, s, t, a, b in _POINTS], "clause_no string, subclause string, doc_type string, core array<string>, secondary array<string>")
    return D.content_descriptions(rows, points).select("id", "description")


_FORM_AT, _SUB_AT = (*NATIVE_SUBCLAUSES, "unheard_of", None), (*D.TARGET_SUBCLAUSES, "life_body", None)


def _level_sql(d) -> str:
    table = [(f, s, "native") for f, subs in NATIVE_SUBCLAUSES.items() for s in subs] + [(f, s, "conflict") for f, subs in CONFLICTING_SUBCLAUSES.items() for s in subs]
    return f"""WITH r AS (SELECT {_sql_nth(f'id % {len(_FORM_AT)}', _FORM_AT)} AS form, {_sql_nth(f'(id // {len(_FORM_AT)}) % {len(_SUB_AT)}', _SUB_AT)} AS sub FROM {registry(d)} r)
SELECT form AS document_form, CASE WHEN form IS NULL OR form = 'unheard_of' OR sub IS NULL OR sub = 'life_body' THEN NULL ELSE coalesce(v.level, 'bridge') END AS level,
CASE WHEN form IS NULL OR form = 'unheard_of' THEN concat('unknown form: ', coalesce(form, 'null')) WHEN sub IS NULL OR sub = 'life_body' THEN concat('unsupported subclause: ', coalesce(sub, 'null')) END AS error, count(DISTINCT sub) AS subclauses, count(*) AS documents
FROM r LEFT JOIN {values(table, 'f, s, level')} v ON v.f = form AND v.s = sub GROUP BY 1, 2, 3"""


@_query(_level_sql)
def form_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by form and by how well it carries their subclause, and how many subclauses those are."""
    n = len(_FORM_AT)
    rows = _registry(spark, sf_dir).select(_nth(F.col("id") % n, _FORM_AT).alias("document_form"), _nth(F.floor(F.col("id") / n) % len(_SUB_AT), _SUB_AT).alias("subclause"))
    return D.form_levels(rows).groupBy("document_form", "level", "error").agg(F.count_distinct("subclause").alias("subclauses"), F.count(F.lit(1)).alias("documents"))


# --------------------------------------------------------------------------------------------- files


@_query(
    lambda d: """SELECT page_id, CASE WHEN lower(suffix) NOT IN ('.pdf', '.hwp', '.hwpx') THEN 'suffix' ELSE 'stub' END AS reason FROM (SELECT page_id, html, CASE page_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.HWP' WHEN 2 THEN '.xlsx' WHEN 3 THEN '.json' WHEN 4 THEN '' ELSE '.hwpx' END AS suffix FROM {pages} WHERE page_id % 7 <> 0) x
WHERE lower(suffix) <> '.json' AND (lower(suffix) NOT IN ('.pdf', '.hwp', '.hwpx') OR (page_id % 5 > 0 AND (contains(lower(substr(coalesce(html, ''), 1, 200)), '<html') OR contains(lower(substr(coalesce(html, ''), 1, 200)), '<!doctype html'))))"""
)
def deletion_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that aren't documents: of another kind, or web pages under a document's name; own outputs are left alone."""
    suffix = _nth(F.col("page_id") % 6, (".pdf", ".HWP", ".xlsx", ".json", "", ".hwpx"))
    folder = F.when(F.col("page_id") % 7 == 0, "/data/extracted/x/").otherwise("/data/site/")
    head = F.when(F.col("page_id") % 5 > 0, F.substring(F.coalesce("html", F.lit("")), 1, 200)).otherwise("%PDF-1.7")
    found = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.concat(folder, F.col("page_id"), suffix).alias("path"), F.encode(head, "utf-8").alias("content"))
    return files.deletion_targets(found, "/data").select("page_id", "reason")


ORACLE = {name: check_sql(sql) for name, sql in _SQL.items()}
