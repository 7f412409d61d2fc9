"""Generated records: types told from payloads, documents as blocks, lines by bands, a queue in two passes.

The operators take any rows; the queries here apply them to the test tables. The SQL that checks
them is written apart, from the rules.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.text import WHITE
from ..operators import bands, blocks, payloads
from ..sources.dims import APPROVAL_COLUMNS, BULLETS, DRAFT_BLANKS, FORM_BUCKETS, FORM_TYPES, GUIDE_WORDS, HEADER_KEYS, REMOVED_TYPES, RENDERERS, RESEARCH_WORDS, STATUS_WORDS
from ..sources.views import korean_lines, registry
from ..store import run_folder
from ..streaming import ingest
from ..streaming.queue import PendingQueue, backfill, collect
from .dialect import Spark, any_in, check_sql, spark_query, text, values

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


# ------------------------------------------------------------------------------------------- payloads

_FORMS = (*FORM_BUCKETS, "unheard_of", "  ", None)
_ENDINGS = ("", " 연구보고서", " 추진현황", " 회의록", " 고시(안)", " 업무 가이드", " 용역 재공고", " 검토안", " 질의회시집", " 보도자료", " 조사 보고서")
_RESULTS = (
    '"source_classification":{"document_type":"guide"},', '"source_classification":{"document_type":5,"document_form":"report"},', '"source_classification":{"document_form":" report "},',
    '"source_classification":null,', '"source_classification":[1],"provenance":{"document_form":"legal_review"},', '"provenance":{"document_form":"other"},', '"source_classification":{"document_type":null},',
)
_LEADS = ("본문", "입찰공고 자료", "연구 개요", "")


def payload_rows(d: Spark) -> str:
    """Payloads as JSON text: forms in several places, explicit types of any kind, blocks, and some that are malformed or of another shape."""
    form = _nth(f"id % {len(_FORMS)}", [f'"document_form":{"7" if f == "  " else chr(34) + f + chr(34)}' if f else '"batch":1' for f in _FORMS])
    blocks_ = f"""concat('[{{"kind":"table"}},{{"kind":"paragraph","text":" "}},{{"kind":"paragraph","text":" ', {_nth(f'id % {len(_LEADS)}', _LEADS)}, ' "}},7,{{"kind":"paragraph","text":["x"]}},{{"kind":"paragraph","text":"둘째"}},{{"kind":"paragraph","text":"입찰공고 자료"}}]')"""
    result = f"""concat('{{', {_nth(f'id % {len(_RESULTS)}', _RESULTS)}, '"generated_document":{{"title":" ', title, {_nth(f'id % {len(_ENDINGS)}', _ENDINGS)}, ' ","blocks":', {blocks_}, '}}}}')"""
    whole = f"concat('{{\"provenance\":{{', {form}, '}},\"result\":', CASE WHEN id % 17 = 0 THEN '\"none\"' ELSE {result} END, CASE WHEN id % 29 = 0 THEN '' ELSE '}}' END)"
    return f"(SELECT id, CASE WHEN id % 37 = 0 THEN NULL WHEN id % 41 = 0 THEN '[]' ELSE {whole} END AS payload FROM {registry(d)} r)".replace("{{", "{").replace("}}", "}")


def _typed(kind: str, reason: str) -> str:
    return f"{{'kind': {text(kind)}, 'reason': {text(reason)}}}"


def _type_sql(d: Spark) -> str:
    string = lambda path: f"CASE WHEN json_type(j, '{path}') = 'VARCHAR' THEN json_extract_string(j, '{path}') END"
    form = lambda path: f"nullif(trim({string(path + '.document_form')}), '')"
    has = lambda word: f"contains(title, {text(word)})"
    case = lambda *rules: "CASE " + " ".join(f"WHEN {c} THEN {_typed(k, r)}" for c, k, r in rules) + " END"
    bid = ((has("사전규격"), "pre_spec_notice", "title:사전규격"), (has("재공고"), "bid_renotice", "title:재공고"), (has("공모"), "public_offering", "title:공모"),
           (f"({has('입찰공고')} OR {has('공고문')})", "bid_notice", "title:입찰공고"), ("contains(lead, '입찰공고 자료')", "bid_notice", "lead:입찰공고 자료"))
    rule = ((has("고시"), "notification", "title:고시"), (has("훈령"), "directive", "title:훈령"), (has("예규"), "regulation", "title:예규"))
    policy = ((f"({has('질의회시')} OR {has('질의·회시')})", "interpretation_compilation", "title:질의회시"), (any_in("title", GUIDE_WORDS), "guide", "guide keyword"))
    status = (any_in("title", STATUS_WORDS), "status_report", "status keyword")
    by_form = {
        "report": case((any_in("title", RESEARCH_WORDS), "research_report", "research keyword"), status, ("true", "status_report", "generic report")),
        "bid_material": case(*bid, ("true", "official_document", "bid subtype is not explicit in generated content")),
        "policy_material": case(*policy, ("true", "policy_material", "generic policy material")),
        "administrative_rule": case(*rule, ("true", "official_document", "administrative-rule subtype is not explicit in title")),
        "other": case(
            (has("회의록"), "meeting_minutes", "title:회의록"), (has("보도자료"), "press_release", "title:보도자료"), *rule, *policy, *bid,
            (f"({has('보고서')} AND {any_in('concat(title, chr(10), lead)', RESEARCH_WORDS)})", "research_report", "report research keyword"), status,
            (f"({has('검토안')} OR {has('검토자료')})", "research_report", "title:검토"), ("true", "official_document", "ambiguous other form"),
        ),
    } | {name: _typed(kind, f"document_form:{name}") for name, kind in FORM_TYPES.items()}
    inferred = "CASE form " + " ".join(f"WHEN {text(n)} THEN {k}" for n, k in by_form.items()) + " END"
    path = "$.result.source_classification.document_type"
    return f"""WITH p AS (SELECT id, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM {payload_rows(d)} v),
q AS (SELECT id, json_type(j, '{path}') IS NOT NULL AS stated, {string(path)} AS explicit, {form('$.provenance')} AS top, {form('$.result.source_classification')} AS own, {form('$.result.provenance')} AS res,
  coalesce(trim({string('$.result.generated_document.title')}), '') AS title,
  array_to_string(list_filter(list_transform(list_filter(json_extract(j, '$.result.generated_document.blocks[*]'), lambda b: json_extract_string(b, '$.kind') = 'paragraph'),
    lambda b: CASE WHEN json_type(b, '$.text') = 'VARCHAR' THEN trim(json_extract_string(b, '$.text')) ELSE '' END), lambda t: t <> '')[1:2], chr(10)) AS lead FROM p),
r AS (SELECT *, coalesce(own, top, res) AS form, CASE WHEN own IS NOT NULL AND (top <> own OR res <> own) THEN
  concat('document_form conflict: used result.source_classification over ', array_to_string(list_sort(list_distinct(list_filter([top, res], lambda f: f <> own))), ', '))
  WHEN own IS NULL AND top <> res THEN concat('document_form conflict: used top-level provenance over ', res) END AS conflict FROM q),
s AS (SELECT *, {inferred} AS i FROM r)
SELECT id, CASE WHEN stated THEN explicit ELSE i.kind END AS document_type, CASE WHEN stated THEN 'explicit' WHEN i IS NULL THEN 'unclassified' ELSE 'inferred' END AS type_source, form AS document_form,
CASE WHEN stated THEN concat_ws('; ', 'result.source_classification.document_type', conflict) WHEN form IS NULL THEN 'document_form and explicit document_type are missing'
  WHEN i IS NULL THEN concat('unknown document_form:', form) ELSE concat_ws('; ', i.reason, conflict) END AS reason FROM s"""


@_query(_type_sql)
def payload_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of every payload, where it was told, and why."""
    return payloads.resolve_types(_view(payload_rows)(spark, sf_dir)).drop("payload")


_TYPES = (*RENDERERS, *REMOVED_TYPES, "unheard_of", None)


@_query(
    lambda d: f"""SELECT id, document_type, CASE WHEN document_type IS NULL THEN 'official_document' ELSE family END AS renderer_family, CASE WHEN document_type IS NULL THEN '' ELSE label END AS display_label,
CASE WHEN document_type IN ({', '.join(map(text, REMOVED_TYPES))}) THEN 'removed' WHEN document_type IS NOT NULL AND family IS NULL THEN 'unsupported' END AS render_error
FROM (SELECT id, {_nth(f'id % {len(_TYPES)}', _TYPES)} AS document_type FROM {registry(d)} r) x LEFT JOIN {values([(k, *v) for k, v in RENDERERS.items()], 'name, family, label')} v ON v.name = x.document_type"""
)
def render_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document type is rendered."""
    rows = _view(lambda d: f"(SELECT id, {_nth(f'id % {len(_TYPES)}', _TYPES)} AS document_type FROM {registry(d)} r)")(spark, sf_dir)
    return payloads.renderers(rows)


# --------------------------------------------------------------------------------------------- blocks

_KINDS = ("key_value", "paragraph", "bullet_list", "table", "attachment_reference")
_HEADS = ("문서번호", "수신", "시행일자", "장소", "공고번호", "담당부서")
_STATUSES = ("초안", "결재진행중", "첨부미등록", "공개심사중")
_FORM_AT = (*HEADER_KEYS, None)


def block_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, blocks, document_form, statuses): conversations as documents, each turn a block of the kind that its number tells."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("t"))
    part = lambda a, n: F.substring("t", a, n)
    nth = lambda names, x: F.get(F.array(*map(F.lit, names)), F.pmod(x, F.lit(len(names))).cast("int"))
    entry = lambda k, v: F.struct(nth(_HEADS, F.col("conv_id") + F.col("turn") + k).alias("key"), v.alias("value"))
    kind = nth(_KINDS, F.col("turn") + F.col("conv_id") % 2)
    only = lambda name, value: F.when(kind == name, value)
    block = F.struct(
        kind.alias("kind"), F.concat(F.lit("b"), "turn").alias("block_id"), only("paragraph", F.col("t")).alias("text"),
        only("bullet_list", F.array(F.concat(F.lit("○ "), part(1, 6)), part(7, 6), F.concat(F.lit("-"), part(1, 3)), F.lit(" ※ "))).alias("items"),
        only("key_value", F.array(entry(0, F.when(F.col("conv_id") % 3 == 0, "").otherwise(part(1, 5))), entry(1, part(6, 5)))).alias("entries"),
        only("table", F.array(F.when(F.col("conv_id") % 2 == 0, "기안자").otherwise("항목"), F.lit("최종 결재"))).alias("columns"),
        only("table", F.array(F.array(F.concat(F.lit(" "), part(2, 4), F.lit(" ")), F.lit("")), F.array(part(6, 4), F.lit("\t9")))).alias("rows"),
        only("attachment_reference", F.concat(F.lit("A"), "turn")).alias("attachment_id"), only("attachment_reference", part(1, 8)).alias("label"),
        only("attachment_reference", F.when(F.col("turn") % 2 == 0, part(9, 4))).alias("description"),
    ).cast(blocks.BLOCK)
    docs = turns.select("conv_id", F.struct("turn", block.alias("block")).alias("x")).groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    statuses = F.when(F.col("conv_id") % 5 == 4, F.array().cast("array<string>")).otherwise(F.array(nth(_STATUSES, F.col("conv_id"))))
    return docs.select("conv_id", F.transform("x", lambda x: x["block"]).alias("blocks"), nth(_FORM_AT, F.col("conv_id")).alias("document_form"), statuses.alias("statuses"))


#: The same turns for the checking SQL: kind, the two entries, and the text's pieces.
_TURNS = f"""t AS (SELECT conv_id, turn, coalesce(text, '') AS t, {_nth(f'(turn + conv_id % 2) % {len(_KINDS)}', _KINDS)} AS kind, {_nth(f'(conv_id + turn) % {len(_HEADS)}', _HEADS)} AS k0, {_nth(f'(conv_id + turn + 1) % {len(_HEADS)}', _HEADS)} AS k1 FROM {{conversations}}),
e AS (SELECT *, CASE WHEN conv_id % 3 = 0 THEN '' ELSE substr(t, 1, 5) END AS v0, substr(t, 6, 5) AS v1, CASE WHEN conv_id % 2 = 0 THEN '기안자' ELSE '항목' END AS c0, CASE WHEN turn % 2 = 0 THEN substr(t, 9, 4) END AS about FROM t)"""


#: White space of any kind, as the rule strips it; without it the SQL's own trim would take spaces alone.
_WHITE = f"concat({', '.join(f'chr({ord(c)})' for c in WHITE)})"


def _bullet_sql(x: str) -> str:
    bare = f"ltrim({x}, {_WHITE})"
    return f"CASE WHEN split_part({bare}, ' ', 1) IN ({', '.join(map(text, BULLETS))}) AND trim(substr({bare}, length(split_part({bare}, ' ', 1)) + 2), {_WHITE}) <> '' THEN {x} ELSE concat('- ', {x}) END"


@_query(
    lambda d: f"""WITH {_TURNS}, s AS (SELECT conv_id, turn, CASE kind WHEN 'paragraph' THEN t WHEN 'key_value' THEN concat(k0, ': ', v0, chr(10), k1, ': ', v1)
WHEN 'bullet_list' THEN concat_ws(chr(10), {_bullet_sql("concat('○ ', substr(t, 1, 6))")}, {_bullet_sql('substr(t, 7, 6)')}, {_bullet_sql("concat('-', substr(t, 1, 3))")}, '-  ※ ')
WHEN 'table' THEN concat(c0, chr(9), '최종 결재', chr(10), trim(concat(' ', substr(t, 2, 4), ' '), {_WHITE}), chr(9), chr(10), trim(substr(t, 6, 4), {_WHITE}), chr(9), '9')
ELSE concat('[첨부] ', substr(t, 1, 8), ' (A', turn, ')', CASE WHEN coalesce(about, '') <> '' THEN concat(': ', about) ELSE '' END) END AS said FROM e)
SELECT conv_id, sha256(string_agg(said, chr(10) || chr(10) ORDER BY turn)) AS body_sha, length(string_agg(said, chr(10) || chr(10) ORDER BY turn))::BIGINT AS chars, count(*) AS blocks FROM s GROUP BY conv_id"""
)
def rendered_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rendered block by block, with an empty line between two."""
    body = block_documents(spark, sf_dir).select("conv_id", blocks.body_text(F.col("blocks")).alias("body"), F.size("blocks").cast("long").alias("blocks"))
    return body.select("conv_id", F.sha2("body", 256).alias("body_sha"), F.length("body").cast("long").alias("chars"), "blocks")


@_query(
    lambda d: f"""WITH {_TURNS}, s AS (SELECT conv_id, turn, CASE kind WHEN 'paragraph' THEN [t] WHEN 'key_value' THEN [k0, v0, k1, v1] WHEN 'bullet_list' THEN [concat('○ ', substr(t, 1, 6)), substr(t, 7, 6), concat('-', substr(t, 1, 3)), ' ※ ']
WHEN 'table' THEN [c0, '최종 결재', concat(' ', substr(t, 2, 4), ' '), '', substr(t, 6, 4), concat(chr(9), '9')] ELSE [concat('A', turn), substr(t, 1, 8), about] END AS said FROM e),
a AS (SELECT conv_id, list_filter(flatten(list(said ORDER BY turn)), lambda x: x IS NOT NULL AND regexp_replace(x, '\\s+', '', 'g') <> '') AS atoms FROM s GROUP BY conv_id)
SELECT conv_id, len(atoms)::BIGINT AS atoms, sha256(array_to_string(atoms, chr(31))) AS atoms_sha FROM a"""
)
def text_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of text of every document that must show in a rendering."""
    atoms = block_documents(spark, sf_dir).select("conv_id", blocks.text_atoms(F.col("blocks")).alias("a"))
    return atoms.select("conv_id", F.size("a").cast("long").alias("atoms"), F.sha2(F.array_join("a", "\x1f"), 256).alias("atoms_sha"))


def _form_sql(d: Spark) -> str:
    heads = values([(f, i, k) for f, keys in HEADER_KEYS.items() for i, k in enumerate(keys)], "form, nth, key")
    marks = " + ".join(f"CASE WHEN contains(concat(c0, ' 최종 결재'), {text(m)}) THEN 1 ELSE 0 END" for m in APPROVAL_COLUMNS)
    return f"""WITH {_TURNS},
d AS (SELECT conv_id, coalesce(bool_or(kind = 'attachment_reference'), false) AS attached, coalesce(bool_or(kind = 'table' AND {marks} >= 2), false) AS approved, bool_or(turn = first AND kind = 'key_value') AS own_head,
  {_nth(f'conv_id % {len(_FORM_AT)}', _FORM_AT)} AS form, CASE WHEN conv_id % 5 < 4 THEN {_nth(f'conv_id % {len(_STATUSES)}', _STATUSES)} END AS status
  FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS first FROM e) x GROUP BY conv_id),
entries AS (SELECT conv_id, unnest([k0, k1]) AS key, unnest([v0, v1]) AS val FROM e WHERE kind = 'key_value'),
held AS (SELECT conv_id, key, bool_or(val <> '') AS filled, bool_or(val = '') AS blank FROM entries GROUP BY conv_id, key),
expected AS (SELECT d.conv_id, h.nth, h.key, x.key IS NOT NULL AS present, coalesce(x.filled, false) AS filled FROM d JOIN {heads} h ON h.form = coalesce(d.form, 'official_letter') LEFT JOIN held x ON x.conv_id = d.conv_id AND x.key = h.key),
head AS (SELECT d.conv_id, CASE WHEN form = 'other' THEN own_head ELSE (SELECT count(*) FILTER (present) >= least(2, count(*)) FROM expected x WHERE x.conv_id = d.conv_id) END AS has_header FROM d),
told AS (
  SELECT d.conv_id, 0 AS a, 0 AS b, CASE WHEN form = 'other' THEN '목록 밖 형식의 첫 key_value 표제부 항목 2개 미만' ELSE concat('문서 머리 정보 부족: ', (SELECT string_agg(key, ', ' ORDER BY nth) FROM expected x WHERE x.conv_id = d.conv_id AND NOT present)) END AS m FROM d JOIN head USING (conv_id) WHERE NOT has_header
  UNION ALL SELECT x.conv_id, 1, nth, CASE WHEN NOT present THEN concat('초안 표제부 ', key, ' 항목 없음') ELSE concat('초안 표제부 ', key, ' 값은 공란이어야 함') END FROM expected x JOIN d USING (conv_id) WHERE status = '초안' AND key IN ('문서번호', '시행일자') AND (NOT present OR filled)
  UNION ALL SELECT x.conv_id, 1, CASE key WHEN '문서번호' THEN 0 ELSE 1 END, concat('초안 표제부 ', key, ' 값은 공란이어야 함') FROM held x JOIN d USING (conv_id) WHERE form = 'other' AND status = '초안' AND key IN ('문서번호', '시행일자') AND filled
  UNION ALL SELECT x.conv_id, 1, CASE key WHEN '문서번호' THEN 0 ELSE 1 END, concat('확정 문서 표제부 ', key, ' 값이 비어 있음') FROM held x JOIN d USING (conv_id) WHERE status IS DISTINCT FROM '초안' AND key IN ('문서번호', '시행일자') AND blank
  UNION ALL SELECT conv_id, 2, 0, '결재란 table block 없음' FROM d WHERE NOT approved AND status IN ('초안', '결재진행중')
  UNION ALL SELECT conv_id, 3, 0, '붙임 attachment_reference block 없음' FROM d WHERE NOT attached AND status = '첨부미등록')
SELECT d.conv_id, form AS document_form, has_header, approved AS has_approval, attached AS has_attachment, coalesce((SELECT string_agg(m, ' / ' ORDER BY a, b) FROM told WHERE told.conv_id = d.conv_id), '') AS missing FROM d JOIN head USING (conv_id)"""


@_query(_form_sql)
def form_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document has of the elements of its form, and what it lacks."""
    found = blocks.form_elements(block_documents(spark, sf_dir))
    return found.select("conv_id", "document_form", "has_header", "has_approval", "has_attachment", F.array_join("missing", " / ").alias("missing"))


# ---------------------------------------------------------------------------------------------- bands


@_query(
    lambda d: """WITH s AS (SELECT row_number() OVER () AS rid, l_orderkey // 8 AS page, l_orderkey * 10 + l_linenumber AS pos, (l_partkey % 40) * 1.7 AS y, (l_suppkey % 25)::DOUBLE AS x, CASE WHEN l_linenumber = 7 THEN '  ' ELSE concat(l_returnflag, l_linestatus, l_linenumber) END AS t FROM {lineitem}),
p AS (SELECT page, list_reduce(list([y] ORDER BY pos, x, y, t), lambda acc, e: CASE WHEN len(list_filter(acc, lambda top: abs(top - e[1]) < 3)) > 0 THEN acc ELSE list_append(acc, e[1]) END) AS tops FROM s WHERE trim(t) <> '' GROUP BY page),
o AS (SELECT page, unnest(tops) AS top, unnest(range(len(tops))) AS i FROM p),
b AS (SELECT page, i, row_number() OVER (PARTITION BY page ORDER BY top, i) AS line, top FROM o),
m AS (SELECT s.rid, s.page, s.pos, s.x, s.t, min(b.i) AS i FROM s JOIN b ON b.page = s.page AND abs(b.top - s.y) < 3 WHERE trim(s.t) <> '' GROUP BY ALL)
SELECT m.page, b.line, count(*) AS spans, string_agg(t, ' ' ORDER BY x, pos, t) AS text FROM m JOIN b ON b.page = m.page AND b.i = m.i GROUP BY m.page, b.line"""
)
def band_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of pages as lines by bands of height."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.floor(F.col("l_orderkey") / 8).alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), ((F.col("l_partkey") % 40) * F.lit(1.7)).alias("y"),
        (F.col("l_suppkey") % 25).alias("x"), F.when(F.col("l_linenumber") == 7, "  ").otherwise(F.concat("l_returnflag", "l_linestatus", "l_linenumber")).alias("text"),
    )
    return bands.band_lines(rows, ["page"])


# ---------------------------------------------------------------------------------------------- queue


@_query(
    lambda d: """WITH e AS (SELECT event_id, event_type AS source, concat('http://files/', user_id % 50) AS url, user_id % 50 AS n FROM {events} WHERE user_id % 11 <> 0)
SELECT concat_ws('::', source, url) AS dedup_key, source, min(event_id) AS arrival, min(n) % 3 = 0 OR source = 'error' AS waiting,
CASE WHEN min(n) % 3 <> 0 AND source <> 'error' THEN concat('files/', substr(sha256(concat_ws('::', source, url)), 1, 12)) END AS path FROM e GROUP BY source, url"""
)
def two_pass_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that was to be fetched, when it was first found, whether it still waits, and its path.

    The first pass enqueues what a stream of events names. The second fetches, source by source but
    for one; every third fetch fails and stays in the queue.
    """
    base = f"{run_folder(spark)}/queue-{uuid.uuid4().hex}"
    queue = PendingQueue(spark, f"{base}/queue")
    found = ingest.event_stream(spark, sf_dir).select(
        F.col("event_type").alias("source"), F.when(F.col("user_id") % 11 != 0, F.concat(F.lit("http://files/"), F.col("user_id") % 50)).alias("source_url"), F.col("event_id").alias("arrival")
    )
    collect(found, queue, f"{base}/checkpoint").awaitTermination()
    every = queue.pending()

    def fetch(rows: DataFrame) -> DataFrame:
        number = F.regexp_extract("source_url", r"(\d+)$", 1).cast("int")
        wanted = rows.where("source <> 'error'")
        return wanted.select("dedup_key", F.when(number % 3 != 0, F.concat(F.lit("files/"), F.substring(F.sha2("dedup_key", 256), 1, 12))).alias("path"))

    got = backfill(queue, fetch, "files-1").where("path IS NOT NULL")
    waiting = queue.pending().select("dedup_key", F.lit(True).alias("waits"))
    joined = every.join(waiting, "dedup_key", "left").join(got, "dedup_key", "left")
    return joined.select("dedup_key", "source", "arrival", F.coalesce("waits", F.lit(False)).alias("waiting"), "path")


# --------------------------------------------------------------------------------------------- digests


@_query(
    lambda d: """SELECT event_id, sha256(concat('{"normalization_version":"canonical-json-v1","value":{"at":', to_json(CAST(ts AS DATE)::VARCHAR), ',"fields":{"k":', to_json(event_type), ',"none":null},"parts":[', to_json(props), ',', to_json(concat('a"b', chr(92), chr(10), event_type)), '],"user":', user_id,
',"value":', regexp_replace(round(value, 2)::DECIMAL(18, 6)::VARCHAR, '(\\.\\d+?)0+$', '\\1'), '}}')) AS digest FROM {events}"""
)
def canonical_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-addressed ids of events: SHA-256 of canonical JSON of nested values."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hostile = F.concat(F.lit('a"b\\\n'), "event_type")
    value = F.struct(
        F.col("user_id").alias("user"), F.round("value", 2).alias("value"), F.array("props", hostile).alias("parts"),
        F.struct(F.col("event_type").alias("k"), F.lit(None).cast("string").alias("none")).alias("fields"), F.to_date("ts").cast("string").alias("at"),
    )
    rows = events.select("event_id", value.alias("v"))
    return rows.select("event_id", J.canonical_digest(F.col("v"), rows.schema["v"].dataType).alias("digest"))


_IDENTITY = """concat('{"candidate_kind":"line","extraction_id":"ext-', doc, '","line_ids":["p', doc % 7, '-', line_key, '"],"qualifier":', to_json(concat('"', substr(text, 1, 9), chr(92))), ',"source_path":', to_json(concat('data/', doc, '/한글.hwp')), '}')"""


@_query(lambda d: f"SELECT line_key, sha256({_IDENTITY}) AS candidate_id, sha256(text) AS text_sha256 FROM {korean_lines(d)} l")
def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-addressed ids of lines: SHA-256 of an object with sorted keys, its strings as they are."""
    lines = _view(korean_lines)(spark, sf_dir)
    identity = F.struct(
        F.lit("line").alias("candidate_kind"), F.concat(F.lit("ext-"), "doc").alias("extraction_id"), F.array(F.concat(F.lit("p"), F.col("doc") % 7, F.lit("-"), "line_key")).alias("line_ids"),
        F.concat(F.lit('"'), F.substring("text", 1, 9), F.lit("\\")).alias("qualifier"), F.concat(F.lit("data/"), "doc", F.lit("/한글.hwp")).alias("source_path"),
    )
    rows = lines.select("line_key", "text", identity.alias("v"))
    return rows.select("line_key", F.sha2(J.canonical_json(F.col("v"), rows.schema["v"].dataType, normal=False), 256).alias("candidate_id"), F.sha2("text", 256).alias("text_sha256"))


ORACLE = {name: check_sql(sql) for name, sql in _SQL.items()}
