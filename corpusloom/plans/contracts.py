"""Contracts between stages over the test tables: renderings, coordinates, routes, lineage, presence, phrases.

The SQL that checks them is written apart, from the rules.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts, writeback
from ..sources.dims import leaf_rows
from ..sources.views import registry
from .dialect import Spark, check_sql, spark_query, text, values

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


# ----------------------------------------------------------------------------------------- renderings


def _records(d: Spark) -> str:
    return f"(SELECT id AS record_id, source, body_file_path AS source_path, {_nth('id % 3', ('5', '7', None))} AS clause_no, {_nth('id % 3', ('audit_inspection', 'unit_cost', None))} AS subclause_key FROM {registry(d)} r)"


def _renders(d: Spark) -> str:
    """Renderings of most documents, some of them twice, some of nothing that is known."""
    name = "concat(CAST(id AS STRING), '_file')"
    pdf = f"CASE WHEN id % 13 = 0 THEN NULL WHEN id % 11 = 0 THEN concat('/elsewhere/', {name}, '.pdf') ELSE concat('/out/', source, '/', {name}, '.pdf') END"
    status = _nth("id % 5", ("ok", "ok_truncated", "failed", "ok", None))
    first = f"SELECT id * 2 AS nth, {name} AS document_id, {status} AS status, {pdf} AS pdf FROM {registry(d)} r WHERE id % 7 <> 0"
    again = f"SELECT id * 2 + 1, {name}, 'ok', concat('/out/again/', {name}, '.pdf') FROM {registry(d)} r WHERE id % 10 = 2"
    return f"({first} UNION ALL {again} UNION ALL SELECT id * 2, concat('stray-', CAST(id AS STRING)), 'ok', '/out/x.pdf' FROM {registry(d)} r WHERE id % 50 = 0)"


def _stored(d: Spark) -> str:
    leaf = f"{_nth('id % 3', ('5-audit_inspection', '7-unit_cost', 'none-none'))}"
    return f"(SELECT concat('gen_', source) AS source, concat('synthetic://source-generation/', CAST(id AS STRING), '_file/', {leaf}) AS source_url FROM {registry(d)} r WHERE id % 17 <> 0)"


@_query(
    lambda d: f"""WITH l AS (SELECT document_id, arg_max({{'s': status, 'p': pdf}}, nth) AS x FROM {_renders(d)} v GROUP BY document_id),
m AS (SELECT r.record_id, coalesce(CASE WHEN r.record_id IS NOT NULL THEN concat(r.record_id, '_file') END, l.document_id) AS document_id, CASE WHEN l.document_id IS NULL THEN 'missing' ELSE coalesce(l.x.s, '') END AS status, l.x.p AS pdf
  FROM {_records(d)} r FULL JOIN l ON l.document_id = concat(r.record_id, '_file')),
o AS (SELECT *, CASE WHEN record_id IS NULL THEN 'unclaimed' WHEN status NOT IN ('ok', 'ok_truncated') OR pdf IS NULL THEN 'gated' WHEN NOT starts_with(pdf, '/out/') THEN 'outside' WHEN record_id % 17 = 0 THEN 'no row' ELSE 'filled' END AS outcome FROM m)
SELECT record_id, document_id, outcome, status, CASE WHEN outcome = 'filled' THEN substr(pdf, 6) END AS body_file_path FROM o"""
)
def render_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the rendering of each record goes, or why it goes nowhere."""
    return writeback.match_renders(_view(_records)(spark, sf_dir), _view(_renders)(spark, sf_dir), _view(_stored)(spark, sf_dir), "/out")


@_query(
    lambda d: """SELECT outcome, CASE WHEN outcome = 'gated' THEN status ELSE '' END AS status, count(*) AS n FROM ("""
    + _SQL["render_matches"](d)
    + """) x GROUP BY 1, 2"""
)
def render_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account of a run that fills in renderings."""
    return writeback.outcomes(render_matches(spark, sf_dir))


# ---------------------------------------------------------------------------------------- coordinates

#: Templates and the number of values of each of their axes, which differ.
_TEMPLATES = (("security_defense/국방부", (7, 5, 4, 3)), ("legal_secret/법무부", (11, 2)), ("property", (1, 6, 13, 1, 5)))
_VERSION, _CONTRACT = "v7", "2.3.0"


def _frames(d: Spark) -> str:
    """Records of generated documents as JSON text: two shapes, old versions, and all that can be wrong with them."""
    template = _nth("id % 5", (*(t for t, _ in _TEMPLATES), "no/such", _TEMPLATES[0][0]))
    version = _nth("id % 7", ("v7", "v7", "", "v6", "v5", "v7", "v7"))
    index = "CASE WHEN id % 19 = 0 THEN '\"many\"' WHEN id % 23 = 0 THEN '-1' WHEN id % 2 = 0 THEN concat('\"', CAST(id % 450 AS STRING), '\"') ELSE CAST(id % 450 AS STRING) END"
    contract = _nth("id % 4", ("2.3.0", "2.2.0", "", "2.3.0"))
    doc = f"concat('{{\"title\":\"x\",\"contract_version\":\"', {contract}, '\"}}')"
    body = f"CASE WHEN id % 29 = 0 THEN '\"document\":[]' WHEN id % 3 = 0 THEN concat('\"response\":{{\"document\":', {doc}, '}}') ELSE concat('\"document\":', {doc}) END"
    whole = f"concat('{{\"template\":\"', {template}, '\",\"template_version\":\"', {version}, '\",\"seed\":', CAST(id % 6 AS STRING), ',\"case_index\":', {index}, ',', {body}, CASE WHEN id % 31 = 0 THEN '' ELSE '}}' END)"
    return f"(SELECT id, {whole} AS record FROM {registry(d)} r)".replace("{{", "{").replace("}}", "}")


def _frame_sql(d: Spark) -> str:
    sizes = {t: radices for t, radices in _TEMPLATES}
    count = "CASE template " + " ".join(f"WHEN {text(t)} THEN {math.prod(r)}" for t, r in sizes.items()) + " END"

    def digits(radices: tuple[int, ...]) -> str:
        parts = []
        for i in range(len(radices)):
            below = 1
            for r in radices[i + 1 :]:
                below *= r
            parts.append(f"(n // {below}) % {radices[i]}")
        return "[" + ", ".join(parts) + "]"

    decoded = "CASE template " + " ".join(f"WHEN {text(t)} THEN {digits(r)}" for t, r in sizes.items()) + " END"
    return f"""WITH j AS (SELECT id, CASE WHEN json_valid(record) THEN record::JSON END AS j FROM {_frames(d)} v),
r AS (SELECT id, j, json_extract_string(j, '$.template') AS template, json_extract_string(j, '$.template_version') AS version, json_extract_string(j, '$.seed')::BIGINT AS seed, try_cast(json_extract_string(j, '$.case_index') AS BIGINT) AS n,
  CASE WHEN json_type(j, '$.response') IS NOT NULL THEN json_extract(j, '$.response.document') ELSE json_extract(j, '$.document') END AS body FROM j),
f AS (SELECT *, {count} AS total FROM r),
e AS (SELECT *, CASE WHEN j IS NULL THEN 'malformed' WHEN total IS NULL THEN 'unknown template' WHEN version NOT IN ('', '{_VERSION}', 'v6') THEN 'old template version' WHEN n IS NULL THEN 'no number' WHEN n < 0 OR n >= total THEN 'out of range'
  WHEN json_type(body) <> 'OBJECT' THEN 'no document' END AS failure, {decoded} AS digits FROM f)
SELECT id, template, seed, n AS case_index, CASE WHEN failure IS NULL THEN array_to_string(digits, ',') END AS digits,
CASE WHEN failure IS NULL THEN array_to_string(list_transform(list_zip(range(len(digits)), digits), lambda x: concat(x[1], '.', x[2])), ' ') END AS picked,
CASE WHEN failure IS NULL THEN concat('c-track/', split_part(template, '/', 1), '/', substr(template, length(split_part(template, '/', 1)) + 2), '/seed', seed, '-case', n) END AS document_id,
CASE WHEN failure IS NULL AND json_extract_string(body, '$.contract_version') NOT IN ('', '{_CONTRACT}') THEN json_extract_string(body, '$.contract_version') END AS older_contract, failure FROM e"""


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    axes = [(t, [[f"{i}.{v}" for v in range(n)] for i, n in enumerate(radices)]) for t, radices in _TEMPLATES]
    templates = spark.createDataFrame(axes, "template string, axes array<array<string>>")
    return writeback.rebuild_frames(_view(_frames)(spark, sf_dir), templates, _VERSION, _CONTRACT, ("v6",)).drop("record")


@_query(_frame_sql)
def rebuilt_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames made again from their coordinates, with the ids of their documents, or why they can't be."""
    found = _rebuilt(spark, sf_dir)
    return found.withColumn("digits", F.array_join("digits", ",")).withColumn("picked", F.array_join("picked", " "))


@_query(lambda d: f"SELECT coalesce(failure, 'written') AS outcome, coalesce(older_contract, '') AS older_contract, count(*) AS n FROM ({_frame_sql(d)}) x GROUP BY 1, 2")
def writeback_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account of a write-back: failures by reason, and documents of older contracts."""
    return _rebuilt(spark, sf_dir).groupBy(F.coalesce("failure", F.lit("written")).alias("outcome"), F.coalesce("older_contract", F.lit("")).alias("older_contract")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------------- routes

_ROUTES = (*contracts.ROUTE_EVIDENCE, "unheard_of")


def _plans(d: Spark) -> str:
    at = lambda n, m: f"{d.whole('id', str(n))} % {m}"
    return f"""(SELECT id, {_nth('id % 7', _ROUTES)} AS route, {_nth(at(3, 4), ('C', 'S', 'O', 'O'))} AS source_class, {_nth(at(2, 4), contracts.EVIDENCE)} AS evidence, {_nth(at(5, 3), ('source_aligned', 'counterfactual', 'counterfactual'))} AS mode,
{_nth(at(7, 2), ('5', None))} AS source_clause, {_nth(at(7, 2), ('audit_inspection', None))} AS source_subclause, {_nth(at(3, 4), ('C', 'S', 'S', 'C'))} AS target_class, {_nth(at(11, 3), ('5', None, '6'))} AS target_clause,
{_nth(at(11, 3), ('audit_inspection', None, 'audit_inspection'))} AS target_subclause, {at(13, 3)} AS n_statuses FROM {registry(d)} r)"""


@_query(
    lambda d: f"""SELECT id, CASE WHEN route = 'unheard_of' THEN 'unknown route: unheard_of'
WHEN route = 'source_aligned' AND source_class = 'O' THEN 'source_aligned route requires a C/S source' WHEN route = 'source_aligned' AND evidence <> 'direct_legal_evidence' THEN 'source_aligned route requires direct_legal_evidence'
WHEN route <> 'source_aligned' AND source_class <> 'O' THEN concat(route, ' route requires an O source')
WHEN route = 'mask_restoration' AND target_clause IS NULL THEN 'mask_restoration route requires a legal clause target'
WHEN route = 'span_seeded' AND evidence <> 'direct_sensitive_span' THEN 'span_seeded route requires direct_sensitive_span'
WHEN route IN ('anchored', 'administrative_augmented') AND evidence <> 'contextual_anchor_only' THEN concat(route, ' route requires contextual_anchor_only')
WHEN route = 'administrative_augmented' AND (target_clause IS NOT NULL OR n_statuses = 0) THEN 'administrative_augmented route requires an admin-only target'
WHEN route = 'fully_synthetic' AND evidence <> 'no_usable_public_source' THEN 'fully_synthetic route requires no_usable_public_source'
WHEN route = 'fully_synthetic' AND target_clause IS NULL THEN 'admin-only target requires administrative_augmented route'
WHEN source_class = 'O' THEN CASE WHEN mode <> 'counterfactual' THEN 'O source requires generation_mode=counterfactual' END
WHEN mode <> 'source_aligned' THEN 'C/S source requires generation_mode=source_aligned'
WHEN target_class <> source_class OR target_clause IS DISTINCT FROM source_clause OR target_subclause IS DISTINCT FROM source_subclause THEN 'source_aligned target must exactly match the C/S source label' END AS error FROM {_plans(d)} p"""
)
def route_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the route of each plan forbids."""
    plans = _view(_plans)(spark, sf_dir).withColumn("statuses", F.when(F.col("n_statuses") == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("초안"))))
    return contracts.route_errors(plans).select("id", "error")


# ------------------------------------------------------------------------------------------- coherence


def _assessed(d: Spark) -> str:
    at = lambda n, m: f"{d.whole('id', str(n))} % {m}"
    return f"(SELECT id, {_nth('id % 5', ('S', 'O', 'S', 'C', 'S'))} AS classification, {at(2, 4)} AS r, {at(3, 5)} AS s, {_nth(at(4, 4), ('unit_cost', 'audit_inspection', 'life_body', 'cornering'))} AS main, {at(7, 6)} AS c FROM {registry(d)} r)"


_CLAUSE_OF = {sub: clause for _, clause, sub, _ in leaf_rows()}


@_query(
    lambda d: f"""SELECT id, CASE WHEN classification = 'C' THEN 'source assessment supports only S/O for clauses 5-8' WHEN r = 3 THEN 'source subject roles must be unique' WHEN s = 4 THEN 'source slots must be unique by name and kind'
WHEN (main = 'unit_cost' AND c IN (1, 4)) OR (main = 'cornering' AND c = 2) THEN 'primary subclause must not repeat in compatible subclauses' WHEN c = 3 THEN 'compatible subclauses must be unique'
WHEN main = 'life_body' OR c = 5 THEN 'source assessment only supports subclauses in clauses 5-8' END AS error FROM {_assessed(d)} x"""
)
def assessment_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What contradicts itself in an assessment of a source."""
    nth = lambda choices, x: F.get(F.array(*(F.array(*map(F.lit, c)) if c else F.array().cast("array<string>") for c in choices)), x.cast("int"))
    slot = lambda a, b: F.struct(F.lit(a).alias("name"), F.lit(b).alias("kind"))
    slots = F.get(F.array(F.array(slot("a", "x")), F.array(slot("a", "x"), slot("a", "y")), F.array(slot("b", "x")), F.array(slot("b", "x"), slot("a", "x")), F.array(slot("a", "x"), slot("a", "x"))), F.col("s").cast("int"))
    rows = _view(_assessed)(spark, sf_dir).select(
        "id", "classification", nth((("a",), ("a", "b"), ("c",), ("a", "a")), F.col("r")).alias("roles"), slots.alias("slots"), F.col("main").alias("primary"),
        nth(((), ("unit_cost",), ("cornering",), ("bid_contract", "bid_contract"), ("bid_contract", "unit_cost"), ("trial_investigation",)), F.col("c")).alias("compatible"),
    )
    return contracts.assessment_errors(rows, _CLAUSE_OF).select("id", "error")


@_query(
    lambda d: f"""SELECT id, CASE WHEN route = 'fully_synthetic' THEN CASE WHEN uses OR spans > 0 THEN 'fully_synthetic provenance cannot use source evidence' WHEN scenario IS NULL THEN 'fully_synthetic provenance requires synthetic_scenario_id' WHEN seed IS NOT NULL THEN 'sensitive seed hash is only allowed for anchored provenance' END
WHEN NOT uses OR spans = 0 THEN concat(route, ' provenance requires source evidence') WHEN scenario IS NOT NULL THEN 'synthetic_scenario_id is only allowed for fully_synthetic provenance'
WHEN route = 'anchored' AND seed IS NULL THEN 'anchored provenance requires a sensitive seed hash' WHEN route <> 'anchored' AND seed IS NOT NULL THEN 'sensitive seed hash is only allowed for anchored provenance' END AS error
FROM (SELECT id, {_nth('id % 6', tuple(contracts.ROUTE_EVIDENCE))} AS route, (id // 6) % 3 > 0 AS uses, (id // 7) % 3 AS spans, {_nth('(id // 11) % 3', ('s', None, None))} AS scenario, {_nth('(id // 13) % 2', ('h', None))} AS seed FROM {registry(d)} r) x"""
)
def provenance_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a provenance that its route demands or forbids."""
    at = lambda n, m: f"(id div {n}) % {m}"
    rows = _view(registry)(spark, sf_dir).selectExpr("id", f"{_nth('id % 6', tuple(contracts.ROUTE_EVIDENCE))} AS route", f"{at(6, 3)} > 0 AS uses_source", f"{at(7, 3)} AS spans", f"{_nth(at(11, 3), ('s', None, None))} AS scenario_id", f"{_nth(at(13, 2), ('h', None))} AS seed_sha256")
    return contracts.provenance_errors(rows).select("id", "error")


_PARTS = (*contracts.COMPLETE[:4], "classification_receipt", "generation_receipt", "validation_receipt", "comparison", "failure")


def _presence_sql(d: Spark) -> str:
    # a part is there unless one of nine bits of a hash says otherwise; most rows are whole
    bits = ", ".join(f"(h >> {i}) & 1 = 1 AS p{i}" for i in range(9))
    has = {part: f"p{i}" for i, part in enumerate(_PARTS)}
    a, g, r, c = (has[p] for p in _PARTS[:4])
    cr, gr, vr, cmp, fail = (has[p] for p in _PARTS[4:])
    return f"""SELECT id, CASE WHEN {g} AND NOT {a} THEN 'generation plan requires source assessment' WHEN {r} AND NOT {g} THEN 'generation artifact requires generation plan' WHEN {c} AND NOT {r} THEN 'consistency assessment requires a generation artifact'
WHEN {cr} AND NOT {a} THEN 'classification receipt requires source assessment' WHEN {gr} AND NOT {r} THEN 'generation receipt requires generation artifact' WHEN {vr} AND NOT {c} THEN 'validation receipt requires consistency assessment'
WHEN {cmp} AND (NOT {g} OR NOT {c} OR {fail}) THEN 'comparison requires a successful consistency validation'
WHEN NOT {fail} AND NOT ({a} AND {g} AND {r} AND {c} AND {cr} AND {vr} AND {cmp}) THEN 'successful pipeline result requires classification, generation, validation, and comparison'
WHEN NOT {fail} AND id % 3 > 0 AND NOT {gr} THEN 'source-referenced generation requires a generation receipt' END AS error
FROM (SELECT id, {bits} FROM (SELECT id, CASE WHEN id % 4 = 0 THEN CAST(concat('0x', substr(sha256(CAST(id AS VARCHAR)), 1, 4)) AS BIGINT) WHEN id % 4 = 1 THEN 255 WHEN id % 4 = 2 THEN 223 ELSE 256 + (1 << (id % 9)) - 1 END AS h FROM {registry(d)} r) x) y"""


@_query(_presence_sql)
def presence_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that have a part without what it rests on, or succeeded without being whole."""
    h = F.when(F.col("id") % 4 == 0, F.conv(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 4), 16, 10).cast("long")).when(F.col("id") % 4 == 1, 255).when(F.col("id") % 4 == 2, 223).otherwise(F.expr("256 + shiftleft(1L, CAST(id % 9 AS INT)) - 1"))
    rows = _view(registry)(spark, sf_dir).select("id", h.alias("h"))
    part = lambda i: F.when(F.expr(f"(shiftright(h, {i}) & 1) = 1"), F.lit("{}"))
    rows = rows.select("id", F.when(F.col("id") % 3 == 0, "fully_synthetic").otherwise("anchored").alias("route"), F.struct(*(part(i).alias(p) for i, p in enumerate(_PARTS))).alias("result"))
    return contracts.presence_errors(rows).select("id", "error")


def _attempts(d: Spark) -> str:
    """Attempts of plans, a customer's orders in their order; some links lead nowhere, too far back, to another plan, or round in a circle."""
    sha = lambda x: f"('a' || CAST({x} AS STRING))"
    ordered = "SELECT o_orderkey AS id, o_custkey AS plan, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS back, lag(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS far, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next FROM {orders}"
    parent = f"CASE WHEN id % 97 = 0 THEN 'nowhere' WHEN id % 89 = 0 THEN {sha('far')} WHEN id % 83 = 0 THEN {sha('id + 1')} WHEN id % 79 = 0 THEN {sha('next')} WHEN n > 1 THEN {sha('back')} END"
    return f"(SELECT id, {sha('CASE WHEN id % 101 = 0 THEN id + 1 ELSE id END')} AS sha256, concat('p', CAST(plan AS STRING)) AS plan_sha256, CASE WHEN id % 73 = 0 THEN 0 ELSE n END AS attempt_index, {parent} AS parent_sha256, CASE WHEN n = 1 AND id % 71 > 0 THEN 0 WHEN id % 67 = 0 THEN 2 ELSE 1 END AS codes FROM ({ordered}) x)"


@_query(
    lambda d: f"""WITH RECURSIVE a AS (SELECT * FROM {_attempts(d)} v),
k AS (SELECT sha256, count(*) AS n, min(attempt_index) AS i, min(plan_sha256) AS p FROM a GROUP BY sha256),
l AS (SELECT a.*, CASE WHEN codes = 2 THEN 'generation repair codes must be unique' WHEN attempt_index < 1 THEN 'attempts count from 1' WHEN attempt_index = 1 AND (parent_sha256 IS NOT NULL OR codes > 0) THEN 'first generation attempt cannot have a parent or repair codes'
  WHEN attempt_index > 1 AND (parent_sha256 IS NULL OR codes = 0) THEN 'retry generation attempts require a parent hash and repair codes' WHEN o.n > 1 THEN 'hash of several attempts' WHEN attempt_index > 1 AND u.n IS NULL THEN 'unknown parent'
  WHEN attempt_index > 1 AND u.p <> plan_sha256 THEN 'parent of another plan' WHEN attempt_index > 1 AND u.i <> attempt_index - 1 THEN 'parent is not the attempt before' END AS own FROM a LEFT JOIN k o ON o.sha256 = a.sha256 LEFT JOIN k u ON u.sha256 = a.parent_sha256),
b AS (SELECT DISTINCT sha256 FROM l WHERE own IS NOT NULL UNION SELECT l.sha256 FROM l JOIN b ON l.parent_sha256 = b.sha256)
SELECT id, coalesce(own, CASE WHEN sha256 IN (SELECT sha256 FROM b) THEN 'broken chain' END) AS error FROM l"""
)
def attempt_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts that don't go back to the first one of their plan."""
    rows = _view(_attempts)(spark, sf_dir)
    codes = F.when(F.col("codes") == 0, F.array().cast("array<string>")).when(F.col("codes") == 2, F.array(F.lit("x"), F.lit("x"))).otherwise(F.array(F.lit("x"), F.lit("y")))
    return contracts.attempt_errors(rows.withColumn("repair_codes", codes)).select("id", "error")


# -------------------------------------------------------------------------------------------- phrases

_PHRASES = (("T1", ("공고", "보고", "알림")), ("T2", ("계획", "승인")), ("결재진행중", ("회신", "공고")), ("초안", ("발령",)), ("타기관협의중", ("결과",)))
_VARIANTS = (("결재진행중", None), ("초안", None), ("타기관협의중", ("T2",)))
_OVERRIDES = (("결재진행중", "보고"), ("초안", "계획"), ("타기관협의중", "계획"))
_STATUS_AT = ("결재진행중", "초안", "타기관협의중", "unheard_of", None)


@_query(
    lambda d: f"""WITH r AS (SELECT id, {_nth('id % 3', ('T1', 'T2', 'T3'))} AS t, {_nth('id % 5', _STATUS_AT)} AS s, CASE WHEN id % 41 = 0 THEN '' ELSE title END AS body FROM {registry(d)} r),
p AS (SELECT * FROM {values([(o, i, p) for o, names in _PHRASES for i, p in enumerate(names)], 'owner, nth, phrase')} v),
u AS (SELECT *, s = '타기관협의중' AND t <> 'T2' AS misused, s IN ('결재진행중', '초안') OR (s = '타기관협의중' AND t = 'T2') AS used FROM r),
m AS (SELECT id, -1 AS a, 0 AS b, concat('[', t, '] ', s, ' applies to T2') AS said FROM u WHERE misused
  UNION ALL SELECT id, 0, nth, concat('[', t, '/', s, '] ', phrase) FROM u JOIN p ON p.owner = u.s WHERE used AND contains(body, phrase)
  UNION ALL SELECT id, 1, nth, concat('[', t, '] ', phrase) FROM u JOIN p ON p.owner = u.t WHERE contains(body, phrase) AND NOT (coalesce(used, false) AND EXISTS (SELECT 1 FROM {values(list(_OVERRIDES), 'status, phrase')} o WHERE o.status = u.s AND o.phrase = p.phrase)))
SELECT r.id, coalesce((SELECT string_agg(said, '; ' ORDER BY a, b) FROM m WHERE m.id = r.id), '') AS violations FROM r"""
)
def phrase_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each text says though its template or its status forbids it."""
    rows = _view(registry)(spark, sf_dir).selectExpr("id", f"{_nth('id % 3', ('T1', 'T2', 'T3'))} AS template_id", f"{_nth('id % 5', _STATUS_AT)} AS document_status", "CASE WHEN id % 41 = 0 THEN NULL ELSE title END AS body_text")
    phrases = spark.createDataFrame([(o, i, p) for o, names in _PHRASES for i, p in enumerate(names)], "owner string, nth int, phrase string")
    variants = spark.createDataFrame([(s, list(a) if a else None) for s, a in _VARIANTS], "status string, applies_to array<string>")
    overrides = spark.createDataFrame(list(_OVERRIDES), "status string, phrase string")
    return contracts.phrase_violations(rows, phrases, variants, overrides).select("id", F.array_join("violations", "; ").alias("violations"))


ORACLE = {name: check_sql(sql) for name, sql in _SQL.items()}
