"""Candidate passages: rule evidence, scores, ranks, and deterministic choices."""

from __future__ import annotations

from ..operators import evidence as E
from ..sources.dims import CLAUSE_WORDS, MONEY, NOT_COUNTED, OFFICIAL_TITLE, PERSON_LABEL, STATUS_RULES
from ..sources.views import korean_lines, registry
from .dialect import Spark, any_in, check_sql, spark_query, text, values

PLANS = {}
#: Fixed value: so many candidates of a document and clause, and so many hints of a document, are kept.
MAX_CANDIDATES_PER_DOC = 60


def plan(f):
    PLANS[f.__name__] = f
    return f


def _hit(word: str, clause: str, x: str = "text") -> str:
    for phrase in sorted(NOT_COUNTED.get((clause, word), ()), key=len, reverse=True):
        x = f"replace({x}, {text(phrase)}, '')"
    return f"contains({x}, {text(word)})"


def _counted(clause: str) -> list[tuple[str, str]]:
    """(word, condition): a word counts unless a longer word of the clause that holds it is hit as well."""
    words = CLAUSE_WORDS[clause]
    out = []
    for w in words:
        longer = [_hit(o, clause) for o in words if o != w and w in o]
        out.append((w, _hit(w, clause) + "".join(f" AND NOT {x}" for x in longer)))
    return out


def evidence_sql(d: Spark, clause: str) -> str:
    """(line_key, doc, clause, words, money, score) of the lines of one clause."""
    counted = _counted(clause)
    score = " + ".join(f"CASE WHEN {c} THEN {min(4, 2 + len(w) // 4)} ELSE 0 END" for w, c in counted)
    names = f"concat_ws(',', {', '.join(f'CASE WHEN {c} THEN {text(w)} END' for w, c in counted)})"
    money = d.matches("text", MONEY) if clause in ("5", "7") else "false"
    return f"SELECT line_key, doc, {text(clause)} AS clause, {names} AS words, {money} AS money, {score} + CASE WHEN {money} THEN 1 ELSE 0 END AS score FROM l"


def _lines(d: Spark) -> str:
    return f"WITH l AS (SELECT * FROM {korean_lines(d)} k)"


def _all(d: Spark) -> str:
    return " UNION ALL ".join(evidence_sql(d, c) for c in CLAUSE_WORDS)


@plan
def keyword_evidence(d: Spark) -> str:
    """The SQL that checks :func:`corpusloom.operators.evidence.keyword_evidence`."""
    return f"{_lines(d)} SELECT line_key, clause, words, money, score FROM ({_all(d)}) e WHERE words <> '' OR money"


@plan
def personal_labels(d: Spark) -> str:
    """Short lines with a label of personal data and no official's title."""
    return f"{_lines(d)}, c AS (SELECT line_key, text AS said FROM l) SELECT line_key, {d.matches('said', PERSON_LABEL)} AND length(said) <= 40 AND NOT {d.matches('said', OFFICIAL_TITLE)} AS personal, 5 AS score FROM c WHERE {d.matches('said', PERSON_LABEL)}"


@plan
def ranked_candidates(d: Spark) -> str:
    """Per document and clause the best sixty lines by score, then by place, plus at most two points of context; money alone needs a word nearby."""
    near = "rows BETWEEN 2 PRECEDING AND 2 FOLLOWING"
    return f"""{_lines(d)}, e AS ({_all(d)}), c AS (SELECT *, sum(score) OVER (PARTITION BY doc, clause ORDER BY line_key {near}) - score AS around, sum(CASE WHEN words <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc, clause ORDER BY line_key {near}) AS spoken FROM e),
s AS (SELECT doc, clause, line_key, score + least(2, around) AS match_score FROM c WHERE words <> '' OR (money AND spoken > 0))
SELECT doc, clause, line_key, CAST(match_score AS BIGINT) AS match_score, place FROM (SELECT *, row_number() OVER (PARTITION BY doc, clause ORDER BY match_score DESC, line_key) AS place FROM s) r WHERE place <= {MAX_CANDIDATES_PER_DOC}"""


def _doc_type() -> str:
    return f"CASE doc % {len(STATUS_RULES)} " + " ".join(f"WHEN {i} THEN {text(k)}" for i, k in enumerate(STATUS_RULES)) + " END"


@plan
def status_candidates(d: Spark) -> str:
    """Hints at administrative statuses by document type, each line and status once, the first sixty of a document."""
    rules = " UNION ALL ".join(f"SELECT line_key, doc, {text(status)} AS status, {i} AS nth FROM t WHERE doc_type = {text(kind)} AND {any_in('text', words)}" for kind in STATUS_RULES for i, (status, words) in enumerate(STATUS_RULES[kind]))
    return f"{_lines(d)}, t AS (SELECT *, {_doc_type()} AS doc_type FROM l) SELECT doc, line_key, status FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY line_key, nth) AS place FROM ({rules}) u) r WHERE place <= {MAX_CANDIDATES_PER_DOC}"


@plan
def cell_measures(d: Spark) -> str:
    """Per document type and status: whether there is a rule, and how many lines and documents it finds."""
    rows = values([(k, s) for k, rules in STATUS_RULES.items() for s, _ in rules], "doc_type, status")
    found = status_candidates(d).replace("SELECT doc, line_key, status FROM", "SELECT doc_type, doc, line_key, status FROM", 1).replace("SELECT line_key, doc,", "SELECT doc_type, line_key, doc,")
    return f"SELECT r.doc_type, r.status, count(f.line_key) AS spans, count(DISTINCT f.doc) AS documents, CASE WHEN count(f.line_key) = 0 THEN 'zero_matches' ELSE 'counted' END AS state FROM {rows} r LEFT JOIN ({found}) f ON r.doc_type = f.doc_type AND r.status = f.status GROUP BY r.doc_type, r.status"


@plan
def line_revalidation(d: Spark) -> str:
    """Candidates are joined again with the current lines; a changed text is rejected."""
    return f"{_lines(d)}, now AS (SELECT line_key, CASE WHEN line_key % 17 = 0 THEN concat(text, '!') ELSE text END AS text FROM l WHERE line_key % 23 <> 0) SELECT l.line_key, CASE WHEN n.line_key IS NULL THEN 'gone' WHEN {d.sha('l.text')} <> {d.sha('n.text')} THEN 'changed' ELSE 'ok' END AS state FROM l LEFT JOIN now n ON l.line_key = n.line_key"


@plan
def provenance_report(d: Spark) -> str:
    """What a row stems from, in words, by the kind of its seed."""
    return f"SELECT id, concat_ws(' / ', CASE id % 3 WHEN 0 THEN 'seeded by a passage' WHEN 1 THEN 'seeded by a status' ELSE 'fallback without a seed' END, concat('source: ', source), concat('agency: ', ordering_agency), CASE WHEN source_url IS NOT NULL THEN concat('url: ', source_url) END) AS explanation FROM {registry(d)} r"


@plan
def withholding_reasons(d: Spark) -> str:
    """Per document and clause a reason of at most three quotes, of at most 120 characters, of the first lines with evidence."""
    q = d.joined("quote", "line_key", "; ")
    return f"{_lines(d)}, n AS (SELECT e.doc, e.clause, e.line_key, substr(l.text, 1, 120) AS quote, row_number() OVER (PARTITION BY e.doc, e.clause ORDER BY e.line_key) AS k FROM ({_all(d)}) e JOIN l ON e.line_key = l.line_key WHERE e.words <> '' OR e.money) SELECT doc, clause, concat('제', clause, '호: ', {q}) AS reason FROM n WHERE k <= 3 GROUP BY doc, clause"


@plan
def event_fields(d: Spark) -> str:
    """Nested fields of JSON, with a default where they are missing."""
    return f"SELECT event_id, coalesce({d.field('props', 'k')}, {d.field('props', 'page')}, 'none') AS first_field, length(props) AS chars FROM {{events}}"


# -------------------------------------------------------------------------- deterministic choices


@plan
def stable_seeds(d: Spark) -> str:
    """64-bit seeds of joined parts, as sixteen hexadecimal digits."""
    return f"SELECT id, substr({d.sha('concat_ws(chr(1), source, doc_type, CAST(id AS STRING))')}, 1, 16) AS seed FROM {registry(d)} r"


@plan
def ground_index(d: Spark) -> str:
    """A whole SHA-256 modulo the number of choices, folded from eight blocks of 32 bits."""
    h = "h"
    value = "0"
    for i in range(8):  # (value * 2**32 + block) % n, with n = 151
        value = f"(({value}) * {2**32 % 151} + {d.hex32(f'substr({h}, {1 + 8 * i}, 8)')}) % 151"
    return f"SELECT id, {value} AS chosen FROM (SELECT id, {d.sha('CAST(id AS STRING)')} AS h FROM {registry(d)} r) x"


@plan
def day_offsets(d: Spark) -> str:
    n = f"{d.hex32('substr(h, 1, 8)')} % 151 + 30"
    return f"SELECT id, {d.day('production_date', n)} AS release_date FROM (SELECT id, production_date, {d.sha('CAST(id AS STRING)')} AS h FROM {registry(d)} r) x"


@plan
def hash_fraction(d: Spark) -> str:
    """A row is chosen if the first 32 bits of its hash, as a fraction, are below the ratio."""
    return f"SELECT id, CAST({d.hex32('substr(h, 1, 8)')} AS DOUBLE) / 4294967295 < 0.2 AS chosen FROM (SELECT id, {d.sha('concat(source, CAST(id AS STRING))')} AS h FROM {registry(d)} r) x"


@plan
def cyclic_choice(d: Spark) -> str:
    return f"SELECT id, (7 + row_number() OVER (PARTITION BY doc_type ORDER BY id)) % 5 AS chosen FROM {registry(d)} r"


@plan
def balanced_templates(d: Spark) -> str:
    """Within a type rows go round all templates; each round has an order of its own; variations and scans in fixed shares."""
    n = "(row_number() OVER (PARTITION BY doc_type ORDER BY id) - 1)"
    slugs = values([(f"form-{i}",) for i in range(6)], "slug")
    return f"""WITH a AS (SELECT id, doc_type, {n} AS n FROM {registry(d)} r), e AS (SELECT DISTINCT doc_type, {d.whole('n', '6')} AS epoch FROM a),
p AS (SELECT doc_type, epoch, slug, row_number() OVER (PARTITION BY doc_type, epoch ORDER BY {d.sha("concat_ws('/', 'seed', doc_type, CAST(epoch AS STRING), slug)")}) - 1 AS place FROM e CROSS JOIN {slugs} s)
SELECT a.id, a.doc_type, p.slug, 1 + n % 3 AS variation, n % 2 = 0 AS scan, n % 8 = 0 AS handwriting FROM a JOIN p ON a.doc_type = p.doc_type AND {d.whole('a.n', '6')} = p.epoch AND a.n % 6 = p.place"""


@plan
def mixed_radix_frames(d: Spark) -> str:
    """Rows decoded into coordinates of 7 x 5 x 4 x 3 and taken per form in the order of their hashes."""
    return f"SELECT id, form, role, stage, tone FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY {d.sha('CAST(id AS STRING)')}) AS k FROM (SELECT id, id % 7 AS form, {d.whole('id', '7')} % 5 AS role, {d.whole('id', '35')} % 4 AS stage, {d.whole('id', '140')} % 3 AS tone FROM {registry(d)} r) x) y WHERE k <= 300"


@plan
def least_filled_forms(d: Spark) -> str:
    """A choice of rows over forms that fills the emptiest form first."""
    h = d.sha("CAST(id AS STRING)")
    return f"SELECT id, form FROM (SELECT id, form, h, row_number() OVER (PARTITION BY form ORDER BY h) AS k FROM (SELECT id, id % 7 AS form, {h} AS h FROM {registry(d)} r WHERE id % 7 <> 3 OR id % 5 = 0) x) y ORDER BY k, h LIMIT 500"


@plan
def diverse_agencies(d: Spark) -> str:
    """Agencies in turn, each with its rows in the order of their hashes."""
    h = d.sha("concat('s', CAST(id AS STRING))")
    return f"SELECT id, ordering_agency, k AS turn FROM (SELECT id, ordering_agency, row_number() OVER (PARTITION BY ordering_agency ORDER BY {h}) AS k FROM {registry(d)} r) x WHERE k <= 30"


@plan
def seeded_sample(d: Spark) -> str:
    """The first of equal texts, then a sample in the order of seeded hashes."""
    return f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS n FROM {{documents}}) x WHERE n = 1 ORDER BY {d.sha(chr(39) + 'seed-42:' + chr(39) + ' || CAST(doc_id AS STRING)')} LIMIT 100"


@plan
def adversary_pairs(d: Spark) -> str:
    """Pairs of turns of a conversation, the earlier first."""
    return "SELECT a.conv_id, a.turn AS turn_a, b.turn AS turn_b FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND a.turn < b.turn WHERE a.role <> b.role"


@plan
def stage_cases(d: Spark) -> str:
    """One row for each allowed stage of a case."""
    stages = d.array(("'draft'", "'review'", "'final'"))
    return f"SELECT id, item AS stage FROM ({d.each('id', 'stages', '(SELECT id, ' + stages + f' AS stages FROM {registry(d)} r)' + ' q')}) x"


# --------------------------------------------------------------------------------- names and keys


@plan
def file_names(d: Spark) -> str:
    """Titles as file names; repeated names get a number."""
    base = f"substr({d.replace_all(d.replace_all('title', '[ ]+', '_'), '[^가-힣A-Za-z0-9_]', '')}, 1, 120)"
    return f"SELECT id, CASE WHEN n = 1 THEN base ELSE concat(base, '_', CAST(n AS STRING)) END AS file_name FROM (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM (SELECT id, {base} AS base FROM {registry(d)} r) x) y"


@plan
def unique_document_ids(d: Spark) -> str:
    return f"SELECT id, CASE WHEN n = 1 THEN base ELSE concat(base, '-', lpad(CAST(n AS STRING), 4, '0')) END AS document_id FROM (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM (SELECT id, concat(source, '-', doc_type) AS base FROM {registry(d)} r) x) y"


@plan
def translated_codes(d: Spark) -> str:
    """Legacy values to codes; nothing Korean may be left over."""
    code = "replace(replace(replace(disclosure_text, '부분공개', 'partial'), '비공개', 'closed'), '공개', 'open')"
    return f"SELECT code, count(*) AS n, {d.matches('code', '[가-힣]')} AS left_over FROM (SELECT {code} AS code FROM {registry(d)} r) x GROUP BY code"


@plan
def run_status(d: Spark) -> str:
    """Any unexpected state makes an error; truncated goes before ok."""
    return f"SELECT source, CASE WHEN max(CASE WHEN disclosure_text = '미정' AND id % 50 = 0 THEN 1 ELSE 0 END) = 1 THEN 'error' WHEN max(CASE WHEN id % 40 = 0 THEN 1 ELSE 0 END) = 1 THEN 'truncated' ELSE 'ok' END AS status FROM {registry(d)} r GROUP BY source"


@plan
def label_review(d: Spark) -> str:
    """Rows whose five labels are not all the same, nulls being equal to each other, need a review."""
    same = " AND ".join(f"({a} IS NOT DISTINCT FROM {b})" for a, b in (("a", "b"), ("b", "c"), ("c", "e"), ("e", "f")))
    return f"SELECT doc_id, NOT ({same}) AS requires_review FROM (SELECT doc_id, quality AS a, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE quality END AS b, quality AS c, quality AS e, CASE WHEN toxic = 1 THEN 0 ELSE quality END AS f FROM {{labels}}) x"


@plan
def synthetic_keys(d: Spark) -> str:
    return f"SELECT id, concat_ws('|', source, doc_type, CASE WHEN clause_text = '' THEN '-' ELSE clause_text END) AS cell, concat(source, '::', coalesce(source_url, concat('synthetic::', {d.sha('CAST(id AS STRING)')}))) AS dedup_key FROM {registry(d)} r"


@plan
def ref_inheritance(d: Spark) -> str:
    """Generated rows take what they lack from the row they refer to."""
    return f"WITH r AS (SELECT * FROM {registry(d)} x) SELECT g.id, coalesce(s.ordering_agency, g.ordering_agency) AS agency, coalesce(s.production_date, g.production_date) AS base_date, s.id IS NULL AS orphan FROM r g LEFT JOIN r s ON s.id = g.id - 1 AND s.doc_type <> 'notice'"


def _evidence(spark, sf_dir):
    return E.keyword_evidence(spark_query(lambda d: f"SELECT line_key, text FROM {korean_lines(d)} k")(spark, sf_dir))


def _reasons(spark, sf_dir):
    return E.withholding_reasons(spark_query(lambda d: f"SELECT line_key, doc, text FROM {korean_lines(d)} k")(spark, sf_dir))


def _hints(spark, sf_dir):
    lines = spark_query(lambda d: f"SELECT line_key, doc, text, {_doc_type()} AS doc_type FROM {korean_lines(d)} k")(spark, sf_dir)
    return E.status_hints(lines, MAX_CANDIDATES_PER_DOC)


def _cells(spark, sf_dir):
    cells = spark.createDataFrame([(k, s) for k, rules in STATUS_RULES.items() for s, _ in rules], "doc_type string, status string")
    return E.status_cells(_hints(spark, sf_dir), cells)


#: These look at every line once; their plans above state the rules for the check.
ONE_PASS = {"keyword_evidence": _evidence, "withholding_reasons": _reasons, "status_candidates": lambda spark, sf_dir: _hints(spark, sf_dir).drop("doc_type"), "cell_measures": _cells}
QUERIES = {name: spark_query(f) for name, f in PLANS.items()} | ONE_PASS
ORACLE = {name: check_sql(f) for name, f in PLANS.items()}
