"""Classification rules, keys and storage operators over collected documents."""

from __future__ import annotations

from ..sources.dims import CLAUSE_TYPE_WORDS, CLAUSE_TYPES, DEFAULT_SUBCLAUSE, LEAVES, SUBCLAUSE_WORDS, TITLE_TYPES, WITHHELD, leaf_rows
from ..sources.views import category, korean_lines, registry
from .dialect import Spark, any_end, any_in, check_sql, first_of, spark_query, text, values

PLANS = {}


def plan(f):
    PLANS[f.__name__] = f
    return f


@plan
def title_doc_types(d: Spark) -> str:
    rule = first_of(((any_in("title", words), text(kind)) for kind, words in TITLE_TYPES), "'official_document'")
    return f"SELECT id, title, {rule} AS inferred_type FROM {registry(d)} r"


@plan
def board_doc_types(d: Spark) -> str:
    ends = d.ends(d.replace_all("title", r"\s+$", ""), "'공고'")
    rule = first_of((("contains(title, '사전규격')", "'pre_spec_notice'"), ("contains(title, '재공고')", "'bid_renotice'"), ("contains(title, '공모')", "'public_offering'"), (f"(contains(title, '입찰') OR {ends})", "'bid_notice'")), "'notice'")
    return f"SELECT id, title, {rule} AS inferred_type FROM {registry(d)} r"


@plan
def clause_doc_types(d: Spark) -> str:
    cases = [(f"clause = {text(c)} AND contains(said, {text(w)})", text(kind)) for c, (words, _) in CLAUSE_TYPE_WORDS.items() for w, kind in words]
    cases += [(f"clause = {text(c)}", text(kind)) for c, (_, kind) in CLAUSE_TYPE_WORDS.items()]
    cases += [(f"clause = {text(c)}", text(kind)) for c, kind in CLAUSE_TYPES.items()]
    return f"SELECT line_key, clause, {first_of(cases, text('official_document'))} AS inferred_type FROM (SELECT line_key, CAST(line_key % 10 AS STRING) AS clause, text AS said FROM {korean_lines(d)} k) x"


@plan
def subclauses(d: Spark) -> str:
    """A clause and type with one leaf have its subclause; else the first whose words occur, the default, or the first leaf."""
    own: dict[tuple[str, str], list[str]] = {}
    for _, clause, sub, kind in leaf_rows():
        own.setdefault((clause, kind), []).append(sub)
    cases = []
    for (clause, kind), subs in own.items():
        at = f"clause = {text(clause)} AND doc_type = {text(kind)}"
        if len(subs) > 1:
            cases += [(f"{at} AND {any_in('said', [w.lower() for w in words])}", text(sub)) for sub, words in SUBCLAUSE_WORDS.get(clause, ()) if sub in subs]
        cases.append((at, text(DEFAULT_SUBCLAUSE[clause] if DEFAULT_SUBCLAUSE[clause] in subs and len(subs) > 1 else subs[0])))
    kinds = sorted({k for groups in LEAVES.values() for _, ks in groups for k in ks})
    pick = "CASE line_key % " + str(len(kinds)) + " " + " ".join(f"WHEN {i} THEN {text(k)}" for i, k in enumerate(kinds)) + " END"
    return f"SELECT line_key, clause, doc_type, {first_of(cases, 'NULL')} AS subclause FROM (SELECT line_key, CAST(1 + line_key % 8 AS STRING) AS clause, {pick} AS doc_type, lower(text) AS said FROM {korean_lines(d)} k) x"


@plan
def agency_categories(d: Spark) -> str:
    return f"SELECT ordering_agency, {category(d, 'ordering_agency')} AS agency_category, count(*) AS n FROM {registry(d)} r GROUP BY ordering_agency"


@plan
def disclosure_classes(d: Spark) -> str:
    """Known disclosure texts become a status and a class; others are set apart as errors."""
    known = "disclosure_text IN ('공개', '부분공개', '비공개')"
    return f"""SELECT id, CASE disclosure_text WHEN '공개' THEN 'open' WHEN '부분공개' THEN 'partial' WHEN '비공개' THEN 'closed' END AS disclosure,
CASE disclosure_text WHEN '공개' THEN 'O' WHEN '부분공개' THEN 'S' WHEN '비공개' THEN 'C' END AS class,
CASE WHEN NOT {known} THEN concat('unknown disclosure: ', disclosure_text) END AS error FROM {registry(d)} r"""


@plan
def clause_numbers(d: Spark) -> str:
    """Numbers 1 to 8 of a clause text; any of 1 to 4 makes C, else S; none is an error."""
    nums = d.all_matches("clause_text", r"\d+")
    valid = d.lambda_("keep", nums, "n", "CAST(n AS INT) BETWEEN 1 AND 8")
    secret = d.size(d.lambda_("keep", "valid", "n", "CAST(n AS INT) <= 4"))
    return f"SELECT id, {d.glue('valid', ',')} AS sub_clauses, CASE WHEN {d.size('valid')} = 0 THEN NULL WHEN {secret} > 0 THEN 'C' ELSE 'S' END AS class, {d.size('valid')} = 0 AS quarantined FROM (SELECT id, {valid} AS valid FROM {registry(d)} r) x"


@plan
def periods(d: Spark) -> str:
    a, b = (d.to_date(f"trim(split_part(period, '~', {i}))", "yyyy-MM-dd") for i in (1, 2))
    return f"SELECT id, CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE a END AS start_date, CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE b END AS end_date FROM (SELECT id, {a} AS a, {b} AS b FROM {registry(d)} r) x"


@plan
def suppressed_bodies(d: Spark) -> str:
    body = "CASE id % 9 WHEN 0 THEN concat(title, ' 청구신청 하시기 바랍니다') WHEN 1 THEN '열람이 제한됩니다' ELSE title END"
    return f"SELECT id, CASE WHEN {any_in('body', WITHHELD)} THEN NULL ELSE body END AS body_text FROM (SELECT id, {body} AS body FROM {registry(d)} r) x"


@plan
def agency_capabilities(d: Spark) -> str:
    """What an agency is known for: a verified list first, then marks in its name, in order."""
    generic = "generic_public_body"
    name = "ordering_agency"
    rule = first_of(
        (
            (f"{name} = '국립암센터'", text(",".join((generic, "medical_care", "research_development", "technology_transfer")))),
            (any_in(name, ("(주)", "주식회사", "공영홈쇼핑", "강원랜드")), text(f"commercial_product_sales,corporate_transactions,{generic}")),
            (any_in(name, ("복지", "건강보험", "연금", "양육비")), text(f"{generic},social_welfare")),
            (any_in(name, ("병원", "의료원", "암센터")), text(f"{generic},medical_care")),
            (any_end(d, name, ("특별시", "광역시", "특별자치시", "시청", "군청", "구청")), text(f"{generic},local_resident_administration")),
            (f"({any_end(d, name, ('부', '청', '처'))} OR contains({name}, '위원회'))", text(f"{generic},regulatory_policy")),
        ),
        text(generic),
    )
    return f"SELECT DISTINCT ordering_agency, {rule} AS capabilities FROM {registry(d)} r"


@plan
def scenario_compatibility(d: Spark) -> str:
    """An agency fits a scenario if it has all required capabilities and one of the alternatives, where there are any."""
    scenarios = values((("6", 2, "social_welfare", None), ("6", 3, "medical_care", None), ("6", 5, "local_resident_administration", None), ("7", 0, "research_development", None), ("7", 1, "corporate_transactions", None), ("7", 4, "commercial_product_sales", None), ("7", 6, "commercial_product_sales", None), ("7", 7, "corporate_transactions", None), ("7", 8, None, "research_development,regulatory_policy"), ("5", 0, None, None)), "clause, scenario, required, any_of")
    has = lambda x: f"contains(concat(',', capabilities, ','), concat(',', {x}, ','))"
    found = d.size(d.lambda_("keep", d.pieces("any_of", ","), "x", has("x")))
    fits = f"(required IS NULL OR {has('required')}) AND (any_of IS NULL OR {found} > 0)"
    return f"SELECT ordering_agency, clause, scenario, {fits} AS fits FROM ({agency_capabilities(d)}) a CROSS JOIN {scenarios} s"


@plan
def effective_classes(d: Spark) -> str:
    """C stays C; S, or any administrative status, makes S; else O."""
    return f"SELECT id, CASE WHEN disclosure_text = '비공개' THEN 'C' WHEN disclosure_text = '부분공개' OR id % 7 = 0 THEN 'S' ELSE 'O' END AS effective_class FROM {registry(d)} r"


@plan
def field_completeness(d: Spark) -> str:
    """Empty values by source and field."""
    fields = ("title", "source_url", "body_file_path", "clause_text", "ordering_agency")
    parts = " UNION ALL ".join(f"SELECT source, {text(f)} AS field, {f} AS v FROM r" for f in fields)
    return f"WITH r AS (SELECT * FROM {registry(d)} x) SELECT source, field, count(*) AS total_rows, CAST(sum(CASE WHEN v IS NULL OR trim(v) = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_rows FROM ({parts}) u GROUP BY source, field"


@plan
def personal_values(d: Spark) -> str:
    """Which kinds of personal data a document has."""
    kinds = (("email", r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]{2,}"), ("phone", r"\(\d{3}\) \d{3}-\d{4}"), ("ip", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"), ("card", r"\d{16}"))
    marks = ", ".join(f"{d.matches('text', p)} AS has_{k}" for k, p in kinds)
    return f"SELECT doc_id, {marks} FROM {{documents}}"


@plan
def substitution_acceptance(d: Spark) -> str:
    """A rewritten turn is accepted if its length is within half and one and a half of the original, which it must not contain."""
    return f"SELECT conv_id, turn, ratio BETWEEN 0.5 AND 1.5 AND NOT contains(after_text, before_text) AS accepted FROM (SELECT a.conv_id, a.turn, a.text AS before_text, b.text AS after_text, CAST(length(b.text) AS DOUBLE) / greatest(1, length(a.text)) AS ratio FROM {{conversations}} a JOIN {{conversations}} b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) x"


@plan
def known_ids_only(d: Spark) -> str:
    """Answers keep only ids that were asked for."""
    return "SELECT doc_id, quality, toxic FROM {labels} l WHERE EXISTS (SELECT 1 FROM {documents} d WHERE d.doc_id = l.doc_id AND d.lang = 'en')"


# ------------------------------------------------------------------------------ storage operators


@plan
def latest_open_pdfs(d: Spark) -> str:
    return f"SELECT id, doc_type, body_file_path FROM (SELECT id, doc_type, body_file_path, row_number() OVER (PARTITION BY doc_type ORDER BY id DESC) AS n FROM {registry(d)} r WHERE disclosure_text = '공개' AND {d.ends('lower(body_file_path)', text('.pdf'))}) x WHERE n <= 20"


_KEYED = "SELECT *, concat(source, '::', source_url) AS dedup_key FROM {r} x WHERE source_url IS NOT NULL"


@plan
def insert_if_absent(d: Spark) -> str:
    """New rows whose key is not in the target, the first of each key by id; the target is what was there before 1997."""
    return f"""WITH keyed AS ({_KEYED.replace('{r}', registry(d))}), target AS (SELECT DISTINCT dedup_key FROM keyed WHERE production_date < DATE '1997-01-01'),
fresh AS (SELECT k.*, row_number() OVER (PARTITION BY k.dedup_key ORDER BY k.id) AS n FROM keyed k LEFT JOIN target t ON k.dedup_key = t.dedup_key WHERE t.dedup_key IS NULL)
SELECT id, dedup_key FROM fresh WHERE n = 1"""


@plan
def already_stored(d: Spark) -> str:
    return f"WITH keyed AS ({_KEYED.replace('{r}', registry(d))}) SELECT id FROM keyed k WHERE production_date >= DATE '1997-01-01' AND EXISTS (SELECT 1 FROM keyed t WHERE t.dedup_key = k.dedup_key AND t.production_date < DATE '1997-01-01')"


@plan
def targeted_update(d: Spark) -> str:
    """Agencies replaced where an update names the row; other rows stay."""
    return f"WITH r AS (SELECT id, ordering_agency FROM {registry(d)} x), u AS (SELECT id, concat(ordering_agency, ' 본부') AS agency FROM r WHERE id % 5 = 0) SELECT r.id, coalesce(u.agency, r.ordering_agency) AS ordering_agency, u.id IS NOT NULL AS updated FROM r LEFT JOIN u ON r.id = u.id"


@plan
def quarantine_rows(d: Spark) -> str:
    pack = "to_json(named_struct('id', id, 'disclosure_text', disclosure_text))" if d.name == "spark" else "concat('{\"id\":', id, ',\"disclosure_text\":\"', disclosure_text, '\"}')"
    return f"SELECT id, {pack} AS raw_payload, concat('unknown disclosure: ', disclosure_text) AS error FROM {registry(d)} r WHERE disclosure_text NOT IN ('공개', '부분공개', '비공개')"


@plan
def pending_queue(d: Spark) -> str:
    """Downloads that wait, by source in the order they came; what has been fetched is gone."""
    return f"WITH q AS (SELECT source, source_url, min(id) AS first_id FROM {registry(d)} r WHERE source_url IS NOT NULL GROUP BY source, source_url), done AS (SELECT DISTINCT source, source_url FROM {registry(d)} r2 WHERE id % 3 = 0 AND source_url IS NOT NULL) SELECT q.source, q.source_url, row_number() OVER (PARTITION BY q.source ORDER BY first_id) AS place FROM q LEFT JOIN done ON q.source = done.source AND q.source_url = done.source_url WHERE done.source IS NULL"


@plan
def schema_evolution(d: Spark) -> str:
    """Old rows get the new columns as null, a retyped column, and lose a dropped one."""
    return f"SELECT id, title, CAST(NULL AS STRING) AS status_label, CAST(floor(price) AS BIGINT) AS price FROM {registry(d)} r WHERE id % 2 = 0 UNION ALL SELECT id, title, priority, CAST(floor(price) AS BIGINT) FROM {registry(d)} r WHERE id % 2 = 1"


@plan
def tighten_not_null(d: Spark) -> str:
    """A column may become NOT NULL only if no row has a null there."""
    return f"SELECT source, count(*) - count(source_url) AS null_urls, count(*) = count(source_url) AS can_tighten_url, count(*) = count(title) AS can_tighten_title FROM {registry(d)} r GROUP BY source"


@plan
def migration_counts(d: Spark) -> str:
    return f"WITH keyed AS ({_KEYED.replace('{r}', registry(d))}), target AS (SELECT DISTINCT dedup_key FROM keyed WHERE id % 4 = 0), s AS (SELECT DISTINCT dedup_key, source FROM keyed) SELECT s.source, CAST(sum(CASE WHEN t.dedup_key IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted, CAST(sum(CASE WHEN t.dedup_key IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS skipped FROM s LEFT JOIN target t ON s.dedup_key = t.dedup_key GROUP BY s.source"


@plan
def storage_buckets(d: Spark) -> str:
    """Folders of 500 files each, by source and type, in the order of ids."""
    start = f"{d.whole('(n - 1)', '500')} * 500 + 1"
    return f"SELECT id, concat(source, '/', doc_type, '/', CAST({start} AS STRING), '-', CAST({start} + 499 AS STRING)) AS folder FROM (SELECT id, {d.replace_all('source', '[^A-Za-z0-9_-]', '')} AS source, doc_type, row_number() OVER (PARTITION BY source, doc_type ORDER BY id) AS n FROM {registry(d)} r) x"


@plan
def safe_paths(d: Spark) -> str:
    p = "CASE id % 7 WHEN 0 THEN concat('/', body_file_path) WHEN 1 THEN concat('../', body_file_path) ELSE body_file_path END"
    return f"SELECT id, path, NOT {d.starts('path', text('/'))} AND NOT {d.has(d.pieces('path', '/'), text('..'))} AS safe FROM (SELECT id, {p} AS path FROM {registry(d)} r) x"


@plan
def path_parts(d: Spark) -> str:
    return f"SELECT id, split_part(body_file_path, '/', 2) AS p_source, coalesce(nullif(split_part(body_file_path, '/', 3), ''), '_unclassified') AS p_type, {d.first_match('body_file_path', '/([0-9]+)_[^/]*$', 1)} AS p_doc, lower({d.first_match('body_file_path', '[.]([A-Za-z0-9]+)$', 1)}) AS p_format FROM {registry(d)} r"


@plan
def broken_stubs(d: Spark) -> str:
    """Files that are HTML in truth, counted by host kind."""
    return f"SELECT {d.first_match('url', '^([a-z]+)://', 1)} AS scheme, count(*) AS files, CAST(sum(CASE WHEN contains(lower(substr(html, 1, 256)), '<html') OR contains(lower(substr(html, 1, 256)), '<!doctype html') THEN 1 ELSE 0 END) AS BIGINT) AS stubs FROM {{pages}} GROUP BY 1"


@plan
def classification_counts(d: Spark) -> str:
    return f"SELECT source, doc_type, disclosure_text, count(*) AS n FROM {registry(d)} r GROUP BY source, doc_type, disclosure_text"


@plan
def batch_summary(d: Spark) -> str:
    return f"SELECT doc_type, disclosure_text, priority, count(*) AS n FROM {registry(d)} r GROUP BY GROUPING SETS ((doc_type), (disclosure_text), (priority), (doc_type, priority))"


@plan
def agency_date_samples(d: Spark) -> str:
    return f"SELECT ordering_agency, count(DISTINCT production_date) AS dates, min(production_date) AS first_date, max(production_date) AS last_date FROM {registry(d)} r GROUP BY ordering_agency"


@plan
def type_caps(d: Spark) -> str:
    """Open rows taken by document type up to a cap, going on from what is stored."""
    return f"WITH r AS (SELECT * FROM {registry(d)} x WHERE disclosure_text = '공개'), stored AS (SELECT doc_type, count(*) AS had FROM r WHERE production_date < DATE '1997-01-01' GROUP BY doc_type), c AS (SELECT id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY id) AS n FROM r WHERE production_date >= DATE '1997-01-01') SELECT c.doc_type, CAST(sum(CASE WHEN n + coalesce(had, 0) <= 400 THEN 1 ELSE 0 END) AS BIGINT) AS taken, CAST(sum(CASE WHEN n + coalesce(had, 0) <= 400 THEN 0 ELSE 1 END) AS BIGINT) AS skipped FROM c LEFT JOIN stored s ON c.doc_type = s.doc_type GROUP BY c.doc_type"


@plan
def agency_by_path(d: Spark) -> str:
    """Candidates get the agency of the first document stored under their source, type and id."""
    return f"WITH r AS (SELECT * FROM {registry(d)} x), lookup AS (SELECT split_part(body_file_path, '/', 2) AS source, split_part(body_file_path, '/', 3) AS doc_type, {d.first_match('body_file_path', '/([0-9]+)_[^/]*$', 1)} AS doc, min_by(ordering_agency, id) AS agency FROM r WHERE id % 3 <> 0 GROUP BY 1, 2, 3) SELECT r.id, l.agency, CASE WHEN l.agency IS NULL THEN 'unresolved' ELSE 'resolved' END AS profile_status FROM r LEFT JOIN lookup l ON r.source = l.source AND r.doc_type = l.doc_type AND CAST(r.id AS STRING) = l.doc"


@plan
def fixed_agency_override(d: Spark) -> str:
    fixed = values((("africa", "교육부"), ("asia", "보건복지부")), "f_source, f_agency")
    return f"SELECT id, coalesce(f_agency, CASE WHEN id % 3 <> 0 THEN ordering_agency END) AS agency, CASE WHEN f_agency IS NOT NULL THEN 'fixed' WHEN id % 3 <> 0 THEN 'stored' ELSE 'missing' END AS reason FROM {registry(d)} r LEFT JOIN {fixed} f ON r.source = f.f_source"


@plan
def corpus_completeness(d: Spark) -> str:
    """Paths expected but not covered, and covered but not expected."""
    return f"WITH e AS (SELECT body_file_path AS p FROM {registry(d)} r WHERE id % 7 <> 0), c AS (SELECT body_file_path AS p FROM {registry(d)} r WHERE id % 5 <> 0) SELECT 'missing' AS kind, p FROM (SELECT p FROM e EXCEPT SELECT p FROM c) a UNION ALL SELECT 'extra', p FROM (SELECT p FROM c EXCEPT SELECT p FROM e) b"


@plan
def unique_violations(d: Spark) -> str:
    return f"SELECT concat(source, '::', source_url) AS dedup_key, count(*) AS n, min(id) AS first_id FROM {registry(d)} r WHERE source_url IS NOT NULL GROUP BY source, source_url HAVING count(*) > 1"


@plan
def path_to_one_id(d: Spark) -> str:
    return f"SELECT source_url, count(DISTINCT id) AS ids FROM {registry(d)} r WHERE source_url IS NOT NULL GROUP BY source_url HAVING count(DISTINCT id) > 1"


@plan
def label_agreement(d: Spark) -> str:
    """Sidecar labels must cover the same ids with equal values; anything else needs a look."""
    return "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'extra' WHEN b.doc_id IS NULL THEN 'missing' ELSE 'differs' END AS problem FROM {documents} a FULL OUTER JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'xx' ELSE 'en' END AS lang FROM {labels}) b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.lang <> b.lang"


QUERIES = {name: spark_query(f) for name, f in PLANS.items()}
ORACLE = {name: check_sql(f) for name, f in PLANS.items()}
