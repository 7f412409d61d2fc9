"""The tables of the test data, seen as the relations that the operators work on."""

from __future__ import annotations

from ..plans.dialect import Spark, any_end, any_in, first_of, text
from .dims import DEFAULT_SUBCLAUSE, STATUSES

AGENCIES = ("고용노동부", "서울특별시교육청", "한국개발연구원", "부산광역시", "국립암센터", "방송통신위원회", "한국철도공사")
_NTH = lambda x, names: f"CASE {x} " + " ".join(f"WHEN {i} THEN {text(n)}" for i, n in enumerate(names[:-1])) + f" ELSE {text(names[-1])} END"


def category(d: Spark, x: str) -> str:
    """The category of an agency by its name, the first rule that holds; a name that tells nothing is a corporation."""
    return first_of(
        (
            (f"{x} IS NULL OR {x} = ''", "'public_corporation'"),
            (any_in(x, ("교육청",)), "'education_office'"),
            (any_in(x, ("연구원", "연구소", "연구기관")), "'research_institute'"),
            (f"({any_end(d, x, ('부', '청', '처'))} OR contains({x}, '위원회'))", "'central_ministry'"),
            (any_end(d, x, ("특별시", "광역시", "특별자치시", "특별자치도", "도", "시", "군", "구")), "'metro_local_government'"),
        ),
        "'public_corporation'",
    )


def audit_rows(d: Spark) -> str:
    """Generated rows for the audit: row_id, status, title, body_text, class, clause, document type, agency, seeds, slot, cell."""
    default = "CASE clause_no " + " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in DEFAULT_SUBCLAUSE.items()) + " END"
    return f"""(
SELECT *, concat_ws('|', cso_classification, clause_no, cso_subclause_key, doc_type, agency_category, '-') AS coverage_cell_key FROM (
SELECT *, {default} AS cso_subclause_key, {category(d, 'ordering_agency')} AS agency_category FROM (
SELECT concat('row-', CAST(d.doc_id AS STRING)) AS row_id, d.doc_id AS arrival,
 CASE WHEN l.quality = 0 THEN 'failed' ELSE 'ok' END AS status,
 split_part(d.text, chr(10), 1) AS title,
 substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS body_text,
 CASE WHEN d.doc_id % 8 < 4 THEN 'C' ELSE 'S' END AS cso_classification,
 CAST(1 + d.doc_id % 8 AS STRING) AS clause_no,
 {_NTH('d.doc_id % 5', ('report', 'plan', 'approval', 'notice', 'meeting_minutes'))} AS doc_type,
 {_NTH('d.doc_id % 7', AGENCIES)} AS ordering_agency,
 d.lang AS template_id,
 concat('cand-', CAST(d.doc_id % 300 AS STRING)) AS seed_candidate_id,
 concat('ext-', CAST(d.doc_id % 120 AS STRING)) AS seed_extraction_id,
 {_NTH('d.doc_id % 20', (*STATUSES[:10], 'unheard_of', ''))} AS document_status,
 CAST(d.doc_id AS STRING) AS coverage_slot
FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id)))"""


def korean_lines(d: Spark) -> str:
    """Lines with article numbers, dates, money, counts and key words: line_key, doc (twelve lines each), text."""
    words = ("수의계약", "무기계약직", "종합감사", "감사드립니다", "납품단가", "재개발", "연락처:", "담당자: 과장", "붙임", "의견수렴", "안내")
    return f"""(
SELECT o_orderkey AS line_key, {d.whole('o_orderkey', '12')} AS doc,
 concat('제', CAST(o_orderkey % 130 AS STRING), '조에 따라 ', CAST(CAST(o_orderdate AS DATE) AS STRING), ' ',
  {_NTH('o_orderkey % 11', words)},
  ' 금액 ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), '원 ', CAST(o_custkey % 9 AS STRING), '명') AS text
FROM {{orders}})"""


def page_lines(d: Spark) -> str:
    """Lines of documents on pages of twelve, with boxes; the first line of a page is a header, the last its number."""
    numbered = d.numbered("doc_id", d.lines("text"), "{documents}")
    return f"""(
SELECT doc_id, pos, {d.whole('pos', '12')} + 1 AS page, {d.whole('pos', '4')} AS block_id,
 CASE WHEN pos % 12 = 0 THEN 'INTERNAL DRAFT' WHEN pos % 12 = 11 THEN concat('- ', CAST({d.whole('pos', '12')} + 1 AS STRING), ' -') ELSE item END AS text,
 CAST(10 AS BIGINT) AS x0, (pos % 12) * 14 AS y0, CAST(110 AS BIGINT) AS x1, (pos % 12) * 14 + 10 AS y1
FROM ({numbered}))"""


TITLES = ("인사발령 알림", "강사비 지급 품의", "사업 승인 요청 보고", "민원 회신", "연간 계획", "결과 보고", "입찰 재공고", "관외 출장", "사전규격 공개", "용역 입찰 공고", "협조 요청", "정기 공문")


def registry(d: Spark) -> str:
    """Collected documents: id, source, doc_type, title, production_date, disclosure, agency, path, url, clause_text, period."""
    return f"""(
SELECT o.o_orderkey AS id, lower(r.r_name) AS source,
 {_NTH('o.o_orderkey % 5', ('report', 'plan', 'approval', 'notice', 'meeting_minutes'))} AS doc_type,
 {_NTH('o.o_orderkey % 12', TITLES)} AS title,
 CAST(o.o_orderdate AS DATE) AS production_date,
 {_NTH('o.o_orderkey % 4', ('공개', '부분공개', '비공개', '미정'))} AS disclosure_text,
 {_NTH('o.o_custkey % 7', AGENCIES)} AS ordering_agency,
 concat('data/', lower(r.r_name), '/', {_NTH('o.o_orderkey % 5', ('report', 'plan', 'approval', 'notice', 'meeting_minutes'))}, '/1-500/', CAST(o.o_orderkey AS STRING), '_file.', CASE WHEN o.o_orderkey % 5 = 0 THEN 'hwp' ELSE 'pdf' END) AS body_file_path,
 CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE concat('http://site/', CAST(o.o_custkey AS STRING), '/', CAST(o.o_orderkey % 40 AS STRING)) END AS source_url,
 {_NTH('o.o_orderkey % 6', ('5호', '5호 6호 7호', '1호, 7호', '', '9호', '8호'))} AS clause_text,
 CASE WHEN o.o_orderkey % 5 = 0 THEN ' ~ ' WHEN o.o_orderkey % 5 = 1 THEN '2020-13-45 ~ 2020-01-02' ELSE concat(CAST(CAST(o.o_orderdate AS DATE) AS STRING), ' ~ ', CAST({d.day('CAST(o.o_orderdate AS DATE)', '30')} AS STRING)) END AS period,
 o.o_totalprice AS price, o.o_orderpriority AS priority
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey)"""
