"""Lines, layout, selection and evidence queries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import context as C
from ..operators import lines as L
from ..operators import quotes as Q
from ..sources.views import page_lines
from .dialect import Spark, check_sql, spark_query

PLANS = {}


def plan(f):
    PLANS[f.__name__] = f
    return f


_NUMERIC = "^[-‐‑‒–—−－]?\\s*[0-9ivxlcdmIVXLCDM]+\\s*[-‐‑‒–—−－]?$"


@plan
def logical_lines(d: Spark) -> str:
    """Lines with something on them, numbered anew."""
    return f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS line_no, trim(item) AS line FROM ({d.numbered('doc_id', d.lines('text'), '{documents}')}) x WHERE trim(item) <> ''"


@plan
def style_runs(d: Spark) -> str:
    """Neighbouring line items of one order with the same flags become one run: gaps and islands."""
    return """WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag AS style, l_partkey, l_suppkey, l_extendedprice, CASE WHEN lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = l_returnflag THEN 0 ELSE 1 END AS fresh FROM {lineitem}),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s)
SELECT l_orderkey, CAST(run AS BIGINT) AS run, min(style) AS style, min(l_linenumber) AS first_line, max(l_linenumber) AS last_line FROM r GROUP BY l_orderkey, run"""


@plan
def block_boxes(d: Spark) -> str:
    return f"SELECT doc_id, block_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM {page_lines(d)} p GROUP BY doc_id, block_id"


@plan
def text_quality(d: Spark) -> str:
    """Pages with fewer than five characters are sparse; their share grades the document."""
    return f"""WITH pages AS (SELECT doc_id, page, sum(length({d.replace_all('text', '[ ]', '')})) AS chars FROM {page_lines(d)} p GROUP BY doc_id, page),
q AS (SELECT doc_id, count(*) AS pages, CAST(sum(CASE WHEN chars < 5 THEN 1 ELSE 0 END) AS BIGINT) AS sparse, CAST(sum(chars) AS DOUBLE) / count(*) AS mean_chars FROM pages GROUP BY doc_id)
SELECT doc_id, pages, sparse, mean_chars, CASE WHEN CAST(sparse AS DOUBLE) / pages >= 0.9 THEN 'empty' WHEN CAST(sparse AS DOUBLE) / pages >= 0.5 THEN 'poor' WHEN sparse > 0 THEN 'partial' ELSE 'good' END AS severity FROM q"""


@plan
def printable_share(d: Spark) -> str:
    kept = d.replace_all("text", r"[^\x09\x0A\x0D\x20-\x7E\x{00A0}-\x{FFFF}]", "")
    return f"SELECT doc_id, CAST(length({kept}) AS DOUBLE) / greatest(1, length(text)) AS share, CAST(length({kept}) AS DOUBLE) / greatest(1, length(text)) < 0.7 AS needs_ocr FROM {{documents}}"


@plan
def without_garbage(d: Spark) -> str:
    pattern = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{FFFD}\x{E000}-\x{F8FF}]"
    dirty = f"concat(substr(text, 1, 40), {d.char(7)}, {d.char(0xFFFD)}, {d.char(0xE001)}, substr(text, 41))"
    return f"SELECT doc_id, {d.sha(d.replace_all(dirty, pattern, ''))} AS clean_sha, {d.replace_all(dirty, pattern, '')} = text AS restored FROM {{documents}}"


@plan
def boilerplate_slots(d: Spark) -> str:
    """Places on the page that repeat: on three pages and 30 per cent of them, with one text or numbers in 80 per cent."""
    return f"""WITH p AS (SELECT * FROM {page_lines(d)} g), n AS (SELECT doc_id, count(DISTINCT page) AS pages FROM p GROUP BY doc_id),
t AS (SELECT doc_id, x0, y0, text, count(*) AS c FROM p GROUP BY doc_id, x0, y0, text),
s AS (SELECT doc_id, x0, y0, max(c) AS most, sum(c) AS total, sum(CASE WHEN {d.matches('trim(text)', _NUMERIC)} THEN c ELSE 0 END) AS numeric FROM t GROUP BY doc_id, x0, y0),
o AS (SELECT doc_id, x0, y0, count(DISTINCT page) AS seen FROM p GROUP BY doc_id, x0, y0)
SELECT s.doc_id, s.y0, seen FROM s JOIN o ON s.doc_id = o.doc_id AND s.x0 = o.x0 AND s.y0 = o.y0 JOIN n ON s.doc_id = n.doc_id
WHERE seen >= 3 AND CAST(seen AS DOUBLE) / pages >= 0.3 AND (CAST(most AS DOUBLE) / total >= 0.8 OR CAST(numeric AS DOUBLE) / total >= 0.8)"""


@plan
def boilerplate_texts(d: Spark) -> str:
    """Without geometry, a text (all numbers counting as one) on three pages and 30 per cent of them."""
    key = f"CASE WHEN {d.matches('trim(text)', _NUMERIC)} THEN '#' ELSE text END"
    return f"""WITH p AS (SELECT doc_id, page, {key} AS k FROM {page_lines(d)} g), n AS (SELECT doc_id, count(DISTINCT page) AS pages FROM p GROUP BY doc_id),
s AS (SELECT doc_id, k, count(DISTINCT page) AS seen FROM p GROUP BY doc_id, k)
SELECT s.doc_id, {d.sha('k')} AS key_sha, seen FROM s JOIN n ON s.doc_id = n.doc_id WHERE seen >= 3 AND CAST(seen AS DOUBLE) / pages >= 0.3"""


@plan
def page_snapshot(d: Spark) -> str:
    return f"SELECT doc_id, {d.whole('pos', '12')} + 1 AS page_number, concat('p', CAST({d.whole('pos', '12')} + 1 AS STRING), ':b', CAST(pos % 12 AS STRING)) AS block_id, length(item) AS chars FROM ({d.numbered('doc_id', d.lines('text'), '{documents}')}) x"


@plan
def token_estimates(d: Spark) -> str:
    return "SELECT doc_id, CAST(greatest(1, ceil(length(text) / 2.0)) AS BIGINT) AS tokens FROM {documents}"


#: Pages up to which a document is taken whole; else so many front pages, and estimated tokens of them.
PAGE_THRESHOLD, FRONT_PAGES, FRONT_TOKENS = 85, 20, 32_000


@plan
def front_selection(d: Spark, threshold: int = PAGE_THRESHOLD, front: int = FRONT_PAGES, tokens: int = FRONT_TOKENS) -> str:
    """Up to 85 pages everything; else the blocks of the first 20 pages until the estimate of what is rendered passes 32,000 tokens.

    The first block that passes it stops all; if that is the document's first, nothing is kept (context_overflow).
    """
    return f"""WITH b AS (SELECT doc_id, page, block_id, count(*) AS n, sum(length(text) + 1) - 1 AS chars FROM {page_lines(d)} g GROUP BY doc_id, page, block_id),
m AS (SELECT *, max(page) OVER (PARTITION BY doc_id) AS pages, min(block_id) OVER (PARTITION BY doc_id, page) AS opening FROM b),
c AS (SELECT *, sum(chars + length(concat('[BLOCK ', CAST(block_id AS STRING), ']')) + 3 + CASE WHEN block_id = opening THEN length(concat('[PAGE ', CAST(page AS STRING), ']')) + 2 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 2 AS upto FROM m),
k AS (SELECT *, pages <= {threshold} OR (page <= {front} AND ceil(upto / 2.0) <= {tokens}) AS kept FROM c)
SELECT doc_id, CAST(sum(CASE WHEN kept THEN n ELSE 0 END) AS BIGINT) AS kept_lines, CAST(sum(n) AS BIGINT) AS total_lines, CAST(coalesce(max(CASE WHEN kept THEN upto END), 0) AS BIGINT) AS kept_chars,
CASE WHEN max(pages) <= {threshold} THEN 'full_document' WHEN sum(CASE WHEN kept THEN 1 ELSE 0 END) = 0 THEN 'context_overflow' ELSE 'front_pages' END AS state FROM k GROUP BY doc_id"""


@plan
def mask_slots(d: Spark) -> str:
    """The first masked run of each line, with up to sixty characters around it."""
    pattern = r"\*\*+"
    return f"""SELECT doc_id, pos, length(mask) AS mask_chars, {d.sha("concat(CASE WHEN spot > 61 THEN '…' ELSE '' END, substr(item, greatest(1, spot - 60), 120 + length(mask)))")} AS context_sha
FROM (SELECT doc_id, pos, item, mask, instr(item, mask) AS spot FROM (SELECT doc_id, pos, item, {d.first_match('item', pattern)} AS mask FROM ({d.numbered('doc_id', d.lines('text'), '{documents}')}) x) y WHERE mask <> '') z"""


@plan
def evidence_quotes(d: Spark) -> str:
    """A quote is looked for without its white space: found, not found, or ambiguous; turns of fifty characters or fewer are too short for one."""
    squeeze = lambda x: d.replace_all(x, r"\s+", "")
    return f"""SELECT conv_id, turn, CASE WHEN chars <= 50 THEN 'too_short' WHEN instr(said, quote) = 0 THEN 'not_found' WHEN instr(substr(said, instr(said, quote) + 1), quote) > 0 THEN 'ambiguous' ELSE 'found' END AS state
FROM (SELECT conv_id, turn, coalesce(length(text), 0) AS chars, {squeeze('text')} AS said, {squeeze("CASE turn % 3 WHEN 0 THEN substr(text, 5, 40) WHEN 1 THEN substr(text, 10, 2) ELSE concat(substr(text, 5, 20), 'zq') END")} AS quote FROM {{conversations}}) x"""


@plan
def evidence_pages(d: Spark) -> str:
    """Pages that still hold both ends of an assertion."""
    return f"""WITH p AS (SELECT doc_id, page, {d.joined('text', 'pos', ' ')} AS said FROM {page_lines(d)} g GROUP BY doc_id, page), a AS (SELECT doc_id, split_part(trim(text), ' ', 1) AS subject, split_part(trim(text), ' ', 2) AS value FROM {{documents}})
SELECT a.doc_id, {d.joined('CAST(page AS STRING)', 'page')} AS pages FROM a JOIN p ON a.doc_id = p.doc_id WHERE subject <> '' AND value <> '' AND contains(said, subject) AND contains(said, value) GROUP BY a.doc_id"""


@plan
def page_titles(d: Spark) -> str:
    """Values behind labels in raw HTML."""
    return f"SELECT page_id, {d.first_match('html', '<title>([^<]*)</title>', 1)} AS title, {d.first_match('html', '<html lang=.([a-z]+).', 1)} AS lang, {d.size(d.all_matches('html', '<li>'))} AS items FROM {{pages}}"


@plan
def stripped_html(d: Spark) -> str:
    bare = d.replace_all(d.replace_all("html", r"<[^>]*>", " "), r"\s+", " ")
    return f"SELECT page_id, length({bare}) AS chars, {d.sha(bare)} AS text_sha FROM {{pages}}"


def _page_rows(spark, sf_dir):
    return spark_query(lambda d: f"SELECT doc_id, page, pos, block_id, text, x0, y0, x1, y1 FROM {page_lines(d)} g")(spark, sf_dir)


def _anchors(spark, sf_dir):
    """Every twentieth line, and the one behind it."""
    return _page_rows(spark, sf_dir).select("doc_id", F.col("pos").alias("first_pos"), F.least(F.col("pos") + 1, F.max("pos").over(W.partitionBy("doc_id"))).alias("last_pos")).where("first_pos % 20 = 3")


_QUOTE = "CASE turn % 4 WHEN 0 THEN substr(text, 5, 40) WHEN 1 THEN substr(text, 10, 2) WHEN 2 THEN concat(substr(text, 5, 20), 'zq') ELSE concat(' ', substr(text, 3, 12), chr(10)) END"


def _quoted(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id", "turn", "text", f"{_QUOTE} AS quote")


QUERIES = {name: spark_query(f) for name, f in PLANS.items()} | {
    "merged_lines": lambda s, p: L.merge_wrapped(_page_rows(s, p).withColumn("furniture", F.col("pos") % 12 == 11), "furniture"),
    "merged_spans": lambda s, p: L.merge_wrapped(_page_rows(s, p), within_blocks=False),
    "split_long_lines": lambda s, p: L.split_long(s.read.parquet(f"{p}/documents.parquet")).select("doc_id", "line_id", F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("text_sha")),
    "line_context": lambda s, p: C.line_context(_page_rows(s, p)).select("doc_id", "pos", F.sha2("context", 256).alias("context_sha")),
    "budgeted_context": lambda s, p: C.budgeted_context(_page_rows(s, p), _anchors(s, p)).select("doc_id", "first_pos", "lines", F.length("context").cast("long").alias("chars"), F.sha2("context", 256).alias("context_sha")),
    "quote_offsets": lambda s, p: _quoted(s, p).select("conv_id", "turn", Q.located(F.col("text"), F.col("quote")).alias("x")).select("conv_id", "turn", "x.state", "x.offset"),
    "cell_lines": lambda s, p: L.cell_lines(s.read.parquet(f"{p}/lineitem.parquet")),
    "fragment_presence": lambda s, p: L.fragment_presence(s.read.parquet(f"{p}/conversations.parquet")),
    "similar_attachment": lambda s, p: L.primary_attachment(s.read.parquet(f"{p}/part.parquet")),
}
ORACLE = {name: check_sql(f) for name, f in PLANS.items()} | {
    # every block is four lines of one page whose gaps are 4, so wrapped lines merge within blocks; blank lines and page numbers part them
    "merged_lines": check_sql(
        lambda d: f"""WITH g AS (SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND lag(block_id) OVER w = block_id AND lag(page) OVER w = page THEN 0 ELSE 1 END AS fresh FROM {page_lines(d)} x WHERE trim(text) <> '' AND pos % 12 <> 11 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS seg FROM g)
SELECT doc_id, min(pos) AS first_pos, count(*)::BIGINT AS lines, max(y1) AS y1, sha256(string_agg(text, ' ' ORDER BY pos)) AS text_sha FROM r GROUP BY doc_id, seg"""
    ),
    # without blocks the twelve lines of a page are one segment; a blank is put between two lines unless one of them has it
    "merged_spans": check_sql(
        lambda d: f"""SELECT doc_id, min(pos) AS first_pos, count(*)::BIGINT AS lines, max(y1) AS y1, sha256(list_reduce(list(text ORDER BY pos), lambda a, b: concat(a, CASE WHEN a LIKE '% ' OR b LIKE ' %' THEN '' ELSE ' ' END, b))) AS text_sha
FROM {page_lines(d)} x GROUP BY doc_id, page"""
    ),
    "split_long_lines": f"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), chr(10))) AS line, unnest(range(len(string_split(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), chr(10))))) AS n FROM documents),
r AS (SELECT doc_id, n, 0 AS k, '' AS piece, line AS rest FROM l WHERE regexp_replace(line, '\\s+', '', 'g') <> ''
  UNION ALL SELECT doc_id, n, k + 1, substr(rest, 1, cut), substr(rest, cut + 1) FROM (SELECT *, CASE WHEN length(rest) <= {L.MOST_CHARS} THEN length(rest) WHEN best < {L.MOST_CHARS // 2} THEN {L.MOST_CHARS} ELSE best END AS cut FROM (
    SELECT *, list_max(list_transform({list(L.BREAKS)!r}, lambda c: CASE WHEN instr(substr(rest, 1, {L.MOST_CHARS}), c) = 0 THEN 0 ELSE least(length(rest), {L.MOST_CHARS}) - instr(reverse(substr(rest, 1, {L.MOST_CHARS})), c) + 1 END)) AS best FROM r WHERE rest <> '') y) x)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n, k) - 1 AS line_id, length(piece)::BIGINT AS chars, sha256(piece) AS text_sha FROM r WHERE k > 0""",
    "line_context": check_sql(
        lambda d: f"""WITH s AS (SELECT doc_id, pos, trim(text) AS t FROM {page_lines(d)} g), c AS (SELECT doc_id, pos, CASE WHEN length(t) > 240 THEN concat(substr(t, 1, 239), '…') ELSE t END AS t FROM s),
n AS (SELECT doc_id, pos, t, lag(t, 2) OVER w AS a, lag(t) OVER w AS b, lead(t) OVER w AS e, lead(t, 2) OVER w AS f FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, pos, sha256(concat_ws(chr(10), '[이전] ' || a, '[이전] ' || b, '[대상] ' || t, '[다음] ' || e, '[다음] ' || f)) AS context_sha FROM n"""
    ),
    "budgeted_context": check_sql(
        lambda d: f"""WITH l AS (SELECT doc_id, pos, block_id, text FROM {page_lines(d)} g), b AS (SELECT doc_id, block_id AS b, sum(length(text) + 1) AS n FROM l GROUP BY 1, 2),
a AS (SELECT doc_id, pos AS first_pos, least(pos + 1, max(pos) OVER (PARTITION BY doc_id)) AS last_pos, block_id FROM l), c AS (SELECT a.doc_id, a.first_pos, a.block_id AS lo, z.block_id AS hi FROM a JOIN l z ON z.doc_id = a.doc_id AND z.pos = a.last_pos WHERE a.first_pos % 20 = 3),
t AS (SELECT c.*, greatest(0, 1200 - (SELECT sum(n) FROM b WHERE b.doc_id = c.doc_id AND b.b BETWEEN c.lo AND c.hi)) AS rest FROM c),
k AS (SELECT t.*, b.b, sum(b.n) OVER (PARTITION BY t.doc_id, first_pos, b.b < lo, b.b > hi ORDER BY abs(b.b - lo)) AS upto FROM t JOIN b ON b.doc_id = t.doc_id),
kept AS (SELECT * FROM k WHERE b BETWEEN lo AND hi OR (b < lo AND upto <= rest // 2) OR (b > hi AND upto <= rest - rest // 2)),
j AS (SELECT kept.doc_id, first_pos, count(*) AS lines, substr(string_agg(text, chr(10) ORDER BY pos), 1, 3600) AS context FROM kept JOIN l ON l.doc_id = kept.doc_id AND l.block_id = kept.b GROUP BY 1, 2)
SELECT doc_id, first_pos, lines, length(context)::BIGINT AS chars, sha256(context) AS context_sha FROM j"""
    ),
    "quote_offsets": f"""WITH x AS (SELECT conv_id, turn, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '\\s+', '', 'g') AS said, regexp_replace(coalesce({_QUOTE}, ''), '\\s+', '', 'g') AS quote FROM conversations),
y AS (SELECT *, CASE WHEN quote = '' THEN 'empty' WHEN instr(said, quote) = 0 THEN 'not found' WHEN instr(substr(said, instr(said, quote) + 1), quote) > 0 THEN 'ambiguous' ELSE 'found' END AS state FROM x)
SELECT conv_id, turn, state, CASE WHEN state = 'found' THEN list_filter(range(length(text)), lambda i: NOT regexp_matches(substr(text, i + 1, 1), '\\s'))[instr(said, quote)] END AS "offset" FROM y""",
}
