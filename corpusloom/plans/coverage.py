"""Coverage plan: cells of the label matrix, counts, and allocation of exact totals."""

from __future__ import annotations

from ..sources.dims import CATEGORIES, DEFAULT_SUBCLAUSE, leaf_rows, status_rows
from ..sources.views import category, registry
from .dialect import Spark, check_sql, spark_query, text, values

PLANS = {}


def plan(f):
    PLANS[f.__name__] = f
    return f


_KEY = "concat_ws('|', class, clause, subclause, doc_type, category, CASE WHEN status = '' THEN '-' ELSE status END)"


def targets_sql() -> str:
    """Leaves times the statuses of their document types, and one row without a status for each leaf."""
    leaves = values(leaf_rows(), "class, clause, subclause, doc_type")
    rules = values(status_rows(), "doc_type, nth, status")
    return f"(SELECT class, clause, subclause, doc_type, '' AS status FROM {leaves} l UNION ALL SELECT l.class, l.clause, l.subclause, l.doc_type, s.status FROM {leaves} l JOIN {rules} s ON l.doc_type = s.doc_type)"


def cells_sql(d: Spark) -> str:
    """Targets times categories, with the number of candidates of the group (status has no part in it) and the cell's state."""
    categories = values([(c,) for c in CATEGORIES], "category")
    default = "CASE CAST(1 + id % 8 AS STRING) " + " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in DEFAULT_SUBCLAUSE.items()) + " END"
    counts = f"(SELECT clause, subclause, doc_type, category, count(*) AS n FROM (SELECT CAST(1 + id % 8 AS STRING) AS clause, {default} AS subclause, doc_type, {category(d, 'ordering_agency')} AS category FROM {registry(d)} r WHERE id % 5 <> 3) p GROUP BY clause, subclause, doc_type, category)"
    return f"""(SELECT *, CASE WHEN excluded THEN 'excluded' WHEN candidates = 0 THEN 'fallback_only' ELSE 'matrix_valid' END AS state FROM (
SELECT {_KEY} AS cell_key, t.class, t.clause, t.subclause, t.doc_type, t.category, t.status, coalesce(c.n, 0) AS candidates, t.doc_type = 'press_release' AND t.category = 'research_institute' AS excluded
FROM (SELECT * FROM {targets_sql()} t0 CROSS JOIN {categories} g) t LEFT JOIN {counts} c ON t.clause = c.clause AND t.subclause = c.subclause AND t.doc_type = c.doc_type AND t.category = c.category) x)""".replace("concat_ws('|', class, clause, subclause, doc_type, category, CASE WHEN status = ''", "concat_ws('|', t.class, t.clause, t.subclause, t.doc_type, t.category, CASE WHEN t.status = ''").replace("ELSE status END)", "ELSE t.status END)")


@plan
def coverage_targets(d: Spark) -> str:
    return f"SELECT class, clause, subclause, doc_type, status FROM {targets_sql()} t"


@plan
def coverage_cells(d: Spark) -> str:
    return f"SELECT cell_key, candidates, state FROM {cells_sql(d)} c"


@plan
def candidate_counts(d: Spark) -> str:
    return f"SELECT class, clause, subclause, category, CAST(sum(candidates) AS BIGINT) AS candidates, count(*) AS cells FROM {cells_sql(d)} c WHERE status = '' GROUP BY class, clause, subclause, category"


def shared_out(source: str, group: str, key: str, total: str, weight: str) -> str:
    """Exact totals by largest remainders: floors first, then one more to the largest fractions, ties by key."""
    return f"""(SELECT *, low + CASE WHEN row_number() OVER (PARTITION BY {group} ORDER BY quota - low DESC, {key}) <= total - sum(low) OVER (PARTITION BY {group}) THEN 1 ELSE 0 END AS given FROM (
SELECT *, CAST(floor(quota) AS BIGINT) AS low FROM (SELECT *, {total} AS total, CAST({total} AS DOUBLE) * ({weight}) / sum({weight}) OVER (PARTITION BY {group}) AS quota FROM {source} s1) s2) s3)"""


@plan
def largest_remainders(d: Spark) -> str:
    """Ten thousand shared out to the document types of each source by their number of documents."""
    counts = f"(SELECT source, doc_type, CAST(count(*) AS DOUBLE) AS n FROM {registry(d)} r GROUP BY source, doc_type)"
    return f"SELECT source, doc_type, given FROM {shared_out(counts, 'source', 'doc_type', '10000', 'n')} a"


@plan
def grade_allocation(d: Spark) -> str:
    """A class' target to categories with equal weights; in each a minimum for every cell and the rest by the root of its candidates.

    Roots are rounded to whole thousandths, so that sums do not depend on their order.
    """
    cells = f"(SELECT *, 1000.0 AS one FROM {cells_sql(d)} c0 WHERE NOT excluded)"
    groups = f"(SELECT class, category, count(*) AS cells, 1.0 AS one FROM {cells} c1 GROUP BY class, category)"
    totals = shared_out(groups, "class", "category", "CASE class WHEN 'C' THEN 5000 ELSE 6500 END", "one")
    pool = f"(SELECT c.cell_key, c.class, c.category, c.candidates, g.given - g.cells AS pool, round(sqrt(c.candidates + 1) * 1000) AS w FROM {cells} c JOIN {totals} g ON c.class = g.class AND c.category = g.category)"
    extra = shared_out(pool, "class, category", "cell_key", "pool", "w")
    return f"""SELECT cell_key, 1 + given AS requested, least(1 + given, candidates) AS seeded, 1 + given - least(1 + given, candidates) AS fallback, greatest(0, 1 + given - candidates) AS shortage
FROM {extra} e"""


@plan
def plan_totals(d: Spark) -> str:
    """Totals of the allocation by class, and how much of it lacks candidates."""
    return f"SELECT substr(cell_key, 1, 1) AS class, CAST(sum(requested) AS BIGINT) AS requested, CAST(sum(seeded) AS BIGINT) AS seeded, CAST(sum(fallback) AS BIGINT) AS fallback, CAST(sum(fallback) AS DOUBLE) / CAST(sum(requested) AS DOUBLE) AS fallback_ratio, CAST(sum(CASE WHEN shortage = 0 THEN 1 ELSE 0 END) AS BIGINT) AS supported FROM ({grade_allocation(d)}) g GROUP BY 1"


@plan
def generation_plan(d: Spark) -> str:
    """Each class in a plain and a status pool, one tenth (rounded to even) for statuses, allocated on its own."""
    cells = f"(SELECT *, status = '' AS plain FROM {cells_sql(d)} c0 WHERE NOT excluded)"
    target = "CASE class WHEN 'C' THEN 1005 ELSE 1255 END"
    tenth = d.even(f"({target}) * 0.1")
    total = f"CASE WHEN plain THEN {target} - {tenth} ELSE {tenth} END"
    return f"SELECT cell_key, plain, given AS requested FROM {shared_out(cells, 'class, plain', 'cell_key', total, '1 + candidates')} a"


@plan
def zero_candidate_reduction(d: Spark) -> str:
    """Cells without candidates keep a tenth of their target, at least one."""
    return f"SELECT cell_key, requested, CASE WHEN seeded + shortage > 0 AND seeded = 0 THEN greatest(1, {d.whole('requested', '10')}) ELSE requested END AS reduced FROM ({grade_allocation(d)}) g"


# the label matrix alone is fixed; all others read the tables as well
_FIXED = ("coverage_targets",)
QUERIES = {name: spark_query(f) for name, f in PLANS.items() if name not in _FIXED}
ORACLE = {name: check_sql(PLANS[name]) for name in QUERIES}
