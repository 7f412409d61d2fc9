"""What may be disclosed, kept or named: rules on a row's own columns, as Columns and functions of tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..sources.dims import CONFLICTING_SUBCLAUSES, GRADE_BASES, GRADE_NAMES, GRADE_POSITIONS, GRADE_RANKS, HIGHER_GRADES, NATIVE_SUBCLAUSES, SCENARIO_FIELDS

#: Days after the production in which a grade may have been changed.
MOST_DAYS = 730
#: Blocks of a selection at most.
MOST_BLOCKS = 40


def commits(status: Column, route: Column, verdict: Column, weak_masks: bool = False) -> Column:
    """Whether a result becomes a row: it must be accepted, and if it was restored from masks its verdict must accept it, too.

    ``weak_masks`` keeps accepted restorations whatever their verdict. A missing status never
    commits, nor does a missing verdict on the mask route.
    """
    accepted = F.coalesce(status == "accepted_s", F.lit(False))
    if weak_masks:
        return accepted
    return accepted & (~route.eqNullSafe(F.lit("mask_restoration")) | F.coalesce(verdict == "accepted_s", F.lit(False)))


def _hash(key: Column, salt: str) -> Column:
    """A number of 60 bits that follows from a key, for choices that reruns repeat."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt + "/"), key.cast("string")), 256), 1, 15), 16, 10).cast("long")


def pick(values: Column, key: Column, salt: str) -> Column:
    """One of an array's values, by the hash of a key; null for an empty array."""
    return F.when(F.size(values) > 0, F.get(values, (_hash(key, salt) % F.size(values)).cast("int")))


def grade_histories(rows: DataFrame, today: str, ratio: float, key: str = "id", grade: str = "grade", produced: str = "produced", most_days: int = MOST_DAYS) -> DataFrame:
    """(key, old_grade, basis_text, changed_on, position, rank, name) of the share ``ratio`` of rows that once had a higher grade.

    The change lies 1 to ``most_days`` days behind the production and not after ``today``. The
    highest grade, unknown ones, and rows of today or without a date have no history.
    """
    k = F.col(key)
    above = F.create_map(*(x for g, higher in HIGHER_GRADES.items() for x in (F.lit(g), F.array(*map(F.lit, higher)) if higher else F.array().cast("array<string>"))))[F.col(grade)]
    now = F.lit(today).cast("date")
    chosen = rows.where((F.size(above) > 0) & (F.col(produced) < now) & (_hash(k, "history") / F.lit(float(1 << 60)) < ratio))
    days = F.least(F.lit(most_days), F.datediff(now, F.col(produced)))
    of = lambda values, salt: pick(F.array(*map(F.lit, values)), k, salt)
    return chosen.select(
        key, pick(above, k, "grade").alias("old_grade"), of(GRADE_BASES, "basis").alias("basis_text"), F.date_add(produced, (1 + _hash(k, "day") % days).cast("int")).alias("changed_on"),
        of(GRADE_POSITIONS, "position").alias("position"), of(GRADE_RANKS, "rank").alias("rank"), of(GRADE_NAMES, "name").alias("name"),
    )


def _alone(pattern: str) -> str:
    return rf"(?<![\p{{L}}\p{{N}}_]){pattern}(?![\p{{L}}\p{{N}}_])"


RESIDENT, PHONE, BIRTH, ACCOUNT = (_alone(p) for p in (r"\d{6}-[1-4]\d{6}", r"01[016789]-\d{3,4}-\d{4}", r"(?:19|20)\d{2}-\d{2}-\d{2}", r"\d{3}-\d{2,4}-\d{4,6}"))


def missing_values(body: Column, scenario: Column) -> Column:
    """What a text on personal data lacks for its scenario (null: 0): real values, not words about them."""
    text, n = F.coalesce(body, F.lit("")), F.coalesce(scenario, F.lit(0))
    field = F.create_map(*(F.lit(x) for pair in SCENARIO_FIELDS.items() for x in pair))[n.cast("int")]
    rules = F.array(
        F.when(n.isin(1, 3) & ~text.rlike(BIRTH), "생년월일 실제 값이 없음").when(~n.isin(1, 3) & ~text.rlike(RESIDENT), "주민등록번호 형식의 합성 값이 없음"),
        F.when(n.isin(0, 1) & ~text.rlike(PHONE), "개인 연락처 실제 값이 없음"),
        F.when(n.isin(1, 4) & ~text.rlike(ACCOUNT), "계좌번호 실제 값이 없음"),
        F.when(~F.contains(text, field), F.concat(F.lit("시나리오 필수 필드 '"), field, F.lit("'가 없음"))),
    )
    return F.filter(rules, lambda r: r.isNotNull())


def agencies(rows: DataFrame, pools: DataFrame, listed: DataFrame, key: str = "id", clause: str = "clause_no", scenario: str = "scenario") -> DataFrame:
    """``rows`` with (agency, error): one of the scenario's agencies, else one of the clause's, else an error.

    ``pools`` (clause_no, scenarios) has an array of agencies for each scenario of a clause, which
    repeat; ``listed`` (clause_no, agencies) those of whole clauses. No scenario, no pools and an empty pool
    all fall back to the clause. An agency is never made up.
    """
    own = pools.select(F.col("clause_no").alias("_p"), "scenarios")
    every = listed.select(F.col("clause_no").alias("_l"), F.col("agencies").alias("_every"))
    joined = rows.join(own, F.col(clause) == F.col("_p"), "left").join(every, F.col(clause) == F.col("_l"), "left")
    n = F.col(scenario)
    pool = F.when(n.isNotNull() & (F.size("scenarios") > 0), F.get("scenarios", F.pmod(n, F.size("scenarios")).cast("int")))
    pool = F.coalesce(F.when(F.size(pool) > 0, pool), F.when(F.size("_every") > 0, F.col("_every")))
    agency = pick(pool, F.col(key), "agency")
    return joined.select(*rows.columns, agency.alias("agency"), F.when(agency.isNull(), F.concat(F.lit("no agency for clause "), F.coalesce(F.col(clause), F.lit("null")))).alias("error"))


def military_content(rows: DataFrame, tagged: DataFrame, exempt: Collection[str], clause: str = "clause_no", scenario: str = "scenario", agency: str = "agency") -> DataFrame:
    """``rows`` with ``military``: whether the scenario is one of the clause's tagged ones (clause_no, scenario) and the agency isn't marked by its grades anyway."""
    marks = tagged.select(F.col("clause_no").alias("_c"), F.col("scenario").alias("_s")).distinct()
    joined = rows.join(marks, (F.col(clause) == F.col("_c")) & (F.col(scenario) == F.col("_s")), "left")
    free = F.coalesce(F.col(agency).isin(*exempt), F.lit(False)) if exempt else F.lit(False)
    return joined.select(*rows.columns, (F.col("_c").isNotNull() & ~free).alias("military"))


def content_descriptions(rows: DataFrame, points: DataFrame, clause: str = "clause_no", subclause: str = "subclause", doc_type: str = "doc_type") -> DataFrame:
    """``rows`` with ``description``: what a text of this leaf is about, from ``points`` (clause_no, subclause, doc_type, core, secondary); null where nothing is declared."""
    known = points.select(F.trim("clause_no").alias("_c"), F.col("subclause").alias("_s"), F.col("doc_type").alias("_t"), F.array_join("core", "·").alias("_core"), F.array_join("secondary", "·").alias("_more"))
    joined = rows.join(known, (F.trim(clause) == F.col("_c")) & (F.col(subclause) == F.col("_s")) & (F.col(doc_type) == F.col("_t")), "left")
    core = F.concat(F.lit("핵심 비공개 사유로 '"), "_core")
    both = F.concat(core, F.lit("'를 다루고, '"), "_more", F.lit("'는 부수적으로만 곁들여라."))
    return joined.select(*rows.columns, F.when(F.coalesce("_more", F.lit("")) != "", both).otherwise(F.concat(core, F.lit("'를 다뤄라."))).alias("description"))


def finalized_selections(answers: DataFrame, current: DataFrame, candidates: DataFrame, method: str = "front_relevance", most: int = MOST_BLOCKS) -> DataFrame:
    """(doc_id, error, pages, block_ids, selection_sha256) of answers (doc_id, source_sha256, config_sha256, block_ids).

    ``current`` (doc_id, source_sha256, config_sha256, config) is what is true now, ``candidates``
    (doc_id, pos, page_number, block_id, text) what could be chosen. An answer to another source or
    configuration is void. Answers with more than ``most`` ids, unknown ids or none are errors; only
    the others are looked up, so no more than ``most`` blocks of a document ever meet. Ids come back
    in the order of the source, with the digest of all that the selection rests on.
    """
    now = current.select(F.col("doc_id").alias("_d"), F.col("source_sha256").alias("_source"), F.col("config_sha256").alias("_sha"), "config")
    joined = answers.join(now, F.col("doc_id") == F.col("_d"), "left")
    said = lambda broken, text: F.when(broken, F.lit(text))
    first = F.coalesce(
        said(F.col("_d").isNull(), "unknown document"), said(~F.col("source_sha256").eqNullSafe(F.col("_source")), "source changed"), said(~F.col("config_sha256").eqNullSafe(F.col("_sha")), "selection config changed"),
        F.when(F.size("block_ids") > most, F.concat(F.lit("selected "), F.size("block_ids").cast("string"), F.lit(f" blocks; maximum is {most}"))),
    )
    ruled = joined.select("doc_id", "_source", "config", first.alias("_first"), "block_ids")
    asked = ruled.where("_first IS NULL").select("doc_id", F.explode(F.array_distinct("block_ids")).alias("_id"))
    known = candidates.select(F.col("doc_id").alias("_c"), "pos", "page_number", "block_id", "text")
    met = asked.join(known, (F.col("doc_id") == F.col("_c")) & (F.col("_id") == F.col("block_id")), "left").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("block_id").isNull(), F.col("_id")))).alias("unknown"),
        F.array_sort(F.collect_list(F.when(F.col("block_id").isNotNull(), F.struct("pos", "page_number", "block_id", "text")))).alias("found"),
    )
    both = ruled.join(met.withColumnRenamed("doc_id", "_m"), F.col("doc_id") == F.col("_m"), "left")
    error = F.coalesce("_first", F.when(F.size("unknown") > 0, F.concat(F.lit("unknown block IDs: "), F.array_join("unknown", ", "))), F.when(F.coalesce(F.size("found"), F.lit(0)) == 0, "no usable blocks"))
    payload = F.struct(
        F.col("doc_id").alias("source_document_id"), F.col("_source").alias("source_sha256"), F.col("config").alias("selection_config"), F.lit(method).alias("method"),
        F.transform("found", lambda b: F.struct(b["page_number"].alias("page_number"), b["block_id"].alias("block_id"), b["text"].alias("text"))).alias("selected_blocks"),
    )
    made = both.select("doc_id", error.alias("error"), "found", payload.alias("_payload"))
    fine = F.col("error").isNull()
    digest = J.canonical_digest(F.when(fine, F.col("_payload")), made.schema["_payload"].dataType)
    return made.select(
        "doc_id", "error", F.when(fine, F.array_sort(F.array_distinct(F.transform("found", lambda b: b["page_number"])))).alias("pages"),
        F.when(fine, F.transform("found", lambda b: b["block_id"])).alias("block_ids"), F.when(fine, digest).alias("selection_sha256"),
    )


#: The subclauses that texts are generated for.
TARGET_SUBCLAUSES = NATIVE_SUBCLAUSES["meeting_minutes"]


def form_levels(rows: DataFrame, form: str = "document_form", subclause: str = "subclause") -> DataFrame:
    """``rows`` with (level, error): how well a document form carries a subclause: *conflict* before *native*, else *bridge*; unknown forms and subclauses are errors."""
    table = lambda of: F.create_map(*(x for name, subs in of.items() for x in (F.lit(name), F.array(*map(F.lit, subs)) if subs else F.array().cast("array<string>"))))[F.col(form)]
    error = F.when(~F.coalesce(F.col(form).isin(*NATIVE_SUBCLAUSES), F.lit(False)), F.concat(F.lit("unknown form: "), F.coalesce(form, F.lit("null")))).when(
        ~F.coalesce(F.col(subclause).isin(*TARGET_SUBCLAUSES), F.lit(False)), F.concat(F.lit("unsupported subclause: "), F.coalesce(subclause, F.lit("null")))
    )
    level = F.when(F.array_contains(table(CONFLICTING_SUBCLAUSES), F.col(subclause)), "conflict").when(F.array_contains(table(NATIVE_SUBCLAUSES), F.col(subclause)), "native").otherwise("bridge")
    return rows.select(*rows.columns, F.when(error.isNull(), level).alias("level"), error.alias("error"))
