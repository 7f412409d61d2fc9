"""Contracts between the stages: decision tables, presence and lineage, phrases that may not occur.

Rules are data wherever there are many of them. Every validator gives its first error as text, or
all of them in order, and null or nothing for a row that passes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import written

class DecisionTable:
    """Ordered rules with wildcards over columns of known values, resolved once for every combination.

    A rule is (conditions, outcome): for each column a value or a tuple of values, or nothing, which
    stands for any. The first rule that a combination meets decides. A combination that no rule
    meets, and a rule that decides none, is an error when the table is built, so that applying it
    can't fall through and no rule is dead. Outcome None means that the row passes.
    """

    def __init__(self, domains: Mapping[str, Sequence], rules: Iterable[tuple[Mapping, str | None]]) -> None:
        self.domains = {k: tuple(v) for k, v in domains.items()}
        sets = []
        for when, outcome in rules:
            wanted = {c: set(v if isinstance(v, tuple) else (v,)) for c, v in when.items()}
            stray = [c for c, values in wanted.items() if not values <= set(self.domains.get(c, ()))]
            if stray:
                raise ValueError(f"conditions on unknown columns or values: {stray}")
            sets.append((wanted, outcome))
        self.outcomes: dict[tuple, str | None] = {}
        used = set()
        for combination in itertools.product(*self.domains.values()):
            row = dict(zip(self.domains, combination))
            nth = next((n for n, (wanted, _) in enumerate(sets) if all(row[c] in values for c, values in wanted.items())), None)
            if nth is None:
                raise ValueError(f"no rule for {row}")
            used.add(nth)
            self.outcomes[combination] = sets[nth][1]
        dead = [sets[n] for n in range(len(sets)) if n not in used]
        if dead:
            raise ValueError(f"rules that decide nothing: {dead}")

    def apply(self, rows: DataFrame, outcome: str = "error") -> DataFrame:
        """``rows`` with the outcome of their combination; a value outside its column's domain, or null, is told.

        The table is joined by equality; it has as many rows as there are combinations.
        """
        lower = lambda v: str(v).lower() if isinstance(v, bool) else str(v)
        table = rows.sparkSession.createDataFrame([(*map(lower, c), said) for c, said in self.outcomes.items()], ", ".join(f"_{c} string" for c in self.domains) + ", _outcome string")
        value = {c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in self.domains}
        stray = F.coalesce(*(F.when(~value[c].isin(*map(lower, values)), F.concat(F.lit(f"unknown {c}: "), value[c])) for c, values in self.domains.items()))
        return rows.join(F.broadcast(table), [value[c] == F.col(f"_{c}") for c in self.domains], "left").select(*rows.columns, F.coalesce(stray, F.col("_outcome")).alias(outcome))


# ---------------------------------------------------------------------------------------------- routes

EVIDENCE = ("direct_legal_evidence", "direct_sensitive_span", "contextual_anchor_only", "no_usable_public_source")
#: The evidence that each route needs; mask restoration rests on other records.
ROUTE_EVIDENCE = {"source_aligned": EVIDENCE[0], "span_seeded": EVIDENCE[1], "anchored": EVIDENCE[2], "administrative_augmented": EVIDENCE[2], "fully_synthetic": EVIDENCE[3], "mask_restoration": None}


def route_table() -> DecisionTable:
    """Which plans a route allows, by the class of the source, its evidence, the target and the mode of generation."""
    domains = {"route": tuple(ROUTE_EVIDENCE), "source_class": ("C", "S", "O"), "evidence": EVIDENCE, "has_clause": (True, False), "has_status": (True, False), "mode": ("source_aligned", "counterfactual")}
    rules: list[tuple[Mapping, str | None]] = [({"route": "source_aligned", "source_class": "O"}, "source_aligned route requires a C/S source")]
    rules += [({"route": r, "source_class": ("C", "S")}, f"{r} route requires an O source") for r in ROUTE_EVIDENCE if r != "source_aligned"]
    rules += [({"route": r, "evidence": tuple(e for e in EVIDENCE if e != needed)}, f"{r} route requires {needed}") for r, needed in ROUTE_EVIDENCE.items() if needed]
    rules += [
        ({"route": "mask_restoration", "has_clause": False}, "mask_restoration route requires a legal clause target"),
        ({"route": "administrative_augmented", "has_clause": True}, "administrative_augmented route requires an admin-only target"),
        ({"route": "administrative_augmented", "has_status": False}, "administrative_augmented route requires an admin-only target"),
        ({"route": "fully_synthetic", "has_clause": False}, "admin-only target requires administrative_augmented route"),
        ({"source_class": "O", "mode": "source_aligned"}, "O source requires generation_mode=counterfactual"),
        ({"source_class": ("C", "S"), "mode": "counterfactual"}, "C/S source requires generation_mode=source_aligned"),
        ({}, None),
    ]
    return DecisionTable(domains, rules)


def route_errors(plans: DataFrame) -> DataFrame:
    """``plans`` with ``error``: what the route forbids, or, for a C/S source, that the target isn't the source's own label.

    Columns: route, source_class, evidence, mode, source_clause, source_subclause, target_class,
    target_clause, target_subclause, statuses.
    """
    marked = plans.withColumn("has_clause", F.col("target_clause").isNotNull()).withColumn("has_status", F.coalesce(F.size("statuses") > 0, F.lit(False)))
    ruled = route_table().apply(marked)
    same = F.col("target_class").eqNullSafe(F.col("source_class")) & F.col("target_clause").eqNullSafe(F.col("source_clause")) & F.col("target_subclause").eqNullSafe(F.col("source_subclause"))
    other = F.when(F.col("source_class").isin("C", "S") & ~same, "source_aligned target must exactly match the C/S source label")
    return ruled.select(*plans.columns, F.coalesce(F.col("error"), other).alias("error"))


# ------------------------------------------------------------------------------- presence and lineage


def first_error(*rules: tuple[Column, str | Column]) -> Column:
    """What the first broken rule says."""
    return F.coalesce(*(F.when(broken, F.lit(said) if isinstance(said, str) else said) for broken, said in rules))


def _repeats(array: Column) -> Column:
    return F.size(array) != F.size(F.array_distinct(array))


def assessment_errors(rows: DataFrame, clauses: Mapping[str, str]) -> DataFrame:
    """``rows`` (classification, roles, slots of name and kind, primary, compatible) with ``error``.

    ``clauses`` tells the clause of each subclause; only clauses 5 to 8 are assessed.
    """
    table = F.create_map(*(F.lit(x) for pair in clauses.items() for x in pair))
    candidates = F.concat(F.array("primary"), F.col("compatible"))
    outside = F.exists(candidates, lambda s: ~F.coalesce(F.element_at(table, s) >= "5", F.lit(False)))
    error = first_error(
        (F.col("classification") == "C", "source assessment supports only S/O for clauses 5-8"),
        (_repeats(F.col("roles")), "source subject roles must be unique"),
        (_repeats(F.transform("slots", lambda s: F.struct(s["name"], s["kind"]))), "source slots must be unique by name and kind"),
        (F.array_contains("compatible", F.col("primary")), "primary subclause must not repeat in compatible subclauses"),
        (_repeats(F.col("compatible")), "compatible subclauses must be unique"),
        (outside, "source assessment only supports subclauses in clauses 5-8"),
    )
    return rows.withColumn("error", error)


def provenance_errors(rows: DataFrame) -> DataFrame:
    """``rows`` (route, uses_source, spans, scenario_id, seed_sha256) with ``error``: which fields a route demands and forbids."""
    synthetic, anchored = F.col("route") == "fully_synthetic", F.col("route") == "anchored"
    spans = F.coalesce("spans", F.lit(0)) > 0
    uses = F.coalesce("uses_source", F.lit(False))
    error = first_error(
        (synthetic & (uses | spans), "fully_synthetic provenance cannot use source evidence"),
        (synthetic & F.col("scenario_id").isNull(), "fully_synthetic provenance requires synthetic_scenario_id"),
        (~synthetic & (~uses | ~spans), F.concat("route", F.lit(" provenance requires source evidence"))),
        (~synthetic & F.col("scenario_id").isNotNull(), "synthetic_scenario_id is only allowed for fully_synthetic provenance"),
        (anchored & F.col("seed_sha256").isNull(), "anchored provenance requires a sensitive seed hash"),
        (~anchored & F.col("seed_sha256").isNotNull(), "sensitive seed hash is only allowed for anchored provenance"),
    )
    return rows.withColumn("error", error)


#: Parts of a result that rest on others: part, what it needs, and how that is said.
PRESENCE = (
    ("generation_plan", ("source_assessment",), "generation plan requires source assessment"),
    ("generation_artifact", ("generation_plan",), "generation artifact requires generation plan"),
    ("consistency_assessment", ("generation_artifact",), "consistency assessment requires a generation artifact"),
    ("classification_receipt", ("source_assessment",), "classification receipt requires source assessment"),
    ("generation_receipt", ("generation_artifact",), "generation receipt requires generation artifact"),
    ("validation_receipt", ("consistency_assessment",), "validation receipt requires consistency assessment"),
    ("comparison", ("generation_plan", "consistency_assessment"), "comparison requires a successful consistency validation"),
)
#: What a result without a failure must have; the receipt of the generation depends on the route.
COMPLETE = ("source_assessment", "generation_plan", "generation_artifact", "consistency_assessment", "classification_receipt", "validation_receipt", "comparison")


def presence_errors(rows: DataFrame, result: str = "result", route: str = "route") -> DataFrame:
    """``rows`` with ``error``: a partly filled result (a struct of the parts above and ``failure``) must not have a part without what it rests on, and must be whole unless it failed."""
    has = lambda part: F.col(f"{result}.{part}").isNotNull()
    lacks = lambda parts: F.array_size(F.filter(F.array(*(has(p) for p in parts)), lambda x: ~x)) > 0
    failed = has("failure")
    rules = [(has(part) & (lacks(needs) | (failed if part == "comparison" else F.lit(False))), said) for part, needs, said in PRESENCE]
    rules.append((~failed & lacks(COMPLETE), "successful pipeline result requires classification, generation, validation, and comparison"))
    rules.append((~failed & ~F.col(route).eqNullSafe("fully_synthetic") & ~has("generation_receipt"), "source-referenced generation requires a generation receipt"))
    return rows.withColumn("error", first_error(*rules))


def attempt_errors(attempts: DataFrame) -> DataFrame:
    """``attempts`` (sha256, plan_sha256, attempt_index, parent_sha256, repair_codes) with ``error``: every attempt goes back to a first one of its plan.

    An attempt has its own rules (only the first has neither parent nor repair codes), and its
    parent must be the attempt before it, of the same plan. A link that holds both lowers the index
    by one, so chains without an error end at the first attempt and have no cycle. An attempt whose
    own link is fine but whose ancestors' isn't is a *broken chain*; ancestors are found by
    doubling, in as many rounds as the highest index has bits. A hash of two attempts is an error of both.
    """
    index, parent, codes = F.col("attempt_index"), F.col("parent_sha256"), F.coalesce("repair_codes", F.array().cast("array<string>"))
    before = attempts.groupBy(F.col("sha256").alias("_sha")).agg(F.count(F.lit(1)).alias("_n"), F.min("attempt_index").alias("_index"), F.min("plan_sha256").alias("_plan"))
    own = attempts.join(before.select(F.col("_sha").alias("_own"), F.col("_n").alias("_same")), F.col("sha256") == F.col("_own"), "left").join(before, parent == F.col("_sha"), "left")
    local = first_error(
        (_repeats(codes), "generation repair codes must be unique"),
        (index.isNull() | (index < 1), "attempts count from 1"),
        ((index == 1) & (parent.isNotNull() | (F.size(codes) > 0)), "first generation attempt cannot have a parent or repair codes"),
        ((index > 1) & (parent.isNull() | (F.size(codes) == 0)), "retry generation attempts require a parent hash and repair codes"),
        (F.col("_same") > 1, "hash of several attempts"),
        ((index > 1) & F.col("_n").isNull(), "unknown parent"),
        ((index > 1) & ~F.col("_plan").eqNullSafe(F.col("plan_sha256")), "parent of another plan"),
        ((index > 1) & (F.col("_index") != index - 1), "parent is not the attempt before"),
    )
    ruled = written(own.select(*attempts.columns, local.alias("_local")), "attempts")
    links = ruled.groupBy("sha256").agg(F.bool_or(F.col("_local").isNotNull()).alias("bad"), F.max("parent_sha256").alias("up"))
    highest = ruled.agg(F.max("attempt_index")).first()[0] or 0
    for _ in range(int(min(highest, 1 << 30)).bit_length()):
        above = links.select(F.col("sha256").alias("_up"), F.col("bad").alias("_bad"), F.col("up").alias("_above"))
        links = written(links.join(above, F.col("up") == F.col("_up"), "left").select("sha256", (F.col("bad") | F.coalesce("_bad", F.lit(False))).alias("bad"), F.col("_above").alias("up")), "lineage")
    broken = links.where("bad").select(F.col("sha256").alias("_broken"))
    joined = ruled.join(broken, F.col("sha256") == F.col("_broken"), "left")
    return joined.select(*attempts.columns, F.coalesce("_local", F.when(F.col("_broken").isNotNull(), "broken chain")).alias("error"))


# -------------------------------------------------------------------------------------------- phrases


def phrase_violations(rows: DataFrame, phrases: DataFrame, variants: DataFrame, overrides: DataFrame, template: str = "template_id", status: str = "document_status", body: str = "body_text") -> DataFrame:
    """``rows`` with ``violations``: what the text must not say, in order.

    ``phrases`` (owner, nth, phrase) are forbidden by a template or a status. ``variants`` (status,
    applies_to) names the statuses that change a template's phrases, and the templates they may be
    used with, null for all; used with another one, that is itself the violation and the template's
    own phrases hold. Else the status's phrases come first, then the template's but for the
    ``overrides`` (status, phrase). A status that nobody knows changes nothing.

    The set of phrases of each (template, status) is made from these small relations; a row then
    looks for all of its set in one pass over its array.
    """
    pairs = rows.select(F.col(template).alias("_t"), F.col(status).alias("_s")).distinct()
    known = pairs.join(variants.select(F.col("status").alias("_v"), "applies_to"), F.col("_s") == F.col("_v"), "left")
    misused = F.col("_v").isNotNull() & F.col("applies_to").isNotNull() & ~F.coalesce(F.array_contains("applies_to", F.col("_t")), F.lit(False))
    known = known.select("_t", "_s", misused.alias("_misused"), (F.col("_v").isNotNull() & ~misused).alias("_used"), F.array_join("applies_to", ", ").alias("_applies"))
    owned = phrases.select("owner", "nth", "phrase")
    of_status = known.where("_used").join(owned, F.col("owner") == F.col("_s")).select("_t", "_s", F.lit(0).alias("part"), "nth", "phrase")
    of_template = known.join(owned, F.col("owner") == F.col("_t")).select("_t", "_s", "_used", F.lit(1).alias("part"), "nth", "phrase")
    lifted = overrides.select(F.col("status").alias("_o"), F.col("phrase").alias("_lifted"))
    of_template = of_template.join(lifted, F.col("_used") & (F.col("_s") == F.col("_o")) & (F.col("phrase") == F.col("_lifted")), "left_anti").drop("_used")
    sets = of_status.unionByName(of_template).groupBy(F.col("_t").alias("_ts"), F.col("_s").alias("_ss")).agg(F.array_sort(F.collect_list(F.struct("part", "nth", "phrase"))).alias("_set"))
    known = known.join(sets, F.col("_t").eqNullSafe(F.col("_ts")) & F.col("_s").eqNullSafe(F.col("_ss")), "left").select("_t", "_s", "_misused", "_applies", "_set")
    joined = rows.join(known, F.col(template).eqNullSafe(F.col("_t")) & F.col(status).eqNullSafe(F.col("_s")), "left")
    text, named = F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(template), F.lit(""))
    said = F.transform(
        F.filter(F.coalesce("_set", F.array().cast("array<struct<part:int,nth:int,phrase:string>>")), lambda p: F.contains(text, p["phrase"])),
        lambda p: F.when(p["part"] == 0, F.concat(F.lit("["), named, F.lit("/"), status, F.lit("] "), p["phrase"])).otherwise(F.concat(F.lit("["), named, F.lit("] "), p["phrase"])),
    )
    wrong = F.when(F.col("_misused"), F.array(F.concat(F.lit("["), named, F.lit("] "), status, F.lit(" applies to "), "_applies")))
    return joined.select(*rows.columns, F.concat(F.coalesce(wrong, F.array().cast("array<string>")), said).alias("violations"))
