"""Types of documents, told from payloads of any shape, and how types are rendered.

A payload is JSON text. Nothing is taken for granted: it may be malformed, no object, lack any
step, or hold a list where an object is expected. What isn't there counts as missing, never fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.text import stripped
from ..sources.dims import FORM_TYPES, GUIDE_WORDS, REMOVED_TYPES, RENDERERS, RESEARCH_WORDS, STATUS_WORDS


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return F.array_size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))) > 0


def _typed(kind: str, reason: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"))


def _cascade(*rules: tuple[Column, str, str]) -> Column:
    """(kind, reason) of the first rule that holds, else null."""
    return F.coalesce(*(F.when(holds, _typed(kind, reason)) for holds, kind, reason in rules))


def _words_of(value: Column) -> Column:
    """A stripped string that isn't blank, else null."""
    text = stripped(J.said(value))
    return F.when(text != "", text)


def resolve_types(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """``rows`` with (document_type, type_source, document_form, reason).

    An explicit type wins even if it is invalid: it stays as it is if a string, else null, for a
    later check to refuse. Without one the document's form decides, with the title and the first two
    paragraphs where a form has several types. Forms are stated in up to three places: that of the
    result's classification before the payload's provenance before the result's provenance; the
    reason tells which other forms lost. A form that nobody knows, or none, gives no type.
    """
    doc = F.col("_doc")  # parsed once
    form = lambda path: _words_of(J.at(doc, f"$.{path}.document_form"))
    explicit = J.at(doc, "$.result.source_classification.document_type")
    blocks = J.items(J.at(doc, "$.result.generated_document.blocks"))
    paragraphs = F.filter(F.transform(F.filter(blocks, lambda b: J.said(J.at(b, "$.kind")) == "paragraph"), lambda b: _words_of(J.at(b, "$.text"))), lambda t: t.isNotNull())
    read = rows.withColumn("_doc", F.try_parse_json(F.col(payload))).select(
        *rows.columns,
        F.struct(
            explicit.isNotNull().alias("stated"), J.said(explicit).alias("explicit"),
            form("provenance").alias("top"), form("result.source_classification").alias("own"), form("result.provenance").alias("result"),
            F.coalesce(_words_of(J.at(doc, "$.result.generated_document.title")), F.lit("")).alias("title"),
            F.coalesce(F.array_join(F.slice(paragraphs, 1, 2), "\n"), F.lit("")).alias("lead"),
        ).alias("_p"),
    )
    p = lambda name: F.col(f"_p.{name}")
    chosen = F.coalesce(p("own"), p("top"), p("result"))
    lost = F.array_sort(F.array_distinct(F.filter(F.array(p("top"), p("result")), lambda f: f != p("own"))))
    conflict = F.when(p("own").isNotNull() & (F.size(lost) > 0), F.concat(F.lit("document_form conflict: used result.source_classification over "), F.array_join(lost, ", "))).when(
        p("own").isNull() & p("top").isNotNull() & (p("result") != p("top")), F.concat(F.lit("document_form conflict: used top-level provenance over "), p("result"))
    )
    title, lead = p("title"), p("lead")
    contains = lambda word: F.contains(title, F.lit(word))
    bid = (
        (contains("사전규격"), "pre_spec_notice", "title:사전규격"),
        (contains("재공고"), "bid_renotice", "title:재공고"),
        (contains("공모"), "public_offering", "title:공모"),
        (contains("입찰공고") | contains("공고문"), "bid_notice", "title:입찰공고"),
        (F.contains(lead, F.lit("입찰공고 자료")), "bid_notice", "lead:입찰공고 자료"),
    )
    rule = tuple((contains(word), kind, f"title:{word}") for word, kind in (("고시", "notification"), ("훈령", "directive"), ("예규", "regulation")))
    policy = ((contains("질의회시") | contains("질의·회시"), "interpretation_compilation", "title:질의회시"), (_has(title, GUIDE_WORDS), "guide", "guide keyword"))
    always = F.lit(True)
    status = (_has(title, STATUS_WORDS), "status_report", "status keyword")
    by_form = {
        "report": _cascade((_has(title, RESEARCH_WORDS), "research_report", "research keyword"), status, (always, "status_report", "generic report")),
        "bid_material": _cascade(*bid, (always, "official_document", "bid subtype is not explicit in generated content")),
        "policy_material": _cascade(*policy, (always, "policy_material", "generic policy material")),
        "administrative_rule": _cascade(*rule, (always, "official_document", "administrative-rule subtype is not explicit in title")),
        "other": _cascade(
            (contains("회의록"), "meeting_minutes", "title:회의록"), (contains("보도자료"), "press_release", "title:보도자료"), *rule, *policy, *bid,
            (contains("보고서") & _has(F.concat_ws("\n", title, lead), RESEARCH_WORDS), "research_report", "report research keyword"), status,
            (contains("검토안") | contains("검토자료"), "research_report", "title:검토"), (always, "official_document", "ambiguous other form"),
        ),
    }
    by_form |= {name: _typed(kind, f"document_form:{name}") for name, kind in FORM_TYPES.items()}
    inferred = F.coalesce(*(F.when(chosen == name, kind) for name, kind in by_form.items()))
    noted = lambda reason: F.concat_ws("; ", reason, conflict)
    out = lambda kind, source, reason: F.struct(kind.alias("document_type"), F.lit(source).alias("type_source"), reason.alias("reason"))
    none = F.lit(None).cast("string")
    resolved = (
        F.when(p("stated"), out(p("explicit"), "explicit", noted(F.lit("result.source_classification.document_type"))))
        .when(chosen.isNull(), out(none, "unclassified", F.lit("document_form and explicit document_type are missing")))
        .when(inferred.isNull(), out(none, "unclassified", F.concat(F.lit("unknown document_form:"), chosen)))
        .otherwise(out(inferred["kind"], "inferred", noted(inferred["reason"])))
    )
    found = read.select(*rows.columns, resolved.alias("_r"), chosen.alias("document_form"))
    return found.select(*rows.columns, "_r.document_type", "_r.type_source", "document_form", "_r.reason")


def renderers(rows: DataFrame, document_type: str = "document_type") -> DataFrame:
    """``rows`` with (renderer_family, display_label, render_error).

    Without a type a document is rendered as an official one without a label; a removed or unknown
    type is an error, never a silent fallback.
    """
    kind = F.col(document_type)
    table = lambda i: F.create_map(*(F.lit(x) for name, spec in RENDERERS.items() for x in (name, spec[i])))[kind]
    error = F.when(kind.isin(*REMOVED_TYPES), "removed").when(kind.isNotNull() & ~kind.isin(*RENDERERS), "unsupported")
    return rows.select(
        *rows.columns,
        F.when(kind.isNull(), "official_document").otherwise(table(0)).alias("renderer_family"),
        F.when(kind.isNull(), "").otherwise(table(1)).alias("display_label"),
        error.alias("render_error"),
    )
