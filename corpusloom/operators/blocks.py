"""Documents as arrays of tagged blocks, walked by higher-order functions.

A block has a ``kind`` and the fields of that kind; the others are null. Text is rendered, atoms are
listed and elements of form are checked without leaving the row, so nothing is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE, stripped
from ..sources.dims import APPROVAL_COLUMNS, BULLETS, DEFAULT_HEADER, DRAFT_BLANKS, HEADER_KEYS

BLOCK = (
    "struct<kind:string,block_id:string,text:string,items:array<string>,entries:array<struct<key:string,value:string>>,"
    "columns:array<string>,rows:array<array<string>>,attachment_id:string,label:string,description:string>"
)
MIN_HEADER = 2
NEEDS_APPROVAL, NEEDS_ATTACHMENT, DRAFT = ("결재진행중", "초안"), ("첨부미등록",), "초안"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _list(c: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(c, F.array().cast(kind))


def _bullet(item: Column) -> Column:
    """A list item behind a dash, unless it brings its own mark with a blank and text behind it."""
    bare = F.ltrim(item, F.lit(WHITE))
    head = F.substring_index(bare, " ", 1)
    rest = stripped(F.substring(bare, F.length(head) + 2, F.length(bare)))
    return F.when(head.isin(*BULLETS) & (rest != ""), item).otherwise(F.concat(F.lit("- "), item))


def rendered(block: Column) -> Column:
    """A block as text; null for a kind that nobody knows."""
    lines = lambda array: F.array_join(array, "\n")
    cells = lambda row: F.array_join(F.transform(row, lambda c: stripped(_text(c))), "\t")
    table = lines(F.concat(F.array(F.array_join(_list(block["columns"]), "\t", "")), F.transform(_list(block["rows"], "array<array<string>>"), cells)))
    attached = F.concat(F.lit("[첨부] "), _text(block["label"]), F.lit(" ("), _text(block["attachment_id"]), F.lit(")"), F.when(_text(block["description"]) != "", F.concat(F.lit(": "), block["description"])).otherwise(""))
    return (
        F.when(block["kind"] == "paragraph", _text(block["text"]))
        .when(block["kind"] == "bullet_list", lines(F.transform(_list(block["items"]), lambda i: _bullet(_text(i)))))
        .when(block["kind"] == "key_value", lines(F.transform(block["entries"], lambda e: F.concat(_text(e["key"]), F.lit(": "), _text(e["value"])))))
        .when(block["kind"] == "table", table)
        .when(block["kind"] == "attachment_reference", attached)
    )


def body_text(blocks: Column) -> Column:
    """The blocks as text, in order, with an empty line between two."""
    return F.array_join(F.transform(blocks, rendered), "\n\n")


def text_atoms(blocks: Column, agency: Column | None = None, slots: Column | None = None, events: Column | None = None, event_dates: bool = False) -> Column:
    """All pieces of text that a rendering must show, in order, without blank ones.

    The agency comes first, then what each block says, then ``slots`` of approval (role, name,
    approved_at) and administrative ``events`` (date, text), whose dates count on request.
    """
    none = F.array().cast("array<string>")

    def said(b: Column) -> Column:
        return (
            F.when(b["kind"] == "paragraph", F.array(b["text"]))
            .when(b["kind"] == "key_value", F.flatten(F.transform(b["entries"], lambda e: F.array(e["key"], e["value"]))))
            .when(b["kind"] == "bullet_list", b["items"])
            .when(b["kind"] == "table", F.concat(_list(b["columns"]), F.flatten(_list(b["rows"], "array<array<string>>"))))
            .when(b["kind"] == "attachment_reference", F.array(b["attachment_id"], b["label"], b["description"]))
        )

    parts = [none if agency is None else F.array(agency), F.flatten(F.transform(blocks, lambda b: F.coalesce(said(b), none)))]
    if slots is not None:
        parts.append(F.coalesce(F.flatten(F.transform(slots, lambda s: F.array(s["role"], s["name"], s["approved_at"].cast("string")))), none))
    if events is not None:
        parts.append(F.coalesce(F.flatten(F.transform(events, lambda e: F.array(e["date"].cast("string") if event_dates else F.lit(""), e["text"]))), none))
    return F.filter(F.concat(*parts), lambda t: stripped(_text(t)) != "")


def form_elements(rows: DataFrame, blocks: str = "blocks", form: str = "document_form", statuses: str = "statuses") -> DataFrame:
    """``rows`` with (has_header, has_approval, has_attachment, missing): what a document of this form should have, and what it lacks, in order.

    Without a form the head of an official letter is expected; the form other brings its own head,
    two entries in its first block. Numbers and dates of drafts must be there and blank, those of
    all others filled. A signature table or an attachment is asked for only where the status rests on it.
    """
    b, kind = F.col(blocks), F.col(form)
    entries = F.flatten(F.transform(F.filter(b, lambda x: x["kind"] == "key_value"), lambda x: x["entries"]))
    keys = lambda names: F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    heads = F.create_map(*(x for name, names in HEADER_KEYS.items() for x in (F.lit(name), keys(names))))
    prepared = rows.select(*rows.columns, F.struct(entries.alias("entries"), F.when(kind.isNull(), keys(DEFAULT_HEADER)).otherwise(heads[kind]).alias("expected"), _list(F.col(statuses)).alias("statuses")).alias("_f"))
    entries, expected, held = F.col("_f.entries"), F.col("_f.expected"), F.col("_f.statuses")
    present = lambda key: F.exists(entries, lambda e: e["key"] == key)
    filled = lambda key: F.exists(entries, lambda e: (e["key"] == key) & (_text(e["value"]) != ""))
    empty = lambda key: F.exists(entries, lambda e: (e["key"] == key) & (_text(e["value"]) == ""))
    other = kind.eqNullSafe("other")
    first = F.get(b, F.lit(0))
    own_head = (first["kind"] == "key_value") & (F.size(first["entries"]) >= MIN_HEADER)
    header = F.coalesce(F.when(other, own_head).otherwise(F.size(F.filter(expected, present)) >= F.least(F.lit(MIN_HEADER), F.size(expected))), F.lit(False))
    absent = F.filter(expected, lambda k: ~present(k))
    no_header = F.when(other, "목록 밖 형식의 첫 key_value 표제부 항목 2개 미만").otherwise(F.concat(F.lit("문서 머리 정보 부족: "), F.array_join(absent, ", ")))
    draft = F.array_contains(held, DRAFT)
    blankable = F.filter(F.when(other, F.filter(keys(DRAFT_BLANKS), present)).otherwise(expected), lambda k: k.isin(*DRAFT_BLANKS))
    told = lambda before, key, behind: F.concat(F.lit(before), key, F.lit(behind))
    of_draft = F.transform(blankable, lambda k: F.when(~present(k), told("초안 표제부 ", k, " 항목 없음")).when(filled(k), told("초안 표제부 ", k, " 값은 공란이어야 함")))
    of_final = F.transform(keys(DRAFT_BLANKS), lambda k: F.when(empty(k), told("확정 문서 표제부 ", k, " 값이 비어 있음")))
    marks = lambda x: F.size(F.filter(keys(APPROVAL_COLUMNS), lambda name: F.contains(F.array_join(_list(x["columns"]), " "), name)))
    approval = F.coalesce(F.exists(b, lambda x: (x["kind"] == "table") & (marks(x) >= 2)), F.lit(False))
    attachment = F.coalesce(F.exists(b, lambda x: x["kind"] == "attachment_reference"), F.lit(False))
    needs = lambda names: F.arrays_overlap(held, keys(names))
    missing = F.concat(
        F.array(F.when(~header, no_header)), F.when(draft, of_draft).otherwise(of_final),
        F.array(F.when(~approval & needs(NEEDS_APPROVAL), "결재란 table block 없음"), F.when(~attachment & needs(NEEDS_ATTACHMENT), "붙임 attachment_reference block 없음")),
    )
    unknown = kind.isNotNull() & ~kind.isin(*HEADER_KEYS)
    missing = F.when(unknown, F.array(F.concat(F.lit("unknown form: "), kind))).otherwise(F.filter(missing, lambda m: m.isNotNull()))
    return prepared.select(*rows.columns, (header & ~unknown).alias("has_header"), approval.alias("has_approval"), attachment.alias("has_attachment"), missing.alias("missing"))
