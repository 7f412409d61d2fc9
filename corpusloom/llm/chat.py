r"""Chat formatting over each conversation's turns, in DataFrame functions only: running sums place the segments, a fold runs the machine.

A declarative template names the labels of roles, the marks around a turn, the transitions that a
finite-state machine allows between roles, and the roles that carry loss. Turns are escaped,
marked and joined; every segment of the output carries its loss flag. Texts are escaped
reversibly: a backslash is doubled, and a backslash is put after the first character of every
control string, so that no control string survives inside a text.

Scale: one exchange by conversation, and work in proportion to its length. A conversation is one training example and must stand in one
row, so its turns meet in one task; nothing else is gathered.

Defined results: a null text or role counts as empty; turns are ordered by (turn, role, text) with
nulls first, so ties and repeated rows keep a fixed order; an unknown role is written in
hexadecimal digits and makes the conversation invalid; a null conversation id is a conversation of
its own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Characters of the output that are looked through to find a place in it.
PIECE = 4096


@dataclass(frozen=True)
class ChatTemplate:
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    open_turn: str = "### "
    close_label: str = ":\n"
    close_turn: str = "</turn>\n"
    #: Besides the marks themselves; at least two characters each, none a backslash.
    control: tuple[str, ...] = ("</turn>", "### ")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state>role pairs; the state is the last role, at first "start".
    allowed: tuple[str, ...] = ("start>system", "start>user", "system>user", "user>assistant", "assistant>user")

    def __post_init__(self) -> None:
        if any(len(c) < 2 or "\\" in c for c in self.control) or not any(c in self.close_turn for c in self.control):
            raise ValueError("control strings have two characters or more, no backslash, and cover the turn's end")


def escaped(text: Column, template: ChatTemplate) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.control)
    return F.regexp_replace(text, f"({heads})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _label(role: Column, template: ChatTemplate) -> Column:
    label = F.concat(F.lit("Role-"), F.hex(role))
    for name, shown in template.labels.items():
        label = F.when(role == name, F.lit(shown)).otherwise(label)
    return label


def _role(label: Column, template: ChatTemplate) -> Column:
    role = F.decode(F.unhex(F.regexp_replace(label, "^Role-", "")), "UTF-8")
    for name, shown in template.labels.items():
        role = F.when(label == shown, F.lit(name)).otherwise(role)
    return role


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, formatted, segments, valid, bad_turn): segments are struct(start, length, role, loss) over code points.

    ``bad_turn`` is the index of the first turn that the machine does not allow, null if valid.
    """
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    said = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text"))
    said = said.withColumn("head", F.concat(F.lit(template.open_turn), _label(F.col("role"), template), F.lit(template.close_label))).withColumn("body", escaped(F.col("text"), template))
    # where each turn begins, as a running sum over the conversation's turns
    size = F.length("head") + F.length("body") + len(template.close_turn)
    before = W.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    said = said.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))
    shown = said.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "start", "head", "body"))).alias("said"))
    formatted = F.concat_ws("", F.transform("said", lambda t: F.concat(t["head"], t["body"], F.lit(template.close_turn))))
    segments = F.transform(
        "said",
        lambda t: F.struct((t["start"] + F.length(t["head"])).alias("start"), F.length(t["body"]).cast("long").alias("length"), t["role"].alias("role"), t["role"].isin(*template.loss_roles).alias("loss")),
    )
    # the machine: its state is the last role, or "error" for good; it notes the first bad turn
    begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"))
    machine = F.aggregate(
        "said",
        begin,
        lambda acc, t: F.struct(
            F.when(F.concat(acc["state"], F.lit(">"), t["role"]).isin(*template.allowed), t["role"]).otherwise(F.lit("error")).alias("state"),
            (acc["seen"] + 1).alias("seen"),
            F.coalesce(acc["bad"], F.when(~F.concat(acc["state"], F.lit(">"), t["role"]).isin(*template.allowed), acc["seen"])).alias("bad"),
        ),
        lambda acc: acc["bad"],
    )
    return shown.select(F.col("conv").alias(conv), formatted.alias("formatted"), segments.alias("segments"), machine.alias("bad_turn")).withColumn("valid", F.col("bad_turn").isNull())


def read_chats(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> Column:
    """Array of struct(role, text), parsed from the column ``formatted`` alone."""
    pieces = F.split(F.regexp_replace("formatted", re.escape(template.close_turn) + r"\z", ""), re.escape(template.close_turn), -1)
    opened = re.escape(template.open_turn) + "([^\n]*)" + re.escape(template.close_label)
    return F.transform(
        pieces,
        lambda p: F.struct(
            _role(F.regexp_extract(p, f"^{opened}", 1), template).alias("role"),
            unescaped(F.regexp_replace(p, f"^{opened}", "")).alias("text"),
        ),
    )


def under_loss(pieces: Column, segments: Column) -> Column:
    """The text under the loss mask: each segment with loss, unescaped. ``pieces`` are the output in PIECE characters each, so that a segment is cut from near its place."""

    def cut(s: Column) -> Column:
        first, inside = F.floor(s["start"] / PIECE), s["start"] % PIECE
        near = F.concat_ws("", F.slice(pieces, (first + 1).cast("int"), (F.floor((inside + s["length"]) / PIECE) + 1).cast("int")))
        return unescaped(F.substring(near, (inside + 1).cast("int"), s["length"].cast("int")))

    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), cut))


def op1_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    probe = functools.reduce(
        DataFrame.unionByName,
        (spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))),
    )
    out = format_chats(turns.unionByName(probe))
    pieces = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    read = out.select("conv_id", "formatted", "segments", "valid", "bad_turn", read_chats(out).alias("turns"), pieces.alias("pieces"))
    every = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    read = read.withColumn("learned", under_loss(F.col("pieces"), F.col("segments")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
        replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS body,
        CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE concat('Role-', hex(role)) END AS label FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(concat('### ', label, ':', chr(10), body, '</turn>', chr(10))))::BIGINT AS formatted_chars,
  bool_and(concat(before, '>', role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')) AS valid
FROM e GROUP BY conv_id
"""
