"""Chat formatting: a state machine over roles, and a template that says which segments bear loss (native).

Control strings inside texts are escaped, so a formatted conversation reads back to the same turns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import table, text_or_empty


@dataclass(frozen=True)
class Template:
    """Turn markers, which roles' texts bear loss, and which role may follow which state.

    A state is the role of the turn before, or ``start``. ``final`` lists the states a valid
    conversation ends in; roles that the table does not name lead to ``invalid``.
    """

    begin: str = "### "
    after_role: str = ":\n"
    end: str = "</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    follows: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("user", "assistant")

    def escapes(self) -> list[tuple[str, str]]:
        """Control strings and what stands for them; the backslash comes first, then the longest."""
        return [("\\", "\\\\"), (self.end.rstrip("\n"), "\\e"), (self.begin, "\\h"), ("\n", "\\n")]


DEFAULT = Template()


def _escape(text: Column, template: Template, line_ends: bool) -> Column:
    for control, stand_in in template.escapes():
        if control != "\n" or line_ends:
            text = F.replace(text, F.lit(control), F.lit(stand_in))
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    """Inverse of the escaping: pairs of backslashes split the text, other stand-ins lie between them."""

    def restore(part: Column) -> Column:
        for control, stand_in in template.escapes()[1:]:
            part = F.replace(part, F.lit(stand_in), F.lit(control))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), restore), "\\")


def _state(roles: Column, template: Template) -> Column:
    """State after the last role; ``invalid`` once a role may not follow."""

    def step(state: Column, role: Column) -> Column:
        allowed = F.lit(False)
        for before, after in template.follows.items():
            allowed = allowed | ((state == before) & role.isin(*after))
        return F.when(F.coalesce(allowed, F.lit(False)), role).otherwise("invalid")

    return F.aggregate(roles, F.lit("start"), step)


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, formatted, loss_spans.

    ``formatted`` joins one segment per marker and text; ``loss_spans`` lists start and length in
    code points of the texts under loss. Turns go by turn number, then role, then text, nulls
    first, so ties and repeated rows have a fixed place and all of them stay. A null role or text is
    empty; rows without a conv_id form one conversation without an id. A conversation without a
    valid order of roles is formatted like any other and marked. Other columns are ignored. An empty
    table gives no rows.

    A conversation is one output row, so its turns meet in one task by definition.
    """
    rows = turns.select("conv_id", "turn", text_or_empty(turns["role"]).alias("role"), text_or_empty(turns["text"]).alias("text"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(turn: Column) -> Column:
        head = F.concat(
            F.lit(template.begin), _escape(turn["role"], template, True), F.lit(template.after_role)
        )
        return F.array(
            F.struct(head.alias("piece"), F.lit(False).alias("loss")),
            F.struct(
                _escape(turn["text"], template, False).alias("piece"), turn["role"].isin(*template.loss).alias("loss")
            ),
            F.struct(F.lit(template.end).alias("piece"), F.lit(False).alias("loss")),
        )

    pieces = grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _state(F.col("turns.role"), template).isin(*template.final).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    long = F.lit(0).cast("long")
    spans = F.aggregate(
        "segments",
        F.struct(long.alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda seen, s: F.struct(
            (seen["at"] + F.length(s["piece"])).alias("at"),
            F.when(
                s["loss"],
                F.array_append(
                    seen["spans"],
                    F.struct(seen["at"].alias("start"), F.length(s["piece"]).cast("long").alias("length")),
                ),
            )
            .otherwise(seen["spans"])
            .alias("spans"),
        ),
        lambda seen: seen["spans"],
    )
    return pieces.select(
        "conv_id", "n_turns", "valid", F.array_join("segments.piece", "").alias("formatted"), spans.alias("loss_spans")
    )


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """Turns (role, text) of a formatted conversation, as they were before formatting."""
    chunks = F.split(formatted, template.end, -1)
    skip, mark = len(template.begin), len(template.after_role)

    def turn(chunk: Column) -> Column:
        role = F.split_part(chunk, F.lit(template.after_role), F.lit(1))
        head = F.length(role) + skip
        return F.struct(
            unescape(F.substring(role, F.lit(skip + 1), F.length(role)), template).alias("role"),
            unescape(F.substring(chunk, head - skip + mark + 1, F.length(chunk)), template).alias("text"),
        )

    return F.transform(F.slice(chunks, F.lit(1), F.size(chunks) - 1), turn)


def read_loss(formatted: Column, spans: Column, template: Template = DEFAULT) -> Column:
    """Text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")), template)
        ),
        "",
    )


# A conversation whose texts hold what looks like control strings.
PROBE = r"\### Assistant: </turn> ok"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the formatted output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    chats = format_chats(turns.unionByName(probe))
    read = chats.select(
        "conv_id",
        "valid",
        F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


OP9_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, coalesce(lag(role) OVER w, 'start') AS before, lead(role) OVER w IS NULL AS last
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(14 + length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\e'), '### ', '\h'), chr(10), '\n'))
    + length(replace(replace(replace(text, '\', '\\'), '</turn>', '\e'), '### ', '\h'))) AS BIGINT) AS formatted_chars,
  bool_and(CASE before WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
    WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE FALSE END
    AND (NOT last OR role IN ('user', 'assistant'))) AS valid
FROM o GROUP BY conv_id
"""
