"""Chat formatting: a declarative template, a finite-state machine over roles, segments with loss flags.

A template names the markers around a turn, the roles whose text carries loss, and the machine: its
transitions ``(state, role) -> state`` and the states in which a conversation may end.  Formatting gives,
per conversation, the text segments with their loss flag, the joined text, the spans under the loss mask and
whether the machine accepts the turn order.  Control characters inside roles and texts are escaped, so
markers never occur in them and the output can be read back exactly.  Only built-in functions.

Defined results: a null text or role is empty; turns are ordered by turn, then role, then text (null turn
first); repeated rows are repeated turns; a null conversation id is one conversation; an empty table gives
an empty result; an order that the machine refuses is formatted all the same, with ``valid`` false; extra
columns of the input are ignored.  A conversation is one output cell, so it must fit in a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    head: str = "### "
    colon: str = ":\n"
    end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked"})
    final: tuple[str, ...] = ("answered",)


TEMPLATE = Template()
#: Escapes: the backslash first; read back in the reverse order.  Their second letters are no controls.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escaped(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def accepted(roles: Column, t: Template = TEMPLATE) -> Column:
    """Run the machine over an array of roles."""
    table = F.create_map(*[F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}>{role}", to)])
    last = F.aggregate(roles, F.lit(t.start), lambda s, r: F.coalesce(
        F.try_element_at(table, F.concat(s, F.lit(">"), r)), F.lit("refused")))
    return last.isin(*t.final)


def format_conversations(turns: DataFrame, t: Template = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, segments, formatted, loss_spans, valid): segments hold escaped text and a loss flag;
    loss_spans are (start, length) in code points of ``formatted``."""
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = turns.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        seg(F.concat(F.lit(t.head), escaped(x["role"]), F.lit(t.colon)), F.lit(False)),
        seg(escaped(x["text"]), x["role"].isin(*t.loss_roles)),
        seg(F.lit(t.end), F.lit(False)))))
    convs = convs.select("conv_id", segments.alias("segments"), accepted(F.transform("turns", lambda x: x["role"]), t).alias("valid"))
    empty = F.array().cast("array<struct<start:int,length:int>>")
    placed = F.aggregate("segments", F.struct(F.lit(0).alias("at"), empty.alias("spans")), lambda acc, s: F.struct(
        (acc["at"] + F.length(s["text"])).alias("at"),
        F.when(s["loss"], F.array_append(acc["spans"], F.struct(acc["at"].alias("start"), F.length(s["text"]).alias("length"))))
        .otherwise(acc["spans"]).alias("spans")))
    return convs.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        placed["spans"].alias("loss_spans"), "valid")


def read_back(formatted: Column, t: Template = TEMPLATE) -> Column:
    """array<struct<role, text>> from the formatted text alone."""
    parts = F.split(formatted, F.lit(_quoted(t.end)))
    body = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(p):
        cut = F.locate(t.colon, p)
        return F.struct(unescaped(F.substring(p, F.lit(len(t.head) + 1), cut - len(t.head) - 1)).alias("role"),
                        unescaped(F.substring(p, cut + len(t.colon), F.length(p))).alias("text"))
    return F.transform(body, turn)


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def probe(spark: SparkSession) -> DataFrame:
    """The contract's added conversation."""
    text = F.lit(r"\### Assistant: </turn> ok")
    roles = F.array(F.lit("user"), F.lit("assistant"))
    return spark.range(1).select(F.posexplode(roles).alias("turn", "role")).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("turn").cast("long"), "role", text.alias("text"))


def op8_chat(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Contract columns, all read back from the formatted text and the loss spans."""
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe(spark))
    out = format_conversations(rows)
    out = out.withColumn("back", read_back(F.col("formatted"))).withColumn("loss", masked(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) + length(text)
            + length(regexp_replace(text, '[^\\<#:]', '', 'g')) + 14 AS chars,
         coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), 'start') AS before,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS is_last
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       bool_and(before || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
                AND (NOT is_last OR role = 'assistant')) AS valid
FROM t GROUP BY conv_id
"""
