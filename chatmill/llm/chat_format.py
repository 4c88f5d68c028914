r"""Chat formatting with a grammar round trip, DataFrame functions only.

    conversation = "<s>" turn*
    turn         = "[INST]" text "[/INST]"          user
                 | "[SYS]" text "[/SYS]"            system
                 | "[ANS]" text "</s>"              assistant
                 | "[ROLE]" role "[:]" text "[/ROLE]"   any other role

A control string never starts inside another, so a rendered conversation has
one parse.  Each turn is rendered as it is, parsed again and compared; content
that does not come back (it holds a control string, or one that looks escaped)
is escaped by a backslash after the control string's first character, which
parsing takes off again, until it is identical.  The whole conversation is
then parsed and compared once more; one that differs is an error, not a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BEGIN = "<s>"
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[ANS]", "</s>")}
OTHER, ROLE_END, OTHER_END = "[ROLE]", "[:]", "[/ROLE]"
#: the control strings after their first character
_TAIL = r"(?:/?(?:INST|SYS|ANS|ROLE)\]|:\]|/?s>)"
_CONTROL = r"[\[<]" + _TAIL
_ESCAPABLE = r"([\[<])(\\*" + _TAIL + ")"
_ESCAPED = r"([\[<])\\(\\*" + _TAIL + ")"
_TURN = r"(?s)\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|\[ANS\].*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPABLE), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2"))


def render(role: Column, text: Column) -> Column:
    """One turn; role and text are already escaped where they must be."""
    out = F.concat(F.lit(OTHER), role, F.lit(ROLE_END), text, F.lit(OTHER_END))
    for name, (start, end) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(start), text, F.lit(end))).otherwise(out)
    return out


def _body(piece: Column, start: str, end: str) -> Column:
    return F.substring(piece, F.lit(len(start) + 1), F.char_length(piece) - len(start) - len(end))


def _parse_turn(piece: Column) -> Column:
    """role and text of one rendered turn; NULLs if a control string is left inside."""
    def read(role: Column, text: Column) -> Column:
        clean = ~text.rlike(_CONTROL) & ~role.rlike(_CONTROL)
        return F.struct(F.when(clean, unescape(role)).alias("role"), F.when(clean, unescape(text)).alias("text"))

    whole = _body(piece, OTHER, OTHER_END)
    at = F.instr(whole, ROLE_END)
    out = read(F.substring(whole, F.lit(1), at - 1), F.substring(whole, at + len(ROLE_END), F.char_length(whole)))
    for name, (start, end) in MARKS.items():
        out = F.when(piece.startswith(start), read(F.lit(name), _body(piece, start, end))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text).  NULL if
    the text is not a conversation of the grammar."""
    pieces = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))
    return F.when(F.concat(F.lit(BEGIN), F.array_join(pieces, "")) == formatted, F.transform(pieces, _parse_turn))


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` rows to one row per conversation:
    ``conv_id, n_turns, formatted`` and ``loss_spans`` (first character from
    0, and length, of each assistant text in ``formatted``).

    NULL text and role count as empty; turns go by ``turn``, NULL first, ties
    by role and text; repeated rows are turns of their own; a NULL conv_id is
    a conversation of its own; other columns are not looked at; an empty table
    gives no rows.  A conversation is one value of the output and therefore
    passes through one task."""
    rows = turns.select("conv_id", F.col("turn").alias("_turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = F.struct("role", "text")
    raw = F.concat(F.lit(BEGIN), render(F.col("role"), F.col("text")))
    comes_back = F.coalesce(F.col("back") == F.array(source), F.lit(False))
    rows = rows.withColumn("back", parse(raw)).withColumn("plain", comes_back)
    known = F.col("role").isin(*MARKS)
    rows = (rows.withColumn("safe_role", F.when(F.col("plain") | known, F.col("role")).otherwise(escape(F.col("role"))))
            .withColumn("safe", F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text")))))
    rows = rows.select("conv_id", F.struct("_turn", "role", "text", render(F.col("safe_role"), F.col("safe")).alias("piece"),
                                           F.char_length("safe").alias("n")).alias("t"))
    by_conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    by_conv = by_conv.select("conv_id", "t", F.concat(F.lit(BEGIN), F.array_join(F.col("t.piece"), "")).alias("formatted"))
    identical = F.coalesce(parse(F.col("formatted")) == F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.lit(False))
    start = F.aggregate("t", F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")), _add_span)
    return by_conv.select(
        "conv_id", F.size("t").alias("n_turns"),
        F.when(identical, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip"))).alias("formatted"),
        start["spans"].alias("loss_spans"))


def _add_span(state: Column, t: Column) -> Column:
    start, _ = MARKS["assistant"]
    span = F.array(F.struct((state["at"] + len(start)).alias("start"), t["n"].alias("length")))
    return F.struct((state["at"] + F.char_length(t["piece"])).alias("at"),
                    F.when(t["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def with_probe(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``turns`` plus conversation -1, whose texts are made of control strings."""
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
