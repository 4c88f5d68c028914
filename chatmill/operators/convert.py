"""Source-shape converters: raw rows -> ``messages ARRAY<STRUCT<role, content>>``.

Each converter is ``DataFrame -> DataFrame``: it adds ``messages`` (NULL when
the row does not convert) and keeps every other column.  ``drop_failed``
removes the NULL rows; outcome accounting keeps them.

Intermediate arrays are materialised in their own projection: Catalyst's
CollapseProject does not inline a non-cheap alias that is used twice, so each
higher-order expression is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chat import has_role, has_user_and_assistant, lit_message, message
from ..functions.text import is_valid_content, normalize_text

# The reference injects a product persona; the system text is a parameter.
DEFAULT_SYSTEM = "You are a helpful assistant."

# --- fixed values that must equal the reference for equal results ---------
TURN_ROLE_MAP = {"system": "system", "human": "user", "gpt": "assistant"}
MIN_RAW_TURNS = 2            # alternating shape: raw turns needed
MIN_BUILT_MESSAGES = 3       # alternating shape: system + two turns
MIN_CODE_CHARS = 30
MIN_DOC_CHARS = 15
DEFAULT_CODE_LANGUAGE = "python"
CODE_USER_TEMPLATE = ("Write a ", " function that does the following:\n\n")
CODE_FENCE = "```"
# ---------------------------------------------------------------------------

_TMP = "_cm_tmp"


def _role_of(raw: Column) -> Column:
    expr = None
    for src, dst in TURN_ROLE_MAP.items():
        expr = F.when(raw == src, F.lit(dst)) if expr is None else expr.when(raw == src, F.lit(dst))
    return expr


def _prepend_system(msgs: Column, default_system: str) -> Column:
    return F.concat(F.array(lit_message("system", default_system)), msgs)


def convert_turns(df: DataFrame, conversations: str = "conversations",
                  default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """``conversations ARRAY<STRUCT<from, value>>``: map roles, drop unknown
    roles and invalid turns one by one, require user and assistant, prepend
    the default system turn only when no valid system turn is left."""
    turns = F.col(conversations)
    kept = F.filter(
        F.transform(turns, lambda t: F.struct(_role_of(t["from"]).alias("role"),
                                               normalize_text(t["value"]).alias("content"))),
        lambda m: m["role"].isNotNull() & is_valid_content(m["content"]))
    k = F.col(_TMP)
    built = F.when(has_role(k, "system"), k).otherwise(_prepend_system(k, default_system))
    return (df.withColumn(_TMP, kept)
              .withColumn(out, F.when(k.isNotNull() & has_user_and_assistant(k), built))
              .drop(_TMP))


def convert_alternating(df: DataFrame, data: str = "data",
                        default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """``data ARRAY<STRING>``: even raw index = user, odd = assistant (index
    before dropping invalid turns); default system always first; needs two
    raw turns and three built messages (no role check here)."""
    d = F.col(data)
    kept = F.filter(
        F.transform(d, lambda x, i: F.struct(
            F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
            normalize_text(x).alias("content"))),
        lambda m: is_valid_content(m["content"]))
    k = F.col(_TMP)
    built = _prepend_system(k, default_system)
    ok = d.isNotNull() & (F.size(d) >= MIN_RAW_TURNS) & (F.size(k) + 1 >= MIN_BUILT_MESSAGES)
    return df.withColumn(_TMP, kept).withColumn(out, F.when(ok, built)).drop(_TMP)


def convert_triples(df: DataFrame, system_prompt: str = "system_prompt", question: str = "question",
                    response: str = "response", default_system: str = DEFAULT_SYSTEM,
                    out: str = "messages") -> DataFrame:
    """``(system_prompt, question, response)``: question and response must be
    valid; the system text is used when valid, else the default."""
    s, q, r = (F.col(f"{_TMP}_{x}") for x in "sqr")
    staged = (df.withColumn(f"{_TMP}_s", normalize_text(F.col(system_prompt)) if system_prompt else F.lit(""))
                .withColumn(f"{_TMP}_q", normalize_text(F.col(question)))
                .withColumn(f"{_TMP}_r", normalize_text(F.col(response))))
    sys_text = F.when(is_valid_content(s), s).otherwise(F.lit(default_system))
    msgs = F.array(message("system", sys_text), message("user", q), message("assistant", r))
    return (staged.withColumn(out, F.when(is_valid_content(q) & is_valid_content(r), msgs))
                  .drop(f"{_TMP}_s", f"{_TMP}_q", f"{_TMP}_r"))


def convert_code_pairs(df: DataFrame, code: str = "func_code_string",
                       doc: str = "func_documentation_string", language: str | None = "language",
                       default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """``(code, documentation, language)`` -> instruction pair.  Both texts
    valid, code >= 30 and documentation >= 15 code points.  ``language=None``
    means the field is absent: the language is then ``python``."""
    c, d = F.col(f"{_TMP}_c"), F.col(f"{_TMP}_d")
    lang = (F.coalesce(F.col(language).cast("string"), F.lit(DEFAULT_CODE_LANGUAGE))
            if language else F.lit(DEFAULT_CODE_LANGUAGE))
    staged = (df.withColumn(f"{_TMP}_c", normalize_text(F.col(code)))
                .withColumn(f"{_TMP}_d", normalize_text(F.col(doc))))
    ok = (is_valid_content(c) & is_valid_content(d)
          & (F.length(c) >= MIN_CODE_CHARS) & (F.length(d) >= MIN_DOC_CHARS))
    user = F.concat(F.lit(CODE_USER_TEMPLATE[0]), lang, F.lit(CODE_USER_TEMPLATE[1]), d)
    assistant = F.concat(F.lit(CODE_FENCE), lang, F.lit("\n"), c, F.lit("\n" + CODE_FENCE))
    msgs = F.array(lit_message("system", default_system), message("user", user), message("assistant", assistant))
    return staged.withColumn(out, F.when(ok, msgs)).drop(f"{_TMP}_c", f"{_TMP}_d")


def convert_qa(df: DataFrame, question: str = "question", answer: str = "answer",
               default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """``(question, answer)`` pair; both must be valid."""
    q, a = F.col(f"{_TMP}_q"), F.col(f"{_TMP}_a")
    staged = (df.withColumn(f"{_TMP}_q", normalize_text(F.col(question)))
                .withColumn(f"{_TMP}_a", normalize_text(F.col(answer))))
    msgs = F.array(lit_message("system", default_system), message("user", q), message("assistant", a))
    return (staged.withColumn(out, F.when(is_valid_content(q) & is_valid_content(a), msgs))
                  .drop(f"{_TMP}_q", f"{_TMP}_a"))


def drop_failed(df: DataFrame, messages: str = "messages") -> DataFrame:
    return df.filter(F.col(messages).isNotNull())


# --- JSON-line shapes ------------------------------------------------------
# A raw line is parsed once into a VARIANT; each shape pulls its fields out.
# Text is taken only where the JSON value is a string, in fields and inside
# arrays (a number, a null or an object counts as missing, like the
# reference's type check).

def _json_type(v: Column) -> Column:
    return F.schema_of_variant(v)


def _text_of(v: Column) -> Column:
    """The text of a JSON string; NULL for every other value."""
    return F.when(_json_type(v) == "STRING", F.try_variant_get(v, "$", "string"))


def variant_string(v: Column, field: str) -> Column:
    return _text_of(F.try_variant_get(v, f"$.{field}", "variant"))


def _elements(v: Column, field: str) -> Column:
    """The elements of an array, each with its own type; NULL if it is none."""
    return F.try_variant_get(v, f"$.{field}", "array<variant>")


def _fields_turns(v: Column) -> dict[str, Column]:
    # a turn that is not an object fails the row; a role or text that is not a string is missing
    turns = _elements(v, "conversations")
    parts = F.transform(turns, lambda t: F.struct(variant_string(t, "from").alias("from"), variant_string(t, "value").alias("value")))
    return {"conversations": F.when(F.forall(turns, lambda t: _json_type(t).startswith("OBJECT")), parts)}


def _fields_alternating(v: Column) -> dict[str, Column]:
    return {"data": F.transform(_elements(v, "data"), _text_of)}


def printed(v: Column) -> Column:
    """A JSON value as the reference prints it into text: a null is ``None``,
    true and false are capitalised; NULL where there is no value at all.
    (Arrays and objects print as JSON.)"""
    kind = _json_type(v)
    text = F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))
    return F.when(kind == "VOID", F.lit("None")).when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)


def _fields_triples(v: Column) -> dict[str, Column]:
    return {k: variant_string(v, k) for k in ("system_prompt", "question", "response")}


def _fields_code(v: Column) -> dict[str, Column]:
    return {"func_code_string": variant_string(v, "func_code_string"),
            "func_documentation_string": variant_string(v, "func_documentation_string"),
            "language": printed(F.try_variant_get(v, "$.language", "variant"))}


def _fields_qa(v: Column) -> dict[str, Column]:
    return {k: variant_string(v, k) for k in ("question", "answer")}


# shape name -> (field extraction from a parsed line, converter, the
# converter parameter each extracted field is passed as)
SHAPES: dict[str, tuple[Callable[[Column], dict[str, Column]], Callable[..., DataFrame], dict[str, str]]] = {
    "turns": (_fields_turns, convert_turns, {"conversations": "conversations"}),
    "alternating": (_fields_alternating, convert_alternating, {"data": "data"}),
    "triples": (_fields_triples, convert_triples,
                {"system_prompt": "system_prompt", "question": "question", "response": "response"}),
    "code_pairs": (_fields_code, convert_code_pairs,
                   {"func_code_string": "code", "func_documentation_string": "doc", "language": "language"}),
    "qa": (_fields_qa, convert_qa, {"question": "question", "answer": "answer"}),
}

# --- fixed values: which training source has which raw shape ----------------
CONVERTERS = {
    "openhermes": "turns",
    "ultrachat": "alternating",
    "openorca": "triples",
    "codesearchnet": "code_pairs",
    "gsm8k": "qa",
}
# ---------------------------------------------------------------------------


def convert_parsed(df: DataFrame, shape: str, parsed: str = "parsed",
                   default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """Convert rows holding a parsed JSON line (VARIANT) with the given shape.
    Non-object JSON converts to NULL (the reference would crash)."""
    extract, converter, params = SHAPES[shape]
    fields = extract(F.col(parsed))
    staged = df.select("*", *[c.alias(f"{_TMP}x_{k}") for k, c in fields.items()])
    kwargs = {params[k]: f"{_TMP}x_{k}" for k in fields}
    return (converter(staged, default_system=default_system, out=out, **kwargs)
            .drop(*[f"{_TMP}x_{k}" for k in fields]))


def convert_mixed(df: DataFrame, shape: Column, parsed: str = "parsed",
                  default_system: str = DEFAULT_SYSTEM, out: str = "messages") -> DataFrame:
    """Convert rows of all shapes in one pass: ``shape`` names each row's
    (NULL or a name without a converter: the row does not convert).  A row's
    fields are pulled out for its own shape only, so the other converters see
    NULLs, which cost next to nothing."""
    df = df.withColumn(f"{_TMP}_shape", shape)
    for name in SHAPES:
        own = F.when(F.col(f"{_TMP}_shape") == name, F.col(parsed))
        df = convert_parsed(df.withColumn(f"{_TMP}_own", own), name, f"{_TMP}_own", default_system, f"{_TMP}_{name}").drop(f"{_TMP}_own")
    built = [F.when(F.col(f"{_TMP}_shape") == name, F.col(f"{_TMP}_{name}")) for name in SHAPES]
    return df.withColumn(out, F.coalesce(*built)).drop(f"{_TMP}_shape", *[f"{_TMP}_{name}" for name in SHAPES])


def shape_of(source: Column, converters: dict[str, str] | None = None) -> Column:
    """The raw shape of a source; NULL for one without a converter."""
    pairs = (CONVERTERS if converters is None else converters).items()
    return F.get(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in pairs]), lambda p: p["k"] == source), F.lit(0))["v"]
