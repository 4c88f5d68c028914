"""The column operators as SQL functions.

``register`` creates temporary SQL functions in the session, so a query
written in SQL can clean, filter, key and grade texts:

    SELECT doc_id, normalize_text(text) FROM documents WHERE is_valid_content(normalize_text(text))

Each body is one SQL expression over built-ins (see ``text.py``, ``chat.py``,
``answers.py`` for the rules); Spark puts it in place of the call, so the
optimizer sees through it and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import answers as A
from . import text as X


def _lit(s: str) -> str:
    """A string literal: characters that the parser would take for something else are escaped."""
    return "'" + "".join(f"\\u{ord(c):04X}" if c.isspace() or ord(c) < 0x20 or c in "'\\" else c for c in s) + "'"


def _normalized(s: str) -> str:
    nfc = f"CASE WHEN length({s}) <> octet_length({s}) THEN reflect('com.ibm.icu.text.Normalizer', 'compose', {s}, false) ELSE {s} END"
    spaced = f"regexp_replace(regexp_replace({nfc}, {_lit(X.CONTROL_CHARS_RE)}, ''), {_lit(X.HSPACE_RUN_RE)}, ' ')"
    return f"trim(BOTH {_lit(X.UNICODE_SPACE_CHARS)} FROM regexp_replace({spaced}, {_lit(X.NEWLINE_RUN_RE)}, {_lit(chr(10) * 2)}))"


def _valid(s: str) -> str:
    alnum = f"length(regexp_replace({s}, {_lit(X.NON_ALNUM_RE)}, ''))"
    return (f"coalesce(CASE WHEN length({s}) BETWEEN {X.MIN_TURN_LENGTH} AND {X.MAX_TEXT_LENGTH} "
            f"THEN {alnum} * {X.MIN_ALNUM_RATIO_DENOMINATOR} >= length({s}) ELSE false END, false)")


def _number(s: str) -> str:
    """The number written in ``s``, thousands separators taken out, in digits of any script."""
    plain = f"replace({s}, ',', '')"
    return f"try_cast(CASE WHEN length({plain}) = octet_length({plain}) THEN {plain} ELSE translate({plain}, {_lit(A.OTHER_DIGITS)}, {_lit(A.THEIR_VALUES)}) END AS DOUBLE)"


def _numeric_answer(s: str) -> str:
    marked = f"CASE WHEN regexp_like({s}, {_lit(A.HASH_ANSWER_RE)}) THEN {_number(f'regexp_extract({s}, {_lit(A.HASH_ANSWER_RE)}, 1)')} END"
    last = _number(f"try_element_at(regexp_extract_all({s}, {_lit(A.ANY_NUMBER_RE)}, 0), -1)")
    return f"CASE WHEN {s} <> '' THEN coalesce({marked}, {last}) END"


def _choice(s: str) -> str:
    upper = f"trim(BOTH {_lit(X.UNICODE_SPACE_CHARS)} FROM upper({s}))"
    found = f"CASE WHEN substr({upper}, 1, 1) IN ('A', 'B', 'C', 'D') THEN substr({upper}, 1, 1) ELSE nullif(regexp_extract({upper}, {_lit(A.STANDALONE_CHOICE_RE)}, 1), '') END"
    return f"instr('ABCD', {found}) - 1"


def _content_key(m: str) -> str:
    parts = f"transform(filter({m}, x -> x.role IN ('user', 'assistant')), x -> concat(x.role, ':', length(x.content), ':', x.content))"
    return f"sha2(array_join({parts}, '|'), 256)"


def definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, type, body)."""
    return {
        "normalize_text": ("s STRING", "STRING", _normalized("coalesce(s, '')")),
        "is_valid_content": ("s STRING", "BOOLEAN", _valid("s")),
        "alnum_count": ("s STRING", "INT", f"length(regexp_replace(s, {_lit(X.NON_ALNUM_RE)}, ''))"),
        "numeric_answer": ("s STRING", "DOUBLE", _numeric_answer("s")),
        "choice_answer": ("s STRING", "INT", _choice("s")),
        "content_key": ("m ARRAY<STRUCT<role: STRING, content: STRING>>", "STRING", _content_key("m")),
    }


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions, their names after ``prefix``; returns the names."""
    names = []
    for name, (parameters, kind, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {kind} RETURN {body}")
        names.append(prefix + name)
    return names
