"""Benchmark prompt building and answer extraction as ``Column`` expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of
from .chat import lit_message, message, render_chat
from .text import UNICODE_SPACE_CLASS, unicode_strip

# --- fixed values that must equal the reference for equal results ---------
CHOICE_LABELS = ["A", "B", "C", "D"]
# First "####" number.  \p{Nd} is what \d means in Python: a digit of any script.
HASH_ANSWER_RE = rf"####{UNICODE_SPACE_CLASS}*([-\p{{Nd}},.]+)"
# Fallback: every number-like run; the last one is used.
ANY_NUMBER_RE = r"[-\p{Nd},]+\.?\p{Nd}*"
STANDALONE_CHOICE_RE = r"\b([ABCD])\b"
# First fenced block (dot matches newline), optional "python" tag.
FENCED_CODE_RE = rf"(?s)```(?:python)?{UNICODE_SPACE_CLASS}*\n(.*?)```"
# A line that starts the code part of an unfenced response.
CODE_LINE_PREFIXES = [
    "def ", "return ", "if ", "for ", "while ", "class ", "import ",
    "from ", "try:", "except", "with ", "    ", "\t", "else:", "elif ",
    "raise ", "yield ", "pass", "break", "continue", "assert ",
]
CODE_SYSTEM_PROMPT = (
    "You are a Python programming assistant. Write only the function body to "
    "complete the given function. Do not include the function signature or any "
    "explanation."
)
CODE_USER_TEMPLATE_HEAD = "Complete the following Python function:\n\n"
MATH_SYSTEM_PROMPT = (
    "You are a math tutor. Solve the following problem step by step. End your "
    "response with the final numerical answer on its own line, preceded by ####."
)
CHOICE_SYSTEM_PROMPT = (
    "You are taking a multiple choice exam. Answer with only the letter "
    "(A, B, C, or D) of the correct answer. Do not explain."
)
NUMERIC_TOLERANCE = 1e-6
# ---------------------------------------------------------------------------

_RSTRIP_RE = rf"{UNICODE_SPACE_CLASS}+\z"


#: the digits of all other scripts, and the ASCII digit that each means
OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
THEIR_VALUES = "".join(str(unicodedata.digit(c)) for c in OTHER_DIGITS)


def parse_number(s) -> Column:
    """Remove thousands commas and parse, whatever script the digits are of;
    anything unparsable is NULL."""
    plain = F.replace(col_of(s), F.lit(","), F.lit(""))
    ascii_ = F.when(F.length(plain) == F.octet_length(plain), plain).otherwise(F.translate(plain, OTHER_DIGITS, THEIR_VALUES))
    return ascii_.try_cast("double")


def extract_numeric_answer(text) -> Column:
    """First ``#### number``; if absent or unparsable, the last number-like
    run of the text; NULL when that does not parse either."""
    t = col_of(text)
    marked = F.regexp_extract(t, HASH_ANSWER_RE, 1)
    first = F.when(marked != "", parse_number(marked))
    runs = F.regexp_extract_all(t, F.lit(ANY_NUMBER_RE), 0)
    last = F.when(F.size(runs) > 0, parse_number(F.try_element_at(runs, F.lit(-1))))
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("double")).otherwise(F.coalesce(first, last))


def numbers_match(pred, gold) -> Column:
    p, g = col_of(pred), col_of(gold)
    return F.coalesce(p.isNotNull() & g.isNotNull() & (F.abs(p - g) < NUMERIC_TOLERANCE), F.lit(False))


def extract_choice(response) -> Column:
    """Index 0-3 of the chosen letter: a leading A-D wins, else the first
    standalone A-D, else NULL."""
    r = col_of(response)
    up = F.upper(unicode_strip(r))
    first_char = F.substring(up, 1, 1)
    leading = F.when(first_char.isin(*CHOICE_LABELS), F.instr(F.lit("ABCD"), first_char) - 1)
    found = F.regexp_extract(up, STANDALONE_CHOICE_RE, 1)
    standalone = F.when(found != "", F.instr(F.lit("ABCD"), found) - 1)
    return F.when(r.isNull() | (r == ""), F.lit(None).cast("int")).otherwise(
        F.coalesce(leading, standalone).cast("int"))


def choice_label(idx) -> Column:
    """0-3 -> A-D; NULL -> '?'."""
    return F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in CHOICE_LABELS]), col_of(idx) + 1), F.lit("?"))


def _rstrip(c: Column) -> Column:
    return F.regexp_replace(c, _RSTRIP_RE, "")


def _starts_code(line: Column) -> Column:
    cond = (line == "") | line.startswith("#")
    for p in CODE_LINE_PREFIXES:
        cond = cond | line.startswith(p)
    return cond


def extract_code(response) -> Column:
    """First fenced block, stripped; else every line from the first code-like
    line on (right-stripped); else the whole response."""
    r = col_of(response)
    fenced = F.when(r.rlike(FENCED_CODE_RE), unicode_strip(F.regexp_extract(r, FENCED_CODE_RE, 1)))
    lines = F.transform(F.split(r, "\n", -1), _rstrip)
    start = F.array_position(F.transform(lines, _starts_code), True)
    tail = F.when(start > 0, F.array_join(F.slice(lines, start.cast("int"), F.size(lines)), "\n"))
    return F.coalesce(fenced, tail, r)


def test_program(prompt, code, test, entry_point) -> Column:
    """The program a sandbox would run: prompt + code, the tests, the call."""
    return F.concat(col_of(prompt), col_of(code), F.lit("\n\n"), col_of(test),
                    F.lit("\n\ncheck("), col_of(entry_point), F.lit(")\n"))


def code_prompt(prompt) -> Column:
    msgs = F.array(lit_message("system", CODE_SYSTEM_PROMPT),
                   message("user", F.concat(F.lit(CODE_USER_TEMPLATE_HEAD), col_of(prompt))))
    return render_chat(msgs, add_generation_prompt=True)


def math_prompt(question) -> Column:
    msgs = F.array(lit_message("system", MATH_SYSTEM_PROMPT), message("user", col_of(question)))
    return render_chat(msgs, add_generation_prompt=True)


def choices_text(choices) -> Column:
    """``A. c0\\nB. c1 ...``; choices after the fourth are ignored."""
    labels = F.array(*[F.lit(x) for x in CHOICE_LABELS])
    four = F.slice(col_of(choices), 1, len(CHOICE_LABELS))
    return F.array_join(
        F.transform(four, lambda c, i: F.concat(F.try_element_at(labels, i + 1), F.lit(". "), c)), "\n")


def choice_user_message(question, choices) -> Column:
    return F.concat(col_of(question), F.lit("\n\n"), choices_text(choices), F.lit("\n\nAnswer:"))


def choice_prompt(question, choices) -> Column:
    msgs = F.array(lit_message("system", CHOICE_SYSTEM_PROMPT),
                   message("user", choice_user_message(question, choices)))
    return render_chat(msgs, add_generation_prompt=True)


def pass_at_k(n, c, k: int) -> Column:
    """Unbiased pass@k from n samples with c correct:
    ``1 - prod_{i=n-c+1..n} (1 - k/i)``; 1 when ``n - c < k``."""
    n, c = col_of(n), col_of(c)
    prod = F.aggregate(F.sequence(n - c + 1, n), F.lit(1.0),
                       lambda acc, i: acc * (F.lit(1.0) - F.lit(float(k)) / i))
    return (F.when(c <= 0, F.lit(0.0))
            .when(n - c < k, F.lit(1.0))
            .otherwise(F.lit(1.0) - prod))
