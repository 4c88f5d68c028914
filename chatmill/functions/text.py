"""Text projections and content predicates as Spark ``Column`` expressions.

Everything here stays JVM-side (whole-stage codegen where Spark offers it).
Unicode NFC uses ICU4J, which ships with Spark 4 for collations, through the
built-in ``reflect`` function; it also works inside higher-order lambdas, so
turn arrays are normalised without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# --- fixed values that must equal the reference for equal results ---------
# Length bounds of a valid turn, in code points (both ends pass).
MIN_TURN_LENGTH = 5
MAX_TEXT_LENGTH = 32_768
# Minimum share of letters/digits in a valid turn (exactly 0.1 passes).
MIN_ALNUM_RATIO_DENOMINATOR = 10  # ratio >= 1/10
# Control characters removed by normalisation (tab, LF and CR are kept).
CONTROL_CHARS_RE = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}]"
# Runs of spaces/tabs collapse to one space; three or more LF become two.
HSPACE_RUN_RE = r"[ \t]+"
NEWLINE_RUN_RE = r"\n{3,}"
# Code points that Python's str.isspace() accepts, i.e. what str.strip()
# removes: U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
UNICODE_SPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set as a plain string (for trim with a character set).
UNICODE_SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ---------------------------------------------------------------------------

# \z (end of input) rather than $, which in Java also matches before a final
# newline.  The same pattern runs unchanged in RE2 (DuckDB oracle).
STRIP_RE = rf"^{UNICODE_SPACE_CLASS}+|{UNICODE_SPACE_CLASS}+\z"
NON_ALNUM_RE = r"[^\p{L}\p{N}]"

_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def nfc(c) -> Column:
    """Unicode NFC.  ASCII text is already NFC, so only strings whose byte
    length differs from their character length reach ICU."""
    c = col_of(c)
    composed = F.reflect(F.lit(_ICU_NORMALIZER), F.lit("compose"), c, F.lit(False))
    return F.when(F.length(c) != F.octet_length(c), composed).otherwise(c)


def normalize_text(c) -> Column:
    """NFC, drop control characters, collapse horizontal space, cap newline
    runs at two, strip Unicode whitespace -- in this order.  NULL becomes ''.
    (Stripping last keeps ``"\\n \\n\\n"``'s space, so that run is not
    collapsed -- as in the reference.)"""
    c = F.coalesce(col_of(c), F.lit(""))
    c = nfc(c)
    c = F.regexp_replace(c, CONTROL_CHARS_RE, "")
    c = F.regexp_replace(c, HSPACE_RUN_RE, " ")
    c = F.regexp_replace(c, NEWLINE_RUN_RE, "\n\n")
    return unicode_strip(c)


def alnum_count(c) -> Column:
    c = col_of(c)
    return F.length(F.regexp_replace(c, NON_ALNUM_RE, ""))


def is_valid_content(c) -> Column:
    """Length within [5, 32768] code points and at least 10 % letters/digits.

    Length tests come first so the regex only runs on rows that can pass.
    The ratio test is done in integers: ``10 * alnum >= length`` is exactly
    ``alnum / length >= 0.1`` for these lengths.
    """
    c = col_of(c)
    n = F.length(c)
    length_ok = c.isNotNull() & (n >= MIN_TURN_LENGTH) & (n <= MAX_TEXT_LENGTH)
    return F.when(length_ok, alnum_count(c) * MIN_ALNUM_RATIO_DENOMINATOR >= n).otherwise(F.lit(False))


def prefix(c, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(col_of(c), 1, n)


def unicode_strip(c) -> Column:
    """Strip Unicode whitespace at both ends.  ``trim`` with a character set
    only touches the ends; the equivalent regex (``STRIP_RE``) would try a
    match at every whitespace run of the text."""
    return F.trim(col_of(c), F.lit(UNICODE_SPACE_CHARS))


def title_from_key(c) -> Column:
    """``metric_key`` -> ``Metric Key``."""
    return F.initcap(F.replace(col_of(c), F.lit("_"), F.lit(" ")))


def fixed_text(x, places: int = 1) -> Column:
    """A number with ``places`` decimals.  ``bround`` (half-even) first, so
    that the formatter (half-up) has nothing left to round: a tie such as
    92.25 prints 92.2 as Python's formatting does."""
    return F.format_string(f"%.{places}f", F.bround(col_of(x), places))


def percent_text(num, den, places: int = 1) -> Column:
    """``num / den * 100`` formatted with ``places`` decimals and a ``%``."""
    pct = col_of(num).cast("double") * 100 / col_of(den)
    return F.concat(fixed_text(pct, places), F.lit("%"))


def short_checksum(c, n: int = 12) -> Column:
    return F.substring(col_of(c), 1, n)


def bytes_to_mb(c) -> Column:
    return F.round(col_of(c).cast("double") / F.lit(1e6), 1)


def bytes_to_gb(c) -> Column:
    return F.round(col_of(c).cast("double") / F.lit(1e9), 2)
