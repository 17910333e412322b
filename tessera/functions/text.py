"""String helpers and tokenisation, all JVM built-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns (must agree with the oracle's RE2 engine).
WHITESPACE = r"[ \t\n\r\f\x0B]+"
# Java's String.trim() drops every char up to U+0020 at both ends (NUL excluded here).
TRIM_CHARS = "".join(chr(c) for c in range(1, 33))
NON_WORD = r"[^\p{L}\p{N}]+"
SQUARE_BRACKETS = r"\[|\]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Trim control characters and spaces at both ends, not only spaces."""
    return F.btrim(_c(c), F.lit(TRIM_CHARS))


def fields(c, sep: str = WHITESPACE) -> Column:
    """Split a trimmed line on a separator regex."""
    return F.split(java_trim(c), sep)


def last_segment(c, sep: str = "/") -> Column:
    """Last piece of a path (``split(...).last``)."""
    return F.element_at(F.split(_c(c), sep), -1)


def text_before(c, sep: str = " ") -> Column:
    """Text before the first ``sep`` (whole text if there is none)."""
    return F.substring_index(_c(c), sep, 1)


def strip_brackets(c) -> Column:
    return F.regexp_replace(_c(c), SQUARE_BRACKETS, "")


def explode_tokens(df: DataFrame, col: str, alias: str = "word", keep=(),
                   tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per token.  ``tokenizer`` maps the text column to an array of
    words (built-ins, or a pandas UDF that wraps a segmenter); the default
    takes runs of letters and digits.  Empty pieces are dropped after the
    explode with a plain (code-generated) filter, not with a lambda over the
    array, which would run outside whole-stage codegen (about twice as slow)."""
    words = tokenizer(_c(col)) if tokenizer else F.split(F.lower(_c(col)), NON_WORD)
    pieces = df.select(*keep, F.explode(words).alias(alias))
    return pieces.where(F.col(alias) != "")


def prefix_name(c) -> Column:
    """``"Name: " + name`` as a built-in expression."""
    return F.concat(F.lit("Name: "), _c(c))
