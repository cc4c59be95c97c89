"""Column-level text scalars.

Every function here returns a ``Column`` built from Spark's own expressions,
so it runs inside whole-stage code generation and works unchanged on batch
and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's ``str.split()`` treats as whitespace
# (U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028,
# U+2029, U+202F, U+205F, U+3000).  Java's and RE2's ``\s`` only know ASCII.
WS_CLASS = (
    "[\\x{0009}-\\x{000D}\\x{001C}-\\x{0020}\\x{0085}\\x{00A0}\\x{1680}"
    "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
WS_RUN = WS_CLASS + "+"
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])

# Placeholder tokens of the code-literal normaliser.
NUM_TOKEN = "<NUM>"
STR_TOKEN = "<STR>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_as(col, value: str | None = "") -> Column:
    """Null handling of text columns: ``""`` (default) or ``"nan"``; ``None`` keeps nulls."""
    c = _c(col)
    return c if value is None else F.coalesce(c, F.lit(value))


def whitespace_tokens(col) -> Column:
    """Split on runs of whitespace, no empty pieces; null -> []."""
    c = _c(col)
    # every whitespace character becomes a space (a per-character table
    # lookup), then a single-character split, which skips the regex engine
    parts = F.split(F.translate(c, WS_CHARS, " " * len(WS_CHARS)), " ", -1)
    return F.coalesce(F.filter(parts, lambda x: x != F.lit("")), F.array().cast("array<string>"))


def normalize_code_literals(col) -> Column:
    """Decimals, then integers -> <NUM>; "..." then '...' -> <STR>.

    ``(?U)`` gives ``\\b``/``\\d`` their Unicode meaning, as Python's ``re``.
    Quoted literals may span lines (the negated class matches newlines).
    """
    c = _c(col)
    # The patterns and their order must equal the reference's.
    c = F.regexp_replace(c, r"(?U)\b\d+\.\d+\b", NUM_TOKEN)
    c = F.regexp_replace(c, r"(?U)\b\d+\b", NUM_TOKEN)
    c = F.regexp_replace(c, r'"[^"]*"', STR_TOKEN)
    c = F.regexp_replace(c, r"'[^']*'", STR_TOKEN)
    return c


def code_tokens(col) -> Column:
    """The code tokeniser, C2 followed by C1."""
    return whitespace_tokens(normalize_code_literals(col))


def sentences(col) -> Column:
    """C4: split on '.', keeping empty pieces (``a..b.`` -> a, '', b, '')."""
    return F.split(_c(col), r"\.", -1)


def combine_text(*cols, sep: str = " ", null_as_value: str | None = None) -> Column:
    """Code + sep + docstring.  With ``null_as_value=None`` a null input gives null."""
    parts = []
    for i, col in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(null_as(col, null_as_value))
    return F.concat(*parts)


def distinct_char_pairs(col) -> Column:
    """Set of adjacent character pairs of a word, in first-seen order; [] for length < 2."""
    c = _c(col)
    n = F.length(c)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(c, i, 2))
    return F.when(n >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


# The wording of both prompts must equal the reference's.
def summary_prompt(name, tokens, n_tokens: int = 100, hint=None) -> Column:
    """C7 (first prompt): ``Summarize function {name or ''}: `` + first n tokens + hint."""
    nm = F.coalesce(_c(name).cast("string"), F.lit(""))
    head = F.array_join(F.slice(_c(tokens), 1, n_tokens), " ") if n_tokens else F.array_join(_c(tokens), " ")
    out = F.concat(F.lit("Summarize function "), nm, F.lit(": "), head)
    if hint is not None:
        out = F.concat(out, F.coalesce(_c(hint), F.lit("")))
    return out


def docstring_prompt(name, summary) -> Column:
    """C7 (second prompt): ``Detailed docstring for {name or 'function'}: `` + summary."""
    nm = F.coalesce(F.nullif(_c(name).cast("string"), F.lit("")), F.lit("function"))
    return F.concat(F.lit("Detailed docstring for "), nm, F.lit(": "), F.coalesce(_c(summary), F.lit("")))
