"""Text functions as Column -> Column expressions (JVM-side, no Python UDF).

The patterns below are fixed values: they must equal the reference's
tokenizer and whitespace rules for identical tokens.  They are written so the
same text is valid for Java regex (Spark) and RE2 (DuckDB oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Lexical token: an ASCII identifier, or a run of (Unicode) decimal digits with
# an optional fractional part.
TOKEN_PATTERN = r"[A-Za-z_][A-Za-z0-9_]*|\p{Nd}+(?:\.\p{Nd}+)?"
# Separators inside an identifier: anything that is not an ASCII letter or
# digit (the underscore included, so snake_case splits).
SUBTOKEN_SEPARATOR = r"[^A-Za-z0-9]+"
# camelCase boundary: a lower-case letter or digit followed by an upper-case one.
CAMEL_BOUNDARY = r"([a-z0-9])([A-Z])"
CAMEL_REPLACEMENT_JAVA = "$1 $2"
# Unicode whitespace as Python's str.isspace / re \s define it.
WHITESPACE_CLASS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
# Histogram bucket width and the preview / code display limits.
HISTOGRAM_WIDTH = 50
PREVIEW_LIMIT = 160
MAX_CODE_CHARS = 1800
TRUNCATED_CODE_SUFFIX = "\n# ... truncated ..."
UNKNOWN_FUNCTION = "(unknown function)"
# A match made only of lower-case ASCII letters and digits needs no splitting.
SIMPLE_TOKEN = r"^[a-z0-9]+$"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_whitespace(x) -> Column:
    """Collapse every whitespace run to one space and strip both ends."""
    collapsed = F.regexp_replace(_c(x), WHITESPACE_CLASS + "+", " ")
    return F.regexp_replace(collapsed, r"^ +| +\z", "")


def strip(x) -> Column:
    """Strip Unicode whitespace at both ends (inner whitespace kept)."""
    ws = WHITESPACE_CLASS + "+"
    return F.regexp_replace(_c(x), rf"^{ws}|{ws}\z", "")


def clean_docstring(x) -> Column:
    """null -> '' then whitespace normalisation."""
    return normalize_whitespace(F.coalesce(_c(x), F.lit("")))


def clean_code(x) -> Column:
    """null -> '' then strip."""
    return strip(F.coalesce(_c(x), F.lit("")))


def blank_to_null(x) -> Column:
    """'' -> null, so ``coalesce`` implements Python's ``a or b``."""
    return F.when(_c(x) != "", _c(x))


def first_non_empty(*cols) -> Column:
    """``a or b or ''``: the first value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def _subtokens(m: Column) -> Column:
    spaced = F.regexp_replace(F.regexp_replace(m, SUBTOKEN_SEPARATOR, " "),
                              CAMEL_BOUNDARY, CAMEL_REPLACEMENT_JAVA)
    return F.filter(F.split(spaced, " "), lambda p: p != "")


def split_identifier(x) -> Column:
    """Split on non-alphanumerics, underscores and camelCase boundaries."""
    return _subtokens(_c(x))


def tokenize(x) -> Column:
    """Lexical tokens of one text part: identifiers and numbers, each split
    into lower-cased sub-tokens; a match without sub-tokens (``___``, non-ASCII
    digits) is kept whole, lower-cased."""
    matches = F.regexp_extract_all(_c(x), F.lit(TOKEN_PATTERN), 0)

    def split_match(parts, m):
        return F.when(F.size(parts) > 0, F.transform(parts, F.lower)) \
                .otherwise(F.array(F.lower(m)))

    def expand(m):
        # fast path: a lower-case ASCII word or number is its own only token
        return F.when(m.rlike(SIMPLE_TOKEN), F.array(m)).otherwise(
            F.element_at(F.transform(F.array(_subtokens(m)), lambda parts: split_match(parts, m)), 1))

    return F.flatten(F.transform(matches, expand))


def tokenize_parts(*parts) -> Column:
    """Tokens of several parts, concatenated part by part (never by joining
    the texts, so no token spans two parts)."""
    return F.concat(*[tokenize(F.coalesce(_c(p), F.lit(""))) for p in parts])


def document_text(name, docstring, code) -> Column:
    """Non-empty sections joined by a blank line."""
    return F.concat_ws("\n\n", blank_to_null(_c(name)), blank_to_null(_c(docstring)),
                       blank_to_null(_c(code)))


def preview(x, limit: int = PREVIEW_LIMIT) -> Column:
    """Whitespace-flattened text, cut to ``limit`` characters with '...'."""
    flat = normalize_whitespace(F.coalesce(_c(x), F.lit("")))
    return F.when(F.length(flat) <= limit, flat) \
            .otherwise(F.concat(F.substring(flat, 1, limit - 3), F.lit("...")))


def truncate_code(x, limit: int = MAX_CODE_CHARS) -> Column:
    """Code cut at ``limit`` characters with a truncation marker line."""
    c = F.coalesce(_c(x), F.lit(""))
    return F.when(F.length(c) <= limit, c) \
            .otherwise(F.concat(F.substring(c, 1, limit), F.lit(TRUNCATED_CODE_SUFFIX)))


def histogram_bucket(length) -> Column:
    """Label ``%04d-%04d`` of the 50-wide bucket holding ``length``."""
    start = F.floor(_c(length) / HISTOGRAM_WIDTH) * HISTOGRAM_WIDTH
    return F.format_string("%04d-%04d", start.cast("long"),
                           (start + HISTOGRAM_WIDTH - 1).cast("long"))


def first_line(x) -> Column:
    """Text before the first newline (the whole text when there is none)."""
    return F.substring_index(_c(x), "\n", 1)


def after_first_line(x) -> Column:
    """Text after the first newline; null when the text has no newline."""
    pos = F.instr(_c(x), "\n")
    return F.when(pos > 0, F.substring(_c(x), pos + 1, F.lit(2147483647)))
