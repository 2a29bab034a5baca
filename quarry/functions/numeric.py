"""Exact, engine-independent numeric helpers.

Averages are rounded half-up on the exact rational value with integer
arithmetic, and score sums are taken over fixed-point integers, so the result
does not depend on the shuffle order or on how an engine rounds a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-point resolution of summed scores (1e-9).
SCORE_SCALE = 1_000_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_ratio(numerator_sql: str, denominator_sql: str, digits: int) -> Column:
    """``round(a / b, digits)`` half-up on the exact rational value, for
    integer SQL expressions ``a >= 0`` and ``b >= 1``; returns a double.

    Uses integer division (``div``), exact for any long inputs whose scaled
    numerator fits in a long."""
    p = 10 ** digits
    a, b = f"CAST(({numerator_sql}) AS BIGINT)", f"CAST(({denominator_sql}) AS BIGINT)"
    return F.expr(f"CAST((({2 * p} * {a} + {b}) div (2 * {b})) AS DOUBLE) / CAST({p} AS DOUBLE)")


def to_fixed(x) -> Column:
    """A double as a fixed-point long at 1e-9 (half-up)."""
    return F.floor(_c(x) * F.lit(float(SCORE_SCALE)) + F.lit(0.5)).cast("long")


def from_fixed(x, digits: int = 6) -> Column:
    """Fixed-point long back to a double rounded half-up to ``digits``
    decimals; the rounding happens on the integer, so no engine-specific
    rounding of doubles is involved."""
    step = SCORE_SCALE // 10 ** digits
    units = F.floor((_c(x) + F.lit(step // 2)) / F.lit(float(step)))
    return units / F.lit(float(10 ** digits))


def round6(x) -> Column:
    """A double rounded to 6 decimals through the fixed-point grid (the same
    arithmetic is written in the SQL oracle)."""
    return from_fixed(to_fixed(x), 6)
