"""Exact rounding of ratios, kept inside Catalyst expressions (no UDF).

The reports round averages and percentages half away from zero on exact
(arbitrary precision) quotients. Spark's ``avg`` over decimals and ``round``
over doubles both disagree with that on some inputs, so every rounded ratio
here is computed from integer sums with integer division:

    half_up(n, d, s) = ((2 * 10^s * n + d) div (2 * d)) / 10^s

valid for ``n >= 0`` and ``d > 0`` (NULL otherwise, like ``NULLIF(d, 0)``).
The final division by ``10^s`` happens on an exact integer, so the double
result is the correctly rounded one, identical across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def idiv(num, den) -> Column:
    """Integer (floor for non-negative inputs) division of two bigints."""
    return F.call_function("div", _c(num).cast("long"), _c(den).cast("long"))


def half_up_units(num, den, scale: int) -> Column:
    """``round(num/den, scale)`` as an integer count of ``10^-scale`` units."""
    n = _c(num).cast("long")
    d = _c(den).cast("long")
    m = 10 ** scale
    return F.when(d > 0, idiv(n * (2 * m) + d, d * 2))


def half_up(num, den, scale: int) -> Column:
    """``round(num/den, scale)`` half away from zero, as a double."""
    return half_up_units(num, den, scale).cast("double") / (10 ** scale)


def pct(num, den, scale: int) -> Column:
    """``round(100 * num / den, scale)``: a percentage of two counts."""
    return half_up(_c(num).cast("long") * 100, den, scale)


def completion_bp(duration_ms, song_duration_ms) -> Column:
    """Completion in basis points: ``round(least(d/s*100, 100), 2) * 100``.

    Inputs are already clamped (``d >= 0``, ``s >= 1``).
    """
    d = _c(duration_ms).cast("long")
    s = _c(song_duration_ms).cast("long")
    return F.least(idiv(d * 20000 + s, s * 2), F.lit(10000).cast("long"))


def bp_to_decimal(bp) -> Column:
    """Basis points to the stored ``decimal(5,2)`` percentage (exact)."""
    return (_c(bp).cast("decimal(7,0)") / 100).cast("decimal(5,2)")


def decimal_to_bp(pct_col) -> Column:
    """Stored ``decimal(5,2)`` percentage back to integer basis points (exact)."""
    return (_c(pct_col) * 100).cast("long")
