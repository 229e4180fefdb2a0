"""Exact half-up rounding against Python fractions."""

from __future__ import annotations

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.functions.exact import completion_bp, half_up, pct


def _exact_half_up(n: int, d: int, scale: int) -> float:
    m = 10 ** scale
    units = (2 * m * n + d) // (2 * d)
    return units / m


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 6)), min_size=1, max_size=40),
       st.integers(0, 3))
def test_half_up_matches_fractions(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(half_up("n", "d", scale)).collect()]
    for (n, d), g in zip(pairs, got):
        exact = Fraction(n, d) * 10 ** scale
        floor = exact.numerator // exact.denominator
        units = floor + (1 if exact - floor >= Fraction(1, 2) else 0)
        assert g == units / 10 ** scale == _exact_half_up(n, d, scale)


def test_half_up_null_on_zero_denominator(spark):
    df = spark.createDataFrame([(5, 0), (5, None)], "n long, d long")
    assert [r[0] for r in df.select(half_up("n", "d", 2)).collect()] == [None, None]


def test_known_roundings(spark):
    df = spark.createDataFrame([(123445, 1000000), (1, 8), (5, 1000)], "n long, d long")
    # 12.3445% -> 12.34 (a decimal AVG would give 12.35); 12.5% -> 12.5; 0.5% -> 0.5
    got = [r[0] for r in df.select(pct("n", "d", 2)).collect()]
    assert got == [12.34, 12.5, 0.5]


def test_completion_basis_points(spark):
    rows = [(1, 3), (1, 800), (0, 1000), (3000, 1), (205_000, 200_000), (200_000, 200_000), (2, 8)]
    df = spark.createDataFrame(rows, "d long, s long")
    got = [r[0] for r in df.select(completion_bp(F.col("d"), F.col("s"))).collect()]
    # 33.33%, 0.125% -> 0.13%, 0%, capped 100%, capped 100%, 100%, 25%
    assert got == [3333, 13, 0, 10000, 10000, 10000, 2500]
