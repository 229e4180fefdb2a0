"""Column-cleaning expressions of the analytics load (all built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import SUBSCRIPTION_TYPES, UNKNOWN_SUBSCRIPTION


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(col) -> Column:
    return F.trim(_c(col))


def upper_trim(col) -> Column:
    return F.upper(F.trim(_c(col)))


def lower_trim(col) -> Column:
    return F.lower(F.trim(_c(col)))


def lower_trim_nullif_empty(col) -> Column:
    """``LOWER(TRIM(NULLIF(x, '')))``: '' becomes NULL, blanks become ''."""
    return F.lower(F.trim(F.nullif(_c(col), F.lit(""))))


def valid_subscription(col) -> Column:
    """Lower/trim the value; anything outside the known domain is 'unknown'."""
    cleaned = lower_trim(col)
    return F.when(cleaned.isin(*SUBSCRIPTION_TYPES), cleaned).otherwise(F.lit(UNKNOWN_SUBSCRIPTION))


def default_false(col) -> Column:
    return F.coalesce(_c(col), F.lit(False))


def date_key_of(ts_col) -> Column:
    """``YYYYMMDD`` integer of an instant's UTC calendar day (session zone UTC)."""
    d = F.to_date(_c(ts_col))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_of_date(date_col) -> Column:
    d = _c(date_col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
