"""The calendar dimension: one row per day, key ``YYYYMMDD``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import date_key_of_date
from ..rules import CALENDAR_END as DATE_END
from ..rules import CALENDAR_START as DATE_START


def dim_date(spark: SparkSession, start: dt.date = DATE_START, end: dt.date = DATE_END) -> DataFrame:
    """2,922 rows for the default range; ISO week, Monday = 1.

    A few thousand rows at most (one per day), so it is always broadcast.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    dow = F.weekday(d) + 1
    return days.select(
        date_key_of_date(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_number"),
        dow.cast("int").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"),
    )


def populate_once(existing: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Populate-once guard: keep a non-empty existing dimension as it is."""
    if existing is not None and not existing.isEmpty():
        return existing
    return dim_date(spark)


def date_window(dates: DataFrame, as_of, days: int) -> DataFrame:
    """Date keys of the half-open window ``[as_of - days, as_of)``."""
    as_of = F.lit(as_of).cast("date") if not isinstance(as_of, F.Column) else as_of
    return dates.where((F.col("full_date") >= F.date_sub(as_of, days)) &
                       (F.col("full_date") < as_of)).select("date_key")


def labelled_windows(dates: DataFrame, as_of, window_days: int = 30) -> DataFrame:
    """``recent`` = [as_of - w, as_of), ``previous`` = [as_of - 2w, as_of - w)."""
    as_of = F.lit(as_of).cast("date") if not isinstance(as_of, F.Column) else as_of
    fd = F.col("full_date")
    label = (F.when(fd >= F.date_sub(as_of, window_days), F.lit("recent"))
             .when(fd >= F.date_sub(as_of, 2 * window_days), F.lit("previous")))
    return (dates.where((fd >= F.date_sub(as_of, 2 * window_days)) & (fd < as_of))
            .select("date_key", label.alias("window_label")))
