"""Date series and the calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import calendar_columns

# Default calendar range (fixed values).
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


def daily(start: Column, end: Column) -> Column:
    """Inclusive array of days."""
    return F.sequence(start, end, F.expr("interval 1 day"))


def calendar(
    spark: SparkSession,
    start: dt.date = FIRST_DAY,
    end: dt.date = LAST_DAY,
    padded: bool = True,
) -> DataFrame:
    """The date dimension for start..end, both included."""
    days = spark.range(1).select(F.explode(daily(F.lit(start), F.lit(end))).alias("day"))
    return days.select(*calendar_columns(F.col("day"), padded))


def calendar_covering(df: DataFrame, day: Column, padded: bool = True) -> DataFrame:
    """The date dimension from the first to the last day found in `df`."""
    span = df.agg(F.min(day.cast("date")).alias("first"), F.max(day.cast("date")).alias("last"))
    days = span.select(F.explode(daily(F.col("first"), F.col("last"))).alias("day"))
    return days.select(*calendar_columns(F.col("day"), padded))
