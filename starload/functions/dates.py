"""Calendar expressions: smart keys, weekday numbers, padded names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_month(day: Column) -> Column:
    """yyyymm as an integer: the storage partition of snapshots and facts."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def weekday(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("int")


def day_name(day: Column, padded: bool = True) -> Column:
    name = F.date_format(day, "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def month_name(day: Column, padded: bool = True) -> Column:
    name = F.date_format(day, "MMMM")
    return F.rpad(name, 9, " ") if padded else name


def calendar_columns(day: Column, padded: bool = True) -> list[Column]:
    """Every column of the date dimension from one date."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        weekday(day).alias("day_of_week"),
        day_name(day, padded).alias("day_name"),
        F.month(day).cast("int").alias("month"),
        month_name(day, padded).alias("month_name"),
        F.quarter(day).cast("int").alias("quarter"),
        F.year(day).cast("int").alias("year"),
        weekday(day).isin(0, 6).alias("is_weekend"),
        year_month(day).alias("ym"),
    ]
