"""From daily snapshots to keyed facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import date_key, year_month
from starload.schemas import METRICS


def one_per_day(days: DataFrame) -> DataFrame:
    """Mark a side with one row per calendar day for broadcast.

    The DATE range holds under 3.7 million days (years 1 to 9999), so a few dozen megabytes is the
    most it can reach, however large the tables are. A shuffle on the day would be worse than slow:
    few distinct values, and one may hold a third of the rows.
    """
    return F.broadcast(days)


def past_bookmark(
    snapshots: DataFrame, low: dt.date, high: dt.date | None = None
) -> DataFrame:
    """Snapshots strictly after `low`, up to and including `high`.

    Both bounds are literals on the stored column and on the storage month, so whole months and row
    groups are skipped.
    """
    kept = snapshots.filter(F.col("recorded_date") > F.lit(low))
    if high is not None:
        kept = kept.filter(F.col("recorded_date") <= F.lit(high))
    if "ym" in snapshots.columns:
        kept = kept.filter(F.col("ym") >= low.year * 100 + low.month)
        if high is not None:
            kept = kept.filter(F.col("ym") <= high.year * 100 + high.month)
    return kept


def fact_delta(snapshots: DataFrame, dim_games: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Snapshots with both keys found; a row without its game or its day drops out.

    The calendar comes first, so days outside it never reach the shuffle on the game.
    """
    dated = snapshots.withColumn("date_key", date_key(F.col("recorded_date"))).drop("ym")
    in_calendar = dated.join(one_per_day(dim_date.select("date_key", "ym")), "date_key")
    keyed = in_calendar.join(dim_games.select("appid", "game_key"), "appid")
    return keyed.select("game_key", "date_key", *METRICS, "ym")


def orphans(snapshots: DataFrame, dim_games: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Snapshots `fact_delta` drops, and why. Opt-in: the load itself drops them silently."""
    days = dim_date.select("date_key", F.lit(True).alias("has_day"))
    games = dim_games.select("appid", F.lit(True).alias("has_game"))
    marked = (
        snapshots.select("appid", "recorded_date")
        .withColumn("date_key", date_key(F.col("recorded_date")))
        .join(one_per_day(days), "date_key", "left")
        .join(games, "appid", "left")
    )
    reason = (
        F.when(F.col("has_day").isNull() & F.col("has_game").isNull(), "no_game_no_day")
        .when(F.col("has_game").isNull(), "no_game")
        .when(F.col("has_day").isNull(), "no_day")
    )
    return marked.select("appid", "recorded_date", reason.alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def guard_days(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The part of a snapshot batch whose day is not stored yet. A stored day is skipped whole."""
    days = one_per_day(stored.select("recorded_date").distinct())
    return batch.join(days, "recorded_date", "left_anti").select(*batch.columns)


def rows_of_stored_days(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """What `guard_days` leaves out."""
    days = one_per_day(stored.select("recorded_date").distinct())
    return batch.join(days, "recorded_date", "left_semi").select(*batch.columns)


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("ym", year_month(F.col("recorded_date")))
