"""Rollups, risers, genre trends, peaks and moving averages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from starload.operators.names import list_names
from starload.plans.analytics import between, mean, with_day


def most_active(
    events: DataFrame, who: str, when: str, as_of: dt.date, days: int = 14, n: int = 100
) -> DataFrame:
    """The n most active over the `days` days ending with `as_of`: `who`, activity."""
    first = as_of - dt.timedelta(days=days - 1)
    after = as_of + dt.timedelta(days=1)
    recent = events.filter(
        (F.col(when) >= F.lit(first).cast("timestamp_ntz"))
        & (F.col(when) < F.lit(after).cast("timestamp_ntz"))
    )
    return (
        recent.groupBy(who)
        .agg(F.count("*").alias("activity"))
        .orderBy(F.col("activity").desc(), F.col(who))
        .limit(n)
    )


def rollup(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Daily, weekly (from Monday) and monthly totals: grain, period_start, rows, ...

    Facts are read and shuffled once, to one row per day; the three grains are taken from those.
    """
    daily = fact.groupBy("date_key", "ym").agg(
        F.count("*").alias("rows"),
        F.count("ccu").alias("counted"),
        F.sum("ccu").alias("total"),
        F.max("ccu").alias("peak"),
    )
    day = F.col("full_date")
    grains = F.array(
        F.struct(F.lit("day").alias("grain"), day.alias("period_start")),
        F.struct(F.lit("week").alias("grain"), F.trunc(day, "week").alias("period_start")),
        F.struct(F.lit("month").alias("grain"), F.trunc(day, "month").alias("period_start")),
    )
    periods = with_day(daily, dim_date, "full_date").select(
        "rows", "counted", "total", "peak", F.inline(grains)
    )
    return (
        periods.groupBy("grain", "period_start")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("counted").alias("counted"),
            F.sum("total").alias("total_ccu"),
            F.max("peak").alias("peak_ccu"),
        )
        .select(
            "grain",
            "period_start",
            "rows",
            "total_ccu",
            mean("total_ccu", "counted").alias("avg_ccu"),
            "peak_ccu",
        )
    )


def risers(
    fact: DataFrame,
    dim_games: DataFrame,
    as_of: dt.date,
    n: int | None = None,
    rising: bool = True,
    days: int = 7,
) -> DataFrame:
    """Games by the change of their average count: the last `days` days against the `days` before.

    Games without facts in both halves have no change and are left out.
    """
    split = as_of - dt.timedelta(days=days - 1)
    first = split - dt.timedelta(days=days)
    window = between(fact, first, as_of)
    late = F.col("date_key") >= split.year * 10000 + split.month * 100 + split.day
    halves = (
        window.groupBy("game_key")
        .agg(
            F.avg(F.when(late, F.col("ccu"))).alias("recent_avg"),
            F.avg(F.when(~late, F.col("ccu"))).alias("earlier_avg"),
        )
        .withColumn("change", F.col("recent_avg") - F.col("earlier_avg"))
        .filter(F.col("change").isNotNull())
    )
    change = F.col("change").desc() if rising else F.col("change").asc()
    ranked = (
        halves.join(dim_games.select("game_key", "appid", "name"), "game_key")
        .select("appid", "name", "recent_avg", "earlier_avg", "change")
        .orderBy(change, "appid")
    )
    return ranked if n is None else ranked.limit(n)


def category_pairs(games: DataFrame, dim_games: DataFrame) -> DataFrame:
    """game_key, category from the stored list; categories have no dimension of their own."""
    keyed = games.select("appid", "categories").join(
        dim_games.select("appid", "game_key"), "appid"
    )
    return list_names(keyed, "categories", "category", "appid", "game_key").select(
        "game_key", "category"
    )


def monthly_trend(fact: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Per name and month: games, total_ccu, avg_ccu. `pairs` is game_key with one name column.

    Facts are summed to one row per game and month before the pairs multiply them.
    """
    per_game = fact.groupBy("game_key", "ym").agg(
        F.sum("ccu").alias("total"), F.count("ccu").alias("rows")
    )
    return (
        per_game.join(pairs.select("game_key", name), "game_key")
        .groupBy(name, "ym")
        .agg(
            F.count("*").alias("games"),
            F.sum("total").alias("total_ccu"),
            F.sum("rows").alias("rows"),
        )
        .select(name, "ym", "games", "total_ccu", mean("total_ccu", "rows").alias("avg_ccu"))
    )


def peak_and_average(fact: DataFrame, dim_games: DataFrame) -> DataFrame:
    """Per game: appid, name, peak_ccu, avg_ccu, days."""
    per_game = fact.groupBy("game_key").agg(
        F.max("ccu").alias("peak_ccu"), F.avg("ccu").alias("avg_ccu"), F.count("*").alias("days")
    )
    return per_game.join(dim_games.select("game_key", "appid", "name"), "game_key").select(
        "appid", "name", "peak_ccu", "avg_ccu", "days"
    )


def moving_average(fact: DataFrame, dim_games: DataFrame, rows: int = 7) -> DataFrame:
    """Per game and day: the average over the last `rows` stored days and the change since the day
    before. A game has at most one fact per calendar day, which bounds what one window holds."""
    by_game = Window.partitionBy("game_key").orderBy("date_key")
    series = fact.select(
        "game_key",
        "date_key",
        "ccu",
        F.avg("ccu").over(by_game.rowsBetween(1 - rows, 0)).alias("moving_avg"),
        (F.col("ccu") - F.lag("ccu").over(by_game)).alias("change"),
    )
    return series.join(dim_games.select("game_key", "appid"), "game_key").select(
        "appid", "date_key", "ccu", "moving_avg", "change"
    )
