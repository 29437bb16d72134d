"""Questions over the star. Facts are cut to the months asked for and aggregated before they are
joined, so the wide joins see one row per game (and day of week, or month), not one per fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.facts import one_per_day


def key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def month_of(day: dt.date) -> int:
    return day.year * 100 + day.month


def between(fact: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Facts of first..last. Literals on the storage month and the day key: whole folders and row
    groups are skipped at planning time."""
    if first is not None:
        fact = fact.filter((F.col("ym") >= month_of(first)) & (F.col("date_key") >= key_of(first)))
    if last is not None:
        fact = fact.filter((F.col("ym") <= month_of(last)) & (F.col("date_key") <= key_of(last)))
    return fact


def with_day(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Join the calendar on the day and on the storage month, which lets Spark prune by it."""
    return fact.join(one_per_day(dim_date.select("date_key", "ym", *columns)), ["date_key", "ym"])


def mean(total: str, rows: str) -> Column:
    """Average from a sum and a count taken earlier; NULL without rows."""
    return F.try_divide(F.col(total), F.col(rows)).cast("double")


def game_series(
    fact: DataFrame,
    dim_games: DataFrame,
    dim_date: DataFrame,
    appid: int,
    as_of: dt.date,
    days: int = 30,
) -> DataFrame:
    """One game's player counts since `days` before `as_of`: name, ccu, full_date.

    A game is one row of the dimension, so its key and name are scalars: the facts are filtered by a
    column that their files are sorted by, and not shuffled.
    """
    game = dim_games.filter(F.col("appid") == appid).agg(F.max(F.struct("game_key", "name")).alias("g"))
    recent = between(fact, as_of - dt.timedelta(days=days))
    own = recent.filter(F.col("game_key") == game.select("g.game_key").scalar())
    named = own.withColumn("name", game.select("g.name").scalar())
    return (
        with_day(named, dim_date, "full_date")
        .select("name", "ccu", "full_date")
        .orderBy(F.col("full_date").asc_nulls_last())
    )


def top_games(fact: DataFrame, dim_games: DataFrame, day: dt.date, n: int = 10) -> DataFrame:
    """The n games with the highest count on a day: game_key, appid, name, ccu.

    A NULL count ranks first; equal counts go by appid. The n-th highest count is found first, from
    n rows per task, so only games that reach it (ties included) are joined with the dimension.
    """
    rank = F.coalesce(F.col("ccu").cast("bigint"), F.lit(2**31))
    on_day = between(fact, day, day).select("game_key", "ccu", rank.alias("rank"))
    least = on_day.orderBy(F.col("rank").desc()).limit(n).agg(F.min("rank"))
    contenders = on_day.filter(F.col("rank") >= least.scalar())
    return (
        contenders.join(dim_games.select("game_key", "appid", "name"), "game_key")
        .orderBy(F.col("rank").desc(), F.col("appid"))
        .limit(n)
        .drop("rank")
    )


def top_games_by_weekday(
    fact: DataFrame,
    dim_games: DataFrame,
    dim_date: DataFrame,
    as_of: dt.date,
    n: int = 10,
    days: int = 30,
) -> DataFrame:
    """Average count by weekday of the day's top games: name, day_of_week, avg_ccu.

    Grouped by name, so two games of one name are one line. The list already holds the names, so
    the facts meet n rows and no dimension.
    """
    top = top_games(fact, dim_games, as_of, n).select("game_key", "name")
    recent = between(fact, as_of - dt.timedelta(days=days)).join(top, "game_key")
    return (
        with_day(recent, dim_date, "day_of_week")
        .groupBy("name", "day_of_week")
        .agg(F.avg("ccu").alias("avg_ccu"))
        .orderBy(F.col("name").asc_nulls_last(), F.col("day_of_week").asc_nulls_last())
    )


def games_by_weekday(
    fact: DataFrame, dim_games: DataFrame, dim_date: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    """Average count by weekday of every game: name, day_of_week, avg_ccu.

    Facts are summed to one row per game with a slot for each weekday, so that the sums meet the dimension where the
    one shuffle by game has put them; the slots become rows after that.
    """
    recent = between(fact, as_of - dt.timedelta(days=days))
    sums = []
    for number in range(7):
        on_day = F.when(F.col("day_of_week") == number, F.col("ccu"))
        sums += [
            F.count_if(F.col("day_of_week") == number).alias(f"n{number}"),
            F.sum(on_day).alias(f"total{number}"),
            F.count(on_day).alias(f"rows{number}"),
        ]
    slots = [
        F.struct(F.lit(k).alias("day_of_week"), *[F.col(f"{c}{k}").alias(c) for c in ("n", "total", "rows")]) for k in range(7)
    ]
    per_game = with_day(recent, dim_date, "day_of_week").groupBy("game_key").agg(*sums)
    return (
        per_game.join(dim_games.select("game_key", "name"), "game_key")
        .select("name", F.inline(F.array(*slots)))
        .filter("n > 0")
        .groupBy("name", "day_of_week")
        .agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
        .select("name", "day_of_week", mean("total", "rows").alias("avg_ccu"))
    )


def total_series(
    fact: DataFrame,
    dim_date: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Players over all games per day: full_date, games, total_ccu."""
    per_day = (
        between(fact, first, last)
        .groupBy("date_key", "ym")
        .agg(F.count("*").alias("games"), F.sum("ccu").alias("total_ccu"))
    )
    return (
        with_day(per_day, dim_date, "full_date")
        .select("full_date", "games", "total_ccu")
        .orderBy("full_date")
    )


def compare_games(
    fact: DataFrame,
    dim_games: DataFrame,
    metric: str = "ccu",
    n: int | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Games ranked by the average of a metric: appid, name, days, average, highest."""
    per_game = (
        between(fact, first, last)
        .groupBy("game_key")
        .agg(
            F.count("*").alias("days"),
            F.avg(metric).alias("average"),
            F.max(metric).alias("highest"),
        )
    )
    ranked = (
        per_game.join(dim_games.select("game_key", "appid", "name"), "game_key")
        .select("appid", "name", "days", "average", "highest")
        .orderBy(F.col("average").desc_nulls_first(), F.col("appid"))
    )
    return ranked if n is None else ranked.limit(n)


def games_named(bridge: DataFrame, dim: DataFrame, key: str, name: str, values: list[str]) -> DataFrame:
    """game_key of every game linked to one of the names."""
    chosen = dim.filter(F.col(name).isin(values)).select(key)
    return bridge.join(chosen, key, "left_semi").select("game_key")


def drill_down(
    fact: DataFrame,
    dim_games: DataFrame,
    dim_date: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    *linked: DataFrame,
) -> DataFrame:
    """Facts of a date range whose game is in every list given (see `games_named`).

    Semi-joins, so a game linked to several of the names still counts once.
    """
    chosen = between(fact, first, last)
    for games in linked:
        chosen = chosen.join(games, "game_key", "left_semi")
    return (
        with_day(chosen, dim_date, "full_date")
        .join(dim_games.select("game_key", "appid", "name"), "game_key")
        .select("appid", "name", "full_date", "ccu", "score", "userscore")
    )


def genre_performance(
    fact: DataFrame, bridge: DataFrame, dim: DataFrame, key: str = "genre_key", name: str = "genre_name"
) -> DataFrame:
    """Per genre (or publisher): games, total_ccu, avg_ccu, peak_ccu.

    A game counts in each of its genres, so totals do not add up across genres. Facts are summed to
    one row per game before the bridge multiplies them.
    """
    per_game = fact.groupBy("game_key").agg(
        F.sum("ccu").alias("total"), F.count("ccu").alias("rows"), F.max("ccu").alias("peak")
    )
    per_key = (
        per_game.join(bridge.select("game_key", key), "game_key")
        .groupBy(key)
        .agg(
            F.count("*").alias("games"),
            F.sum("total").alias("total_ccu"),
            F.sum("rows").alias("rows"),
            F.max("peak").alias("peak_ccu"),
        )
    )
    return per_key.join(dim.select(key, name), key).select(
        name, "games", "total_ccu", mean("total_ccu", "rows").alias("avg_ccu"), "peak_ccu"
    )
