"""Many-to-many names held as JSON lists: unnest, name dimensions, bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.jsontext import clean_names


def list_names(games: DataFrame, column: str, name: str, *keep: str) -> DataFrame:
    """One row per game and listed name: trimmed, no blanks, no repeats within a list."""
    listed = games.filter(F.col(column).isNotNull() & (F.col(column) != "[]"))
    return listed.select(*keep, F.explode(clean_names(F.col(column))).alias(name))


def bridge(
    games: DataFrame, dim_games: DataFrame, dim: DataFrame, column: str, name: str, key: str
) -> DataFrame:
    """Distinct (game_key, `key`) pairs of every game.

    The list column is unnested after the join on `appid`, and the pairs are made distinct while
    the rows are still partitioned by game, so `distinct` reuses that partitioning. The join on the
    name comes last; a name listed by a third of all games is split by the adaptive skew join when
    the name dimension is too big to broadcast.
    """
    keyed = games.select("appid", column).join(dim_games.select("appid", "game_key"), "appid")
    pairs = list_names(keyed, column, name, "appid", "game_key").distinct()
    return pairs.join(dim.select(name, key), name).select("game_key", key)
