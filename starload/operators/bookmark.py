"""Where the last load stopped. Every function reads at most one row to the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.merge import timestamp
from starload.schemas import FACT

# Start of time for a table without a bookmark (fixed value).
BEGINNING = dt.date(1900, 1, 1)


def seed_bookmark(spark: SparkSession, load_ts: dt.datetime, table: str = FACT) -> DataFrame:
    return spark.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(BEGINNING).alias("last_loaded_date"),
        timestamp(load_ts).alias("updated_at"),
    )


def read_bookmark(bookmark: DataFrame, table: str = FACT) -> dt.date:
    row = bookmark.filter(F.col("table_name") == table).select("last_loaded_date").first()
    return row[0] if row else BEGINNING


def last_day(snapshots: DataFrame) -> dt.date | None:
    """The latest day over all snapshots, loaded or not."""
    return snapshots.agg(F.max("recorded_date")).first()[0]


def last_update(dim: DataFrame) -> dt.datetime | None:
    return dim.agg(F.max("updated_at")).first()[0]


def changed_since(games: DataFrame, since: dt.datetime | None) -> DataFrame:
    """Games updated strictly after `since`; all of them when there is no `since`."""
    if since is None:
        return games
    return games.filter(F.col("updated_at") > timestamp(since))


def choose_load_mode(fact: DataFrame, dim_games: DataFrame) -> str:
    """`initial` while either table is empty. Reads one row of each, never a full count."""
    return "initial" if fact.isEmpty() or dim_games.isEmpty() else "incremental"
