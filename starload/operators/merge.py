"""Insert-or-overwrite on immutable files: DataFrame in, DataFrame out, no I/O.

One way to merge, whatever the size of the batch: the caller passes the part of the base that the
batch can touch (buckets or months), and both meet in one full outer join on the key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.keys import assign_keys
from starload.schemas import GAME_ATTRIBUTES, GAME_COLUMNS, KEY_BUCKETS, METRICS


def timestamp(moment: dt.datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def _overwrite(
    base: DataFrame,
    batch: DataFrame,
    keys: list[str],
    values: list[str],
    on_insert: dict[str, Column],
    on_match: dict[str, Column],
) -> DataFrame:
    """Full outer merge. The match flag decides, not NULL tests, so a batch NULL overwrites."""
    new = batch.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_in_batch")
    )
    old = base.withColumn("_in_base", F.lit(True))
    joined = old.join(new, keys, "full_outer")
    in_batch = F.col("_in_batch").isNotNull()
    in_base = F.col("_in_base").isNotNull()
    columns = []
    for name in base.columns:
        if name in keys:
            column = F.col(name)
        elif name in values:
            column = F.when(in_batch, F.col(f"_new_{name}")).otherwise(F.col(name))
        else:
            column = F.when(~in_base, on_insert[name])
            if name in on_match:
                column = column.when(in_batch, on_match[name])
            column = column.otherwise(F.col(name))
        columns.append(column.alias(name))
    return joined.select(*columns)


def upsert_current(base: DataFrame, batch: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Current-state games: overwrite every column on a match, NULLs too; keep `created_at`.

    `batch` holds one row per appid (see `last_wins`).
    """
    now = timestamp(load_ts)
    return _overwrite(
        base,
        batch,
        ["appid"],
        GAME_COLUMNS,
        on_insert={"created_at": now, "updated_at": now},
        on_match={"updated_at": now},
    )


def upsert_scd1(
    dim: DataFrame, source: DataFrame, load_ts: dt.datetime, start: int, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Game dimension: overwrite attributes in place, keep keys, give new games keys from `start`.

    `source` holds one row per appid; check it first, two different rows for one game are an error.
    """
    now = timestamp(load_ts)
    values = [c for c in GAME_ATTRIBUTES]
    merged = _overwrite(
        dim,
        source,
        ["appid"],
        values,
        on_insert={"game_key": F.lit(None).cast("bigint"), "created_at": now, "updated_at": now},
        on_match={"updated_at": now},
    )
    fresh = source.select("appid").join(dim.select("appid"), "appid", "left_anti")
    keys = assign_keys(fresh, "appid", "_key", start, buckets)
    return (
        merged.join(keys.hint("merge"), "appid", "left")  # both lie by game already
        .withColumn("game_key", F.coalesce("game_key", "_key"))
        .select(*dim.columns)
    )


def unseen_names(dim: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Distinct names an add-only dimension does not hold yet."""
    return names.select(name).distinct().join(dim.select(name), name, "left_anti")


def keyed_names(
    unseen: DataFrame, name: str, key: str, load_ts: dt.datetime, start: int = 0, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Rows to append to an add-only dimension."""
    return assign_keys(unseen, name, key, start, buckets).select(
        key, name, timestamp(load_ts).alias("created_at")
    )


def insert_if_absent(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """`base` plus the rows whose key it lacks; nothing is updated or deleted."""
    unseen = rows.join(base.select(*keys), keys, "left_anti")
    return base.unionByName(unseen.select(*base.columns))


def upsert_fact(fact: DataFrame, delta: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Facts by (game_key, date_key): overwrite the metrics on a match, keep `created_at`.

    Pass only the months the delta touches as `fact`; `ym` follows from `date_key`, so joining on
    it too changes nothing and lets Spark prune.
    """
    now = timestamp(load_ts)
    return _overwrite(
        fact,
        delta,
        ["game_key", "date_key", "ym"],
        METRICS,
        on_insert={"created_at": now},
        on_match={},
    )


def advance_bookmark(
    bookmark: DataFrame, table: str, last_loaded: dt.date | None, load_ts: dt.datetime
) -> DataFrame:
    """Update only: a missing row is not created, and an empty source changes nothing."""
    if last_loaded is None:
        return bookmark
    hit = F.col("table_name") == table
    return bookmark.select(
        "table_name",
        F.when(hit, F.lit(last_loaded)).otherwise(F.col("last_loaded_date")).alias("last_loaded_date"),
        F.when(hit, timestamp(load_ts)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
