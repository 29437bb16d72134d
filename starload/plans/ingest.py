"""One day's ingest: landed responses -> current games, daily snapshots, rejects."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starload.functions.dates import year_month
from starload.operators import checks
from starload.operators.dedupe import last_wins
from starload.operators.enrich import enrich, has_store_data, kept, rejected
from starload.operators.merge import timestamp, upsert_current
from starload.schemas import GAME_COLUMNS
from starload.sources.payloads import parse_app_details, parse_player_count, parse_top_list
from starload.sources.store import Staged, Store, by_key, empty_table, observed


class EmptyBatch(ValueError):
    """The run has no rows to store."""


def snapshot_rows(good: DataFrame, run_date: dt.date, load_ts: dt.datetime) -> DataFrame:
    """Enriched rows as snapshots of `run_date`."""
    day = F.lit(run_date)
    return good.select(
        "appid",
        "name",
        "score",
        "userscore",
        "owners",
        "average_playtime",
        "median_playtime",
        "ccu",
        day.alias("recorded_date"),
        timestamp(load_ts).alias("created_at"),
        year_month(day).alias("ym"),
    )


def day_is_stored(store: Store, run_date: dt.date) -> bool:
    """One stored row of the day is enough to skip the whole batch; reads one month, of a later day nothing."""
    if (store.last_day("snapshots") or 0) < run_date.year * 10000 + run_date.month * 100 + run_date.day:
        return False
    month = store.read("snapshots", parts=[run_date.year * 100 + run_date.month])
    return not month.filter(F.col("recorded_date") == F.lit(run_date)).isEmpty()


def ingest(
    store: Store,
    payloads: DataFrame,
    detail_responses: DataFrame,
    count_responses: DataFrame,
    run_date: dt.date,
    load_ts: dt.datetime,
    run_id: str,
    on_orphan: str = "fail",
) -> list[Staged]:
    """Parse, enrich, check and publish one run. Games, snapshots and rejects appear together.

    `on_orphan`: a snapshot whose game has never been stored ends the run (`fail`), or goes to the
    rejects (`quarantine`). A run that is already published is left alone, so a failed step can be
    repeated with the ones before it. Each staged table knows how many rows it holds.
    """
    if on_orphan not in ("fail", "quarantine"):
        raise ValueError(f"on_orphan is {on_orphan!r}")
    store.refresh()
    if store.is_published(run_id):
        return []
    enriched = enrich(
        parse_top_list(payloads),
        parse_app_details(detail_responses),
        parse_player_count(count_responses),
    )
    usable = F.col("reject_reason").isNull()
    enriched, seen = store.work(run_id, "enriched", enriched, usable=F.count_if(usable))
    if not seen["usable"]:
        raise EmptyBatch(f"run {run_id}: no usable games")
    good, bad = kept(enriched), rejected(enriched)
    staged = []

    batch = last_wins(
        good.filter(has_store_data()).select("appid", *GAME_COLUMNS, "payload_id", "pos"),
        ["appid"],
        ["payload_id", "pos"],
    ).drop("payload_id", "pos")
    batch, changed = store.work(run_id, "batch", batch)
    stored = store.read("games")
    if changed["rows"]:
        merged = lambda old: upsert_current(old, batch, load_ts)
        staged.append(store.merge(run_id, "games", batch, changed["rows"], merged))

    if not day_is_stored(store, run_date):
        snapshots = snapshot_rows(good, run_date, load_ts)
        known = stored.select("appid").unionByName(batch.select("appid")).distinct()
        known = by_key(known.withColumn("known", F.lit(True)), store.rows("games") + changed["rows"])
        judged = snapshots.join(known, "appid", "left")
        lost = judged.filter("known is null").select("appid", "name")
        seen, figures = Observation(), [F.count_if(F.col("known").isNull()).alias("unknown")]
        sound = judged.observe(seen, *figures).filter("known").select(*empty_table(store.spark, "snapshots").columns)
        staged.append(store.stage(run_id, "snapshots", sound, appended=True))
        if observed(seen, judged, figures)["unknown"]:
            if on_orphan == "fail":
                first = [row.asDict() for row in lost.limit(5).collect()]
                raise checks.CheckFailed(f"snapshots without a game: {first}")
            bad = bad.unionByName(lost.withColumn("reject_reason", F.lit("no_game")))

    bad = bad.withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)})
    staged.append(store.stage(run_id, "rejects", bad, appended=True))
    store.publish(run_id, staged)
    return staged
