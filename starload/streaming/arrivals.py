"""The daily load as a stream that runs until it has caught up.

Structured Streaming remembers which snapshot files it has seen; the day guard, the bookmark and the
checks stay as they are. A micro-batch keeps its number when it is run again, so its run id does too
and a repeat publishes nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.facts import guard_days, rows_of_stored_days, with_month
from starload.operators.merge import timestamp
from starload.plans.warehouse import load_facts
from starload.schemas import MAX_LENGTHS, REQUIRED
from starload.sources.store import Store, empty_table

ARRIVING = """appid int, name string, score int, userscore int, owners string,
    average_playtime int, median_playtime int, ccu int, recorded_date date"""


def _reason(columns: dict[str, int]) -> Column:
    """Why an arriving row cannot be stored, NULL if it can: a required column, then a text."""
    required = [F.when(F.col(c).isNull(), F.lit(f"no_{c}")) for c in REQUIRED["snapshots"]]
    texts = [F.when(F.char_length(c) > n, F.lit(f"long_{c}")) for c, n in columns.items()]
    return F.coalesce(*required, *texts)


def _one_per_key(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row of each key, the greatest by its other columns, and the rows that are left over.

    Equal rows are counted before they are shuffled, and a key's greatest row meets them in a join that can split a key
    of many different rows.
    """
    rest = [c for c in rows.columns if c not in keys]
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    greatest = counted.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    judged = counted.join(greatest, keys).withColumn("_first", F.struct(*rest) == F.col("_best"))
    over = F.col("_n") - F.col("_first").cast("int")
    left = judged.filter(over > 0).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), over)))
    return judged.filter("_first").select(*rows.columns), left.select(*rows.columns)


def store_arrivals(store: Store, batch: DataFrame, run_id: str, load_ts: dt.datetime) -> None:
    """Publish the snapshots of days not stored yet; rows that cannot be stored go to the rejects.

    Those lack the game's number or the day, name a game that is not stored, hold a text longer than declared
    (`no_...`, `long_...`), belong to a day that is stored already (`day_stored`) or repeat a game and day of the batch
    (`repeated`: the greatest row by its columns is stored). None of them keeps the others back.
    """
    store.refresh()
    if store.is_published(run_id):
        return
    games = store.read("games").select("appid", F.lit(True).alias("known"))
    judged = with_month(batch).withColumn("reject_reason", _reason(MAX_LENGTHS["snapshots"]))
    judged = judged.join(games, "appid", "left").withColumn(
        "reject_reason",
        F.coalesce("reject_reason", F.when(F.col("known").isNull(), F.lit("no_game"))),
    )
    judged, _ = store.work(run_id, "arrivals", judged.drop("known"))
    sound = judged.filter("reject_reason is null").drop("reject_reason")
    # Months of the batch only; at most one row per calendar month.
    months = [row.ym for row in sound.select("ym").distinct().collect()]
    stored = store.read("snapshots", months)
    first, left = _one_per_key(guard_days(sound, stored), ["appid", "recorded_date"])
    fresh = first.withColumn("created_at", timestamp(load_ts))
    columns = [F.col(c) for c in empty_table(store.spark, "snapshots").columns]
    added = store.stage(run_id, "snapshots", fresh.select(*columns), appended=True)

    lost = judged.filter("reject_reason is not null")
    for rows, reason in ((rows_of_stored_days(sound, stored), "day_stored"), (left, "repeated")):
        lost = lost.unionByName(rows.withColumn("reject_reason", F.lit(reason)))
    lost = lost.select(
        "appid",
        F.left("name", F.lit(MAX_LENGTHS["snapshots"]["name"])).alias("name"),
        "reject_reason",
        F.lit(load_ts.date()).alias("run_date"),
        F.lit(run_id).alias("run_id"),
    )
    store.publish(run_id, [added, store.stage(run_id, "rejects", lost, appended=True)])


def load_arrivals(
    store: Store, landing: str, checkpoint: str, load_ts: dt.datetime, name: str = "arrivals"
) -> None:
    """Take the Parquet snapshot files that landed since the last call, then load the facts."""
    stream = store.spark.readStream.schema(ARRIVING).parquet(landing)

    def each(batch: DataFrame, number: int) -> None:
        store_arrivals(store, batch, f"{name}-{number}", load_ts)
        load_facts(store, f"{name}-{number}-facts", load_ts)

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
