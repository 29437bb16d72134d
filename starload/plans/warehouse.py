"""The warehouse load: dimensions and bridges, then facts and the bookmark."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import date_key
from starload.operators.bookmark import (
    changed_since,
    choose_load_mode,
    last_update,
    read_bookmark,
    seed_bookmark,
)
from starload.operators.facts import fact_delta, past_bookmark
from starload.operators.keys import highest_key
from starload.operators.merge import (
    advance_bookmark,
    insert_if_absent,
    keyed_names,
    timestamp,
    unseen_names,
    upsert_fact,
    upsert_scd1,
)
from starload.operators.names import bridge, list_names
from starload.schemas import BUCKETED, FACT, GAME_ATTRIBUTES
from starload.sources.calendar import FIRST_DAY, LAST_DAY, calendar
from starload.sources.store import Staged, Store, by_key

# list column in games, name dimension, its name and key columns, bridge table
NAME_DIMENSIONS = [
    ("publishers", "dim_publishers", "publisher_name", "publisher_key", "bridge_game_publishers"),
    ("genres", "dim_genres", "genre_name", "genre_key", "bridge_game_genres"),
]

# Dimensions whose keys are handed out here.
KEYED = ["dim_games", "dim_publishers", "dim_genres"]

FACTS_A_GAME = 8  # from so many snapshots a game on the planner alone decides how they meet the games


def create_warehouse(
    store: Store,
    load_ts: dt.datetime,
    start: dt.date = FIRST_DAY,
    end: dt.date = LAST_DAY,
    run_id: str = "create",
    layout: dict[str, int] | None = None,
) -> list[Staged]:
    """Add the calendar days and the bookmark row that are missing.

    `layout` chooses, once and for all, how many buckets a table is kept in (`games.buckets`, `dim_games.buckets`) and
    the keys of a dimension are handed out in (`dim_games.key_buckets` and so on); else the defaults of the schemas hold.
    """
    store.refresh()
    if store.is_published(run_id):
        return []
    days = insert_if_absent(
        store.read("dim_date"), calendar(store.spark, start, end), ["full_date"]
    )
    marks = insert_if_absent(
        store.read("etl_bookmark"), seed_bookmark(store.spark, load_ts), ["table_name"]
    )
    staged = [
        store.stage(run_id, "dim_date", days),
        store.stage(run_id, "etl_bookmark", marks),
    ]
    names = {f"{t}.buckets" for t in BUCKETED} | {f"{t}.key_buckets" for t in KEYED}
    wrong = [name for name, number in (layout or {}).items() if name not in names or number < 1]
    if wrong:
        raise ValueError(f"no number of buckets: {wrong}")
    store.publish(run_id, staged, layout)
    return staged


def load_dimensions(store: Store, run_id: str, load_ts: dt.datetime, mode: str) -> list[Staged]:
    """`incremental` only narrows the game dimension to games updated since its last update.

    Names and bridges are always taken from all games. A run that is already published is left alone.
    """
    store.refresh()
    if store.is_published(run_id):
        return []
    games, dim = store.read("games"), store.read("dim_games")
    since = last_update(dim) if mode == "incremental" else None
    staged = []
    if mode == "initial" or since is not None:
        source = changed_since(games, since).select("appid", *GAME_ATTRIBUTES)
        source, seen = store.work(run_id, "games_source", source)
        if seen["rows"]:
            start, buckets = highest_key(dim, "game_key"), store.key_buckets("dim_games")
            source = by_key(source, max(seen["rows"], store.rows("dim_games")))
            merged = lambda old: upsert_scd1(old, source, load_ts, start, buckets)
            staged.append(store.merge(run_id, "dim_games", source, seen["rows"], merged))
            dim = store.after(staged[-1])

    def names(spec: tuple[str, str, str, str, str]) -> list[Staged]:
        return _load_names(store, run_id, load_ts, games, dim, *spec)

    # Independent jobs: on a cluster they share the executors instead of waiting for each other.
    with ThreadPoolExecutor(len(NAME_DIMENSIONS)) as pool:
        for tables in pool.map(names, NAME_DIMENSIONS):
            staged += tables
    store.publish(run_id, staged)
    return staged


def _load_names(
    store: Store,
    run_id: str,
    load_ts: dt.datetime,
    games: DataFrame,
    dim_games: DataFrame,
    column: str,
    table: str,
    name: str,
    key: str,
    bridge_table: str,
) -> list[Staged]:
    """Add the names a list column brings, and rebuild its bridge."""
    staged = []
    known = store.read(table)
    unseen = unseen_names(known, list_names(games, column, name), name)
    unseen, seen = store.work(run_id, table, unseen)
    if seen["rows"]:
        fresh = keyed_names(unseen, name, key, load_ts, highest_key(known, key), store.key_buckets(table))
        staged.append(store.stage(run_id, table, fresh, appended=True))
        known = known.unionByName(store.read_staged(staged[-1]))
    pairs = bridge(by_key(games, store.rows("games")), dim_games, known, column, name, key)
    staged.append(store.stage(run_id, bridge_table, pairs))
    return staged


def _overlapped(store: Store, snapshots: DataFrame, low: dt.date) -> list[int]:
    """The months to merge: those of the snapshots to load, unless all their days are later than every day stored there.

    Told before anything is written, so that facts are written once. Nothing is read if the bookmark is at or past
    the last stored day, as it is after every load; else one column of the snapshots.
    """
    if (store.last_day(FACT) or 0) <= low.year * 10000 + low.month * 100 + low.day:
        return []
    dated = snapshots.select(date_key(F.col("recorded_date")).alias("date_key")).groupBy("date_key").agg(F.lit(1))
    days = dated.join(store.read("dim_date").select("date_key", "ym"), "date_key")
    found = {row.ym: row.first for row in days.groupBy("ym").agg(F.min("date_key").alias("first")).collect()}
    if not found or (store.last_day(FACT, list(found)) or 0) < min(found.values()):
        return []
    return sorted(found)


def load_facts(store: Store, run_id: str, load_ts: dt.datetime) -> list[Staged]:
    """Load snapshots past the bookmark, then move it to the last snapshot day.

    The last day is that of the state the load starts from, so snapshots that arrive meanwhile wait for the
    next run. Facts and bookmark are published together. A run that is already published is left
    alone.
    """
    store.refresh()
    if store.is_published(run_id):
        return []
    marks = store.read("etl_bookmark")
    low = read_bookmark(marks)
    months = store.months("snapshots")
    if not months:
        return []
    high = dt.datetime.strptime(str(store.last_day("snapshots")), "%Y%m%d").date()
    wanted = [m for m in months if m >= low.year * 100 + low.month]
    snapshots = past_bookmark(store.read("snapshots", parts=wanted), low, high)
    # Many facts a game cost more to shuffle than their games to broadcast, if the planner finds these small enough.
    few = store.rows("snapshots", wanted) < FACTS_A_GAME * store.rows("dim_games")
    dim_games = store.side("dim_games") if few else store.read("dim_games")
    delta = fact_delta(snapshots, dim_games, store.read("dim_date"))
    delta = delta.withColumn("created_at", timestamp(load_ts))

    touched = _overlapped(store, snapshots, low)
    if touched:
        merged = upsert_fact(store.read(FACT, parts=touched), delta.drop("created_at"), load_ts)
        facts = store.stage(run_id, FACT, merged)
    else:
        facts = store.stage(run_id, FACT, delta, appended=True)
    staged = [facts] if facts.rows else []
    staged.append(
        store.stage(run_id, "etl_bookmark", advance_bookmark(marks, FACT, high, load_ts))
    )
    store.publish(run_id, staged)
    return staged


class Loaded(str):
    """The load mode, with the rows that each step has written, by table."""

    rows: dict[str, int]

    def __new__(cls, mode: str, staged: list[Staged]):
        found = super().__new__(cls, mode)
        found.rows = {item.table: item.rows for item in staged}
        return found


def load_warehouse(store: Store, run_id: str, load_ts: dt.datetime) -> Loaded:
    """Dimensions first, then facts, each published on its own. Returns the load mode, which knows its row counts.

    A step that fails is repeated by the same call: steps published before it are not run again.
    """
    store.refresh()
    mode = choose_load_mode(store.read(FACT), store.read("dim_games"))
    staged = load_dimensions(store, f"{run_id}-dims", load_ts, mode)
    return Loaded(mode, staged + load_facts(store, f"{run_id}-facts", load_ts))
