"""Every operator as a query over the generated tables: name -> (spark, folder) -> DataFrame.

Surrogate keys stay out of the results; only natural keys can be compared between engines.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import date_key
from starload.operators import checks
from starload.operators.bookmark import (
    changed_since,
    choose_load_mode,
    last_day,
    last_update,
    read_bookmark,
    seed_bookmark,
)
from starload.operators.dedupe import last_wins
from starload.operators.enrich import enrich, has_store_data, kept, rejected
from starload.operators.facts import (
    fact_delta,
    guard_days,
    orphans,
    past_bookmark,
    with_month,
)
from starload.operators.keys import assign_keys, highest_key
from starload.operators.merge import (
    advance_bookmark,
    insert_if_absent,
    keyed_names,
    timestamp,
    unseen_names,
    upsert_current,
    upsert_fact,
    upsert_scd1,
)
from starload.operators.names import bridge, list_names
from starload.plans import analytics, trends
from starload.plans.ingest import ingest
from starload.plans.warehouse import (
    NAME_DIMENSIONS,
    create_warehouse,
    load_dimensions,
    load_facts,
    load_warehouse,
)
from starload.schemas import FACT, GAME_ATTRIBUTES, METRICS
from starload.session import checkpointed, scratch_root, settle
from starload.sources import standin
from starload.sources.calendar import calendar, calendar_covering
from starload.sources.payloads import (
    parse_app_details,
    parse_player_count,
    parse_top_list,
    read_payloads,
    read_response_lines,
)
from starload.sources.store import Store, empty_table
from starload.streaming.arrivals import ARRIVING, store_arrivals

DAY_ONE = dt.datetime(2024, 1, 15)
DAY_TWO = dt.datetime(2024, 3, 1)
AS_OF = dt.date(2024, 1, 30)
SPLIT = dt.date(1998, 12, 31)


@dataclass
class Star:
    games: DataFrame
    dim_games: DataFrame
    dim_date: DataFrame
    fact: DataFrame


def _dim_games(spark: SparkSession, games: DataFrame) -> DataFrame:
    source = games.select("appid", *GAME_ATTRIBUTES)
    return upsert_scd1(empty_table(spark, "dim_games"), source, DAY_ONE, start=0)


def _shipments(spark: SparkSession, folder: str, names: bool = False, dim: bool = True) -> Star:
    """Star over line items. What a query reads more than once is kept: the games if it needs their names too, their
    dimension unless only the facts need it."""
    lineitem = standin.table(spark, folder, "lineitem")
    keep = lambda df, often: checkpointed(df) if often else df
    games = keep(standin.games(standin.table(spark, folder, "part")), names)
    dim = keep(_dim_games(spark, games), dim)
    days = calendar_covering(lineitem, F.col("l_shipdate"))
    return Star(games, dim, days, fact_delta(standin.shipment_snapshots(lineitem), dim, days))


def _activity(spark: SparkSession, folder: str) -> Star:
    """Star over events, with the default calendar."""
    snapshots = standin.event_snapshots(standin.table(spark, folder, "events"))
    games = standin.games(standin.table(spark, folder, "part"))
    dim, days = checkpointed(_dim_games(spark, games)), calendar(spark)
    return Star(games, dim, days, fact_delta(snapshots, dim, days))


def _names(spark: SparkSession, games: DataFrame, column: str, table: str, name: str, key: str):
    unseen = unseen_names(empty_table(spark, table), list_names(games, column, name), name)
    return checkpointed(keyed_names(unseen, name, key, DAY_ONE))


def _genres(spark: SparkSession, star: Star):
    dim = _names(spark, star.games, "genres", "dim_genres", "genre_name", "genre_key")
    pairs = bridge(star.games, star.dim_games, dim, "genres", "genre_name", "genre_key")
    return dim, pairs


def _publishers(spark: SparkSession, star: Star):
    dim = _names(
        spark, star.games, "publishers", "dim_publishers", "publisher_name", "publisher_key"
    )
    pairs = bridge(
        star.games, star.dim_games, dim, "publishers", "publisher_name", "publisher_key"
    )
    return dim, pairs


# Parsing and ingest -----------------------------------------------------------------------


def s1_parse_top_list(spark, folder):
    part = standin.table(spark, folder, "part")
    return parse_top_list(standin.list_payloads(part)).drop("payload_id", "pos")


def s2_app_details(spark, folder):
    part = standin.table(spark, folder, "part")
    return parse_app_details(standin.detail_responses(part))


def s3_player_count(spark, folder):
    part = standin.table(spark, folder, "part")
    return parse_player_count(standin.count_responses(part))


def _enriched(spark, folder):
    part = standin.table(spark, folder, "part")
    return enrich(
        parse_top_list(standin.list_payloads(part)),
        parse_app_details(standin.detail_responses(part)),
        parse_player_count(standin.count_responses(part)),
    )


def j1_enrich(spark, folder):
    columns = ["appid", "name", "score", "ccu", "price_final", "price_currency", "short_description"]
    return kept(_enriched(spark, folder)).select(*columns, "developers", "categories", "genres")


def p11_rejects(spark, folder):
    return rejected(_enriched(spark, folder))


def p7_gate(spark, folder):
    raw = standin.raw_games(standin.table(spark, folder, "part"))
    return raw.filter(has_store_data()).select("appid", "price_initial", "short_description")


def s7_snapshot_guard(spark, folder):
    offered = standin.event_snapshots(standin.table(spark, folder, "events"))
    stored = offered.filter(F.col("recorded_date") <= F.lit(dt.date(2024, 1, 20)))
    return guard_days(offered, stored).select("appid", "recorded_date", "ccu")


def a7_last_wins(spark, folder):
    events = standin.table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return last_wins(events, ["user_id"], ["ts", "event_id"]).drop("ts")


def m1_upsert_games(spark, folder):
    """Discontinued types keep their rows, large ones are overwritten, small ones are new."""
    raw = standin.raw_games(standin.table(spark, folder, "part"))
    kind = F.get_json_object("categories", "$[0]")
    created = timestamp(dt.datetime(2023, 6, 1))
    base = raw.filter(kind != "SMALL").select(
        *[created.alias(c) if c in ("created_at", "updated_at") else c for c in raw.columns]
    )
    offers = raw.filter(kind.isin("SMALL", "LARGE"))
    versions = offers.select(
        "*", F.inline(F.array(*[F.struct(F.lit(i).alias("position")) for i in (1, 2)]))
    )
    latest = last_wins(
        versions.withColumn("price_final", F.col("price_final") + F.col("position")).withColumn(
            "short_description",
            F.when(F.col("price_discount_percent") > 25, F.col("short_description")),
        ),
        ["appid"],
        ["position"],
    ).drop("position", "created_at", "updated_at")
    merged = upsert_current(base, latest, DAY_TWO)
    return merged.select(
        "appid",
        "name",
        "price_final",
        "short_description",
        "genres",
        F.col("created_at").cast("date").alias("created_on"),
        F.col("updated_at").cast("date").alias("updated_on"),
    )


def _ingested(spark, folder) -> Store:
    """Two days and a repeat of the second; on day two small sizes lose their description."""
    part = standin.table(spark, folder, "part")
    store = Store(spark, scratch_root(spark))
    runs = [
        ("day-1", dt.datetime(2024, 5, 1, 6), 0),
        ("day-2", dt.datetime(2024, 5, 2, 6), 12),
        ("day-2-again", dt.datetime(2024, 5, 2, 9), 12),
    ]
    for run_id, now, described in runs:
        ingest(
            store,
            standin.list_payloads(part),
            standin.detail_responses(part, described),
            standin.count_responses(part),
            now.date(),
            now,
            run_id,
            on_orphan="quarantine",
        )
    return store


def c6_ingest_games(spark, folder):
    return _ingested(spark, folder).read("games").select(
        "appid",
        "name",
        "price_final",
        "short_description",
        "publishers",
        F.date_format("created_at", "yyyy-MM-dd HH").alias("created"),
        F.date_format("updated_at", "yyyy-MM-dd HH").alias("updated"),
    )


def c6_ingest_snapshots(spark, folder):
    return _ingested(spark, folder).read("snapshots").select(
        "appid", "name", "recorded_date", "ccu", "score", "userscore", "owners",
        "average_playtime", "median_playtime",
        F.date_format("created_at", "yyyy-MM-dd HH").alias("created"),
    )


def p11_stored_rejects(spark, folder):
    return _ingested(spark, folder).read("rejects").select("appid", "name", "reject_reason", "run_date", "run_id")


def _arrived(spark, folder) -> Store:
    """Two micro-batches: rows of the first come twice where an error was logged, the second begins with stored days."""
    store = Store(spark, scratch_root(spark))
    games = standin.games(standin.table(spark, folder, "part")).select(*empty_table(spark, "games").columns)
    store.publish("games", [store.stage("games", "games", games)])
    offered = standin.event_snapshots(standin.table(spark, folder, "events"))
    offered = offered.withColumn("name", F.lit(None).cast("string")).select(*spark.createDataFrame([], ARRIVING).columns)
    first = offered.filter(F.col("recorded_date") <= F.lit(dt.date(2024, 1, 20)))
    twice = first.filter(F.col("userscore") > 0).withColumn("ccu", F.col("ccu") * 2)
    store_arrivals(store, first.unionByName(twice), "batch-1", DAY_ONE)
    store_arrivals(store, offered.filter(F.col("recorded_date") >= F.lit(dt.date(2024, 1, 18))), "batch-2", DAY_TWO)
    return store


def p11_stored_arrivals(spark, folder):
    return _arrived(spark, folder).read("rejects").select("appid", "reject_reason", "run_date", "run_id")


def s7_stored_arrivals(spark, folder):
    return _arrived(spark, folder).read("snapshots").select("appid", "recorded_date", "ccu", "score", "userscore")


def e2e_weekday(spark, folder):
    """From files to an answer: lists of a hundred games each and packed responses are landed, read back, ingested for
    two days, loaded, and asked for the average count by weekday of the second day's ten top games."""
    landing, store = scratch_root(spark), Store(spark, scratch_root(spark))
    size = F.col("p_size")  # a game without any name is none
    part = standin.table(spark, folder, "part").withColumn("p_size", F.when(size == 23, 25).otherwise(size))
    create_warehouse(store, DAY_ONE)
    for number, day in enumerate((dt.datetime(2024, 5, 4, 6), dt.datetime(2024, 5, 5, 6))):
        files = f"{landing}/{number}"
        standin.land(part, files, number * 50)
        ingest(
            store,
            read_payloads(spark, f"{files}/list"),
            read_response_lines(spark, f"{files}/details"),
            read_response_lines(spark, f"{files}/counts"),
            day.date(),
            day,
            f"ingest-{number}",
            on_orphan="quarantine",
        )
        load_warehouse(store, f"load-{number}", day)
    return analytics.top_games_by_weekday(
        store.read(FACT), store.side("dim_games"), store.read("dim_date"), day.date()
    )


# Dimensions -------------------------------------------------------------------------------


def s5_calendar(spark, folder):
    lineitem = standin.table(spark, folder, "lineitem")
    return calendar_covering(lineitem, F.col("l_shipdate"))


def m2_scd1(spark, folder):
    """Games of the first fortnight, then those updated after the dimension's last update."""
    games = standin.games(standin.table(spark, folder, "part"))
    games = checkpointed(games)
    first = games.filter(F.col("updated_at") <= timestamp(DAY_ONE))
    dim = checkpointed(_dim_games(spark, first))
    changed = changed_since(games, last_update(dim))
    source = changed.select("appid", *GAME_ATTRIBUTES).withColumn("price_currency", F.lit("EUR"))
    resent = first.select("appid", *GAME_ATTRIBUTES).filter(F.col("short_description") == "PROMO")
    resent = resent.withColumn("short_description", F.lit(None).cast("string"))
    source = source.unionByName(resent).distinct()
    start = dim.agg(F.max("game_key")).first()[0] or 0
    merged = upsert_scd1(dim, source, DAY_TWO, start)
    return merged.select(
        "appid",
        *GAME_ATTRIBUTES,
        F.col("created_at").cast("date").alias("created_on"),
        F.col("updated_at").cast("date").alias("updated_on"),
    )


def k1_dense_keys(spark, folder):
    orders = standin.table(spark, folder, "lineitem").select("l_orderkey").distinct()
    keyed = assign_keys(orders, "l_orderkey", "order_key")
    return keyed.agg(
        F.count("*").alias("n"),
        F.min("order_key").alias("lowest"),
        F.max("order_key").alias("highest"),
        F.count_distinct("order_key").alias("different"),
    )


def k1_second_load(spark, folder):
    """Orders of the first period get keys, then all others: each order's load, told from its key."""
    lineitem = standin.table(spark, folder, "lineitem")
    orders = lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("first_day"))
    early = F.col("first_day") <= F.lit(SPLIT)
    first = assign_keys(orders.filter(early).select("l_orderkey"), "l_orderkey", "order_key")
    first = checkpointed(first)
    start = highest_key(first, "order_key")
    unseen = orders.select("l_orderkey").join(first, "l_orderkey", "left_anti")
    both = first.unionByName(assign_keys(unseen, "l_orderkey", "order_key", start))
    load = F.when(F.col("order_key") <= start, 1).otherwise(2)
    return both.select("l_orderkey", load.alias("loaded_by"))


def j6_unnest(spark, folder):
    games = standin.games(standin.table(spark, folder, "part"))
    return list_names(games, "publishers", "publisher_name", "appid")


def m3_publishers(spark, folder):
    """Two loads: names of early games first, then of all games; known names keep their row."""
    games = standin.games(standin.table(spark, folder, "part"))
    early = games.filter(F.col("updated_at") <= timestamp(DAY_ONE))
    name, key = "publisher_name", "publisher_key"
    dim = _names(spark, early, "publishers", "dim_publishers", name, key)
    start = dim.agg(F.max(key)).first()[0] or 0
    unseen = unseen_names(dim, list_names(games, "publishers", name), name)
    both = dim.unionByName(keyed_names(unseen, name, key, DAY_TWO, start))
    return both.select(name, F.col("created_at").cast("date").alias("created_on"))


def m3_genres(spark, folder):
    games = standin.games(standin.table(spark, folder, "part"))
    return _names(spark, games, "genres", "dim_genres", "genre_name", "genre_key").select("genre_name")


def m3_insert_if_absent(spark, folder):
    """Calendar days already present stay as they are; only the missing ones are added."""
    lineitem = standin.table(spark, folder, "lineitem")
    days = calendar_covering(lineitem, F.col("l_shipdate"))
    known = days.filter(F.col("year") <= 1998).withColumn("day_name", F.lit("kept"))
    return insert_if_absent(known, days, ["full_date"]).select("full_date", "day_name")


def _bridge_pairs(spark, folder, load, key, name):
    star = _shipments(spark, folder, names=True)
    dim, pairs = load(spark, star)
    return (
        pairs.join(star.dim_games.select("game_key", "appid"), "game_key")
        .join(dim.select(key, name), key)
        .select("appid", name)
    )


def m6_bridge_publishers(spark, folder):
    return _bridge_pairs(spark, folder, _publishers, "publisher_key", "publisher_name")


def m6_bridge_genres(spark, folder):
    return _bridge_pairs(spark, folder, _genres, "genre_key", "genre_name")


# Facts and load control -------------------------------------------------------------------


def _natural(fact: DataFrame, dim_games: DataFrame) -> DataFrame:
    return fact.join(dim_games.select("game_key", "appid"), "game_key").select(
        "appid", "date_key", *METRICS
    )


def c5_fact_full(spark, folder):
    star = _shipments(spark, folder)
    return _natural(star.fact, star.dim_games)


def _delivered(spark, folder, first_part) -> tuple[Store, DataFrame]:
    """A store with a warehouse, all games and the snapshots that `first_part` selects; all snapshots of these games (a
    store takes no others)."""
    games = standin.games(standin.table(spark, folder, "part")).select(*empty_table(spark, "games").columns)
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    snapshots = snapshots.join(games.select("appid"), "appid", "left_semi")
    snapshots = with_month(snapshots).select(
        "*", F.lit(None).cast("string").alias("name"), timestamp(DAY_ONE).alias("created_at")
    )
    snapshots = snapshots.select(*empty_table(spark, "snapshots").columns)
    store = Store(spark, scratch_root(spark))
    day = F.col("recorded_date")
    first, last = snapshots.agg(F.min(day), F.max(day)).first()
    create_warehouse(store, DAY_ONE, *([first, last] if first else []))
    # Independent jobs: the games, often one task, do not keep the cluster waiting.
    with ThreadPoolExecutor(1) as pool:
        staged = pool.submit(store.stage, "raw-1", "games", games)
        first = store.stage("raw-1", "snapshots", snapshots.filter(first_part), True)
    first = [staged.result(), first]
    store.publish("raw-1", first)
    return store, snapshots


def c5_fact_two_batches(spark, folder):
    """Two loads through the store. Rows with line number 7 of the first period arrive late, after
    the bookmark has passed them, and are never loaded."""
    early = F.col("recorded_date") <= F.lit(SPLIT)
    late = early & (F.col("userscore") == 7)
    store, snapshots = _delivered(spark, folder, early & ~late)
    # The second delivery lands while the first is loaded, and is published after that.
    with ThreadPoolExecutor(1) as pool:
        rest = pool.submit(store.stage, "raw-2", "snapshots", snapshots.filter(~early | late), True)
        load_warehouse(store, "load-1", DAY_ONE)
    store.publish("raw-2", [rest.result()])
    load_warehouse(store, "load-2", DAY_TWO)
    return _natural(store.read(FACT), store.read("dim_games"))


def c5_retry_after_failure(spark, folder):
    """The dimensions are loaded, the facts are lost on the way; the same call finishes the run."""
    store, _ = _delivered(spark, folder, F.lit(True))
    load_dimensions(store, "load-1-dims", DAY_ONE, "initial")
    lost = store.read(FACT)
    store.stage("load-1-facts", FACT, lost, True)
    load_warehouse(store, "load-1", DAY_TWO)
    load_warehouse(store, "load-1", DAY_TWO)
    return _natural(store.read(FACT), store.read("dim_games"))


def m4_load_overlap(spark, folder):
    """The bookmark row is lost, so the second load takes all days and merges with the stored ones."""
    early = F.col("recorded_date") <= F.lit(SPLIT)
    store, snapshots = _delivered(spark, folder, early)
    load_warehouse(store, "load-1", DAY_ONE)
    reset = [
        store.stage("reset", "etl_bookmark", empty_table(spark, "etl_bookmark")),
        store.stage("reset", "snapshots", snapshots.filter(~early), True),
    ]
    store.publish("reset", reset)
    load_facts(store, "load-2", DAY_TWO)
    appids = store.read("dim_games").select("game_key", "appid")
    return store.read(FACT).join(appids, "game_key").select(
        "appid", "date_key", "ccu", F.col("created_at").cast("date").alias("created_on")
    )


def m4_upsert_fact(spark, folder):
    """Facts through 1998, then a second delivery from 1998 on that doubles the counts."""
    lineitem = standin.table(spark, folder, "lineitem")
    rows = with_month(standin.shipment_snapshots(lineitem)).select(
        F.col("appid").cast("bigint").alias("game_key"),
        date_key(F.col("recorded_date")).alias("date_key"),
        *METRICS,
        "ym",
    )
    old = rows.filter(F.col("ym") <= 199812).withColumn("created_at", timestamp(DAY_ONE))
    new = rows.filter(F.col("ym") >= 199801).withColumn("ccu", F.col("ccu") * 2)
    merged = upsert_fact(old, new.withColumn("owners", F.lit(None).cast("string")), DAY_TWO)
    return merged.select(
        "game_key", "date_key", *METRICS, F.col("created_at").cast("date").alias("created_on")
    )


def p9_past_bookmark(spark, folder):
    snapshots = with_month(standin.shipment_snapshots(standin.table(spark, folder, "lineitem")))
    return past_bookmark(snapshots, SPLIT, dt.date(2000, 6, 30)).select(
        "appid", "recorded_date", "ccu"
    )


def c5_calendar_drop(spark, folder):
    """The default calendar starts in 2020, so every shipment is lost, and the report says why."""
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    games = standin.games(standin.table(spark, folder, "part"))
    lost = orphans(snapshots, _dim_games(spark, games), calendar(spark))
    return lost.groupBy("reason").agg(F.count("*").alias("n"))


def q5_orphans(spark, folder):
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    games = standin.games(standin.table(spark, folder, "part"))
    days = calendar(spark, dt.date(1996, 1, 1), dt.date(2000, 12, 31))
    return orphans(snapshots, _dim_games(spark, games), days)


def m5_bookmark(spark, folder):
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    marks = seed_bookmark(spark, DAY_ONE)
    moved = advance_bookmark(marks, FACT, last_day(snapshots), DAY_TWO)
    return moved.select("table_name", "last_loaded_date")


def c3_read_bookmark(spark, folder):
    """Snapshots still to load under a bookmark, and under a missing one."""
    snapshots = standin.event_snapshots(standin.table(spark, folder, "events"))
    marks = advance_bookmark(seed_bookmark(spark, DAY_ONE), FACT, dt.date(2024, 1, 10), DAY_TWO)
    known = past_bookmark(snapshots, read_bookmark(marks)).withColumn("bookmark", F.lit("known"))
    missing = past_bookmark(snapshots, read_bookmark(marks, "no_such_table"))
    both = known.unionByName(missing.withColumn("bookmark", F.lit("missing")))
    return both.groupBy("bookmark").agg(F.count("*").alias("n"), F.sum("ccu").alias("ccu"))


def c1_mode(spark, folder):
    star = _activity(spark, folder)
    no_facts = star.fact.filter(F.col("ccu") < 0)
    no_games = star.dim_games.filter(F.col("appid") < 0)
    cases = [
        ("loaded", choose_load_mode(star.fact, star.dim_games)),
        ("no facts", choose_load_mode(no_facts, star.dim_games)),
        ("no games", choose_load_mode(star.fact, no_games)),
    ]
    return spark.createDataFrame(cases, "situation string, load_mode string")


def c2_changed_since(spark, folder):
    games = standin.games(standin.table(spark, folder, "part"))
    loaded = games.filter(F.col("updated_at") <= timestamp(DAY_ONE))
    return changed_since(games, last_update(loaded)).select("appid", "name")


def c4_load_dimensions(spark, folder):
    """Initial load of early games, then an incremental load of all: what all five tables hold."""
    games = standin.games(standin.table(spark, folder, "part"))
    games = games.select(*empty_table(spark, "games").columns)
    store = Store(spark, scratch_root(spark))
    early = games.filter(F.col("updated_at") <= timestamp(DAY_ONE))
    store.publish("raw-1", [store.stage("raw-1", "games", early)])
    load_dimensions(store, "dims-1", DAY_ONE, "initial")
    store.publish("raw-2", [store.stage("raw-2", "games", games)])
    load_dimensions(store, "dims-2", DAY_TWO, "incremental")
    appids = store.read("dim_games").select("game_key", "appid")

    def rows(table: str, df: DataFrame, key: str, *details: str) -> DataFrame:
        detail = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in details])
        return df.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key"), detail.alias("detail"))

    found = [
        rows("dim_games", store.read("dim_games"), "appid", "name", "price_final", "short_description")
    ]
    for _, table, name, key, links in NAME_DIMENSIONS:
        names = store.read(table).withColumn("created_on", F.col("created_at").cast("date"))
        pairs = store.read(links).join(appids, "game_key").join(names, key)
        found += [rows(table, names, name, "created_on"), rows(links, pairs, "appid", name)]
    return reduce(DataFrame.unionByName, found)


# Checks -----------------------------------------------------------------------------------


def q1_unique(spark, folder):
    shipped = standin.table(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("ship_day")
    )
    return checks.unique_violations(shipped, ["l_partkey", "ship_day"])


def q2_not_null(spark, folder):
    raw = standin.raw_games(standin.table(spark, folder, "part"))
    return checks.null_violations(
        raw, ["appid", "name", "price_initial", "price_currency", "short_description", "publishers"]
    )


def q3_reference(spark, folder):
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    games = standin.games(standin.table(spark, folder, "part"))
    return checks.reference_violations(snapshots, games, "appid")


def q4_length(spark, folder):
    raw = standin.raw_games(standin.table(spark, folder, "part"))
    return checks.length_violations(raw, {"name": 10, "short_description": 6, "price_currency": 10})


def q4_range(spark, folder):
    wide = standin.table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10_000_000).alias("order_parts"), "l_partkey", "l_linenumber"
    )
    return checks.range_violations(wide, ["order_parts", "l_partkey", "l_linenumber"])


def q6_cascade(spark, folder):
    part = standin.table(spark, folder, "part")
    snapshots = standin.shipment_snapshots(standin.table(spark, folder, "lineitem"))
    gone = standin.raw_games(part).filter(F.col("categories") == '["PROMO"]')
    return checks.cascade_delete(snapshots, gone, ["appid"]).select("appid", "recorded_date", "ccu")


def g6_required(spark, folder):
    part = standin.table(spark, folder, "part")
    parsed = parse_top_list(standin.list_payloads(part))
    return checks.required_violations(parsed).select("appid", "missing")


# Analytics --------------------------------------------------------------------------------


def an1_series(spark, folder):
    star = _activity(spark, folder)
    return analytics.game_series(star.fact, star.dim_games, star.dim_date, 12, AS_OF)


def an2_top10_weekday(spark, folder):
    star = _activity(spark, folder)
    return analytics.top_games_by_weekday(star.fact, star.dim_games, star.dim_date, AS_OF)


def an3_weekday(spark, folder):
    star = _activity(spark, folder)
    return analytics.games_by_weekday(star.fact, star.dim_games, star.dim_date, AS_OF)


def an4_total_series(spark, folder):
    star = _shipments(spark, folder, dim=False)
    return analytics.total_series(star.fact, star.dim_date)


def an5_compare(spark, folder):
    star = _shipments(spark, folder)
    return analytics.compare_games(star.fact, star.dim_games)


def an6_drill(spark, folder):
    star = _shipments(spark, folder, names=True)
    genres, genre_pairs = _genres(spark, star)
    publishers, publisher_pairs = _publishers(spark, star)
    return analytics.drill_down(
        star.fact,
        star.dim_games,
        star.dim_date,
        dt.date(1997, 3, 1),
        dt.date(1999, 8, 31),
        analytics.games_named(genre_pairs, genres, "genre_key", "genre_name", ["red", "ring"]),
        analytics.games_named(
            publisher_pairs, publishers, "publisher_key", "publisher_name", ["PROMO", "LARGE"]
        ),
    )


def an7_genre(spark, folder):
    star = _shipments(spark, folder, names=True)
    dim, pairs = _genres(spark, star)
    return analytics.genre_performance(star.fact, pairs, dim)


def l2_top_games(spark, folder):
    star = _activity(spark, folder)
    return analytics.top_games(star.fact, star.dim_games, AS_OF, 25).drop("game_key")


def l3_top_active(spark, folder):
    events = standin.table(spark, folder, "events")
    return trends.most_active(events, "user_id", "ts", AS_OF)


def g1_rollup(spark, folder):
    star = _shipments(spark, folder, dim=False)
    return trends.rollup(star.fact, star.dim_date)


def g2_risers(spark, folder):
    star = _activity(spark, folder)
    return trends.risers(star.fact, star.dim_games, AS_OF)


def g2_top_decliners(spark, folder):
    star = _activity(spark, folder)
    return trends.risers(star.fact, star.dim_games, AS_OF, n=20, rising=False)


def g3_genre_trend(spark, folder):
    star = _shipments(spark, folder, names=True)
    dim, pairs = _genres(spark, star)
    named = pairs.join(dim.select("genre_key", "genre_name"), "genre_key")
    return trends.monthly_trend(star.fact, named, "genre_name")


def g3_category_trend(spark, folder):
    star = _shipments(spark, folder, names=True)
    pairs = trends.category_pairs(star.games, star.dim_games)
    return trends.monthly_trend(star.fact, pairs, "category")


def g4_peak_avg(spark, folder):
    star = _shipments(spark, folder)
    return trends.peak_and_average(star.fact, star.dim_games)


def g5_moving_avg(spark, folder):
    star = _shipments(spark, folder)
    return trends.moving_average(star.fact, star.dim_games)


QUERIES = [
    s1_parse_top_list, s2_app_details, s3_player_count, j1_enrich, p11_rejects, p7_gate,
    s7_snapshot_guard, a7_last_wins, m1_upsert_games, c6_ingest_games, c6_ingest_snapshots,
    s5_calendar, m2_scd1, k1_dense_keys, j6_unnest, m3_publishers, m3_genres, m3_insert_if_absent,
    m6_bridge_publishers, m6_bridge_genres, c5_fact_full, c5_fact_two_batches, m4_upsert_fact,
    c5_retry_after_failure, m4_load_overlap, p11_stored_rejects, k1_second_load, p11_stored_arrivals,
    s7_stored_arrivals, e2e_weekday,
    p9_past_bookmark, c5_calendar_drop, q5_orphans, m5_bookmark, c3_read_bookmark, c1_mode,
    c2_changed_since, c4_load_dimensions, q1_unique, q2_not_null, q3_reference, q4_length, q4_range,
    q6_cascade, g6_required, an1_series, an2_top10_weekday, an3_weekday, an4_total_series,
    an5_compare, an6_drill, an7_genre, l2_top_games, l3_top_active, g1_rollup, g2_risers,
    g2_top_decliners, g3_genre_trend, g3_category_trend, g4_peak_avg, g5_moving_avg,
]


def _settled(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(settle(spark), folder)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries() -> dict:
    return {query.__name__: _settled(query) for query in QUERIES}
