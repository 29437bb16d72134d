"""What Spark makes of the plans: pruning, pushdown, join kinds, shuffles, skew."""

import datetime as dt
import re

import pytest
from conftest import DATA, T1
from pyspark.sql import functions as F

from starload import registry
from starload.operators.facts import past_bookmark
from starload.operators.keys import assign_keys
from starload.operators.merge import upsert_current
from starload.operators.names import bridge
from starload.plans import analytics
from starload.schemas import FACT, GAME_COLUMNS
from starload.sources import standin
from starload.sources.calendar import calendar
from starload.sources.store import bucket_of

D = dt.date
STORED = {
    "c6_ingest_games", "c6_ingest_snapshots", "c5_fact_two_batches", "c4_load_dimensions", "p11_stored_arrivals",
    "s7_stored_arrivals", "e2e_weekday",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(plan):
    return plan.split("== Initial Plan ==")[0]


def exchanges(plan):
    """Shuffles by hash; a reused one names, on its line, the one that it reuses."""
    return len(re.findall(r"^[\s:+*()0-9-]*Exchange hashpartitioning", plan, re.M))


@pytest.fixture
def shuffled(spark):
    """No broadcast joins, as with dimensions too big for one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def published(spark, store, make):
    """Three months of facts, stored by month."""
    rows = [
        {"game_key": g, "date_key": 20240000 + m * 100 + 10, "ccu": g * m, "ym": 202400 + m}
        for g in range(1, 5)
        for m in (1, 2, 3)
    ]
    games = [{"game_key": g, "appid": g, "name": f"g{g}"} for g in range(1, 5)]
    staged = [
        store.stage("a", FACT, make(FACT, *rows), True),
        store.stage("a", "dim_games", make("dim_games", *games)),
        store.stage("a", "dim_date", calendar(spark, D(2024, 1, 1), D(2024, 12, 31))),
    ]
    store.publish("a", staged)
    return store


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - STORED))
def test_no_cross_joins_no_python_no_global_windows(spark, name):
    plan = plan_of(registry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    for window in re.findall(r"Window \[.*", plan):
        # Only the offsets of the key buckets, one row each, are summed in one task.
        assert re.search(r"\], \[\S+#\d+L?\], \[", window) or "_bucket" in window, window


def test_month_and_day_reach_the_scan(published):
    chosen = analytics.between(published.read(FACT), D(2024, 2, 5), D(2024, 2, 20))
    plan = plan_of(chosen.select("game_key", "ccu"))
    assert re.search(r"PartitionFilters: \[[^\]]*ym#\d+ >= 202402", plan)
    assert "GreaterThanOrEqual(date_key,20240205)" in plan
    assert re.search(r"ReadSchema: struct<game_key:bigint,date_key:int,ccu:int>", plan)


def test_calendar_filter_prunes_months(published):
    day = published.read("dim_date").filter(F.col("full_date") >= F.lit(D(2024, 3, 1)))
    plan = plan_of(analytics.with_day(published.read(FACT), day, "full_date"))
    assert "dynamicpruning" in plan.lower()


def test_top_games_keeps_n_rows_per_task(published):
    plan = plan_of(analytics.top_games(published.read(FACT), published.read("dim_games"), D(2024, 1, 10)))
    assert plan.count("TakeOrderedAndProject") >= 1


def test_drill_down_is_a_semi_join(spark, published, make):
    links = spark.createDataFrame([(1, 1)], "game_key bigint, genre_key bigint")
    dim = make("dim_genres", {"genre_key": 1, "genre_name": "x"})
    chosen = analytics.games_named(links, dim, "genre_key", "genre_name", ["x"])
    found = analytics.drill_down(
        published.read(FACT), published.read("dim_games"), published.read("dim_date"), None, None, chosen
    )
    assert "LeftSemi" in plan_of(found)


def test_bookmark_reaches_the_scan(store, make):
    rows = [{"appid": 1, "recorded_date": D(2024, m, 1), "ym": 202400 + m} for m in (1, 2)]
    store.publish("a", [store.stage("a", "snapshots", make("snapshots", *rows), True)])
    plan = plan_of(past_bookmark(store.read("snapshots"), D(2024, 1, 15), D(2024, 3, 1)))
    assert "GreaterThan(recorded_date,2024-01-15)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*ym#\d+ >= 202401", plan)


def test_a_merge_reads_the_touched_buckets_only(store, make):
    base = [{"appid": a, "name": f"g{a}", "created_at": T1, "updated_at": T1} for a in range(50)]
    store.publish("a", [store.stage("a", "games", make("games", *base))])
    batch = make("games", {"appid": 3, "name": "x"}).select("appid", *GAME_COLUMNS)
    [row] = batch.select(bucket_of("games")).collect()
    assert 1 < len(store.months("games")) <= 32
    merged = upsert_current(store.read("games", [row[0]]), batch, T1)
    staged = store.stage("b", "games", merged, whole=False)
    assert store.staged_months(staged) == [row[0]] and staged.rows < 10
    store.publish("b", [staged])
    assert store.read("games").count() == 50
    assert [r.name for r in store.read("games").filter("appid = 3").collect()] == ["x"]


def test_bridge_distinct_reuses_the_partitioning(spark, shuffled):
    part = standin.table(spark, DATA, "part")
    games = standin.games(part)
    dim_games = games.select("appid", F.col("appid").cast("bigint").alias("game_key"))
    dim = spark.range(5).select(F.col("id").alias("genre_key"), F.col("id").cast("string").alias("genre_name"))
    pairs = bridge(games, dim_games, dim, "genres", "genre_name", "genre_key")
    # games and dimension by appid, pairs and names by name: no fifth shuffle for distinct.
    assert exchanges(plan_of(pairs)) == 4


def test_hot_name_is_split(spark, shuffled, store):
    """A publisher of a third of all games: the adaptive skew join splits its partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(60000)
        name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 500))
        games = ids.select(F.col("id").cast("int").alias("appid"), F.to_json(F.array(name)).alias("publishers"))
        games = store.work("x", "games", games)[0]
        dim_games = store.work("x", "dim", games.select("appid", F.col("appid").cast("bigint").alias("game_key")))[0]
        names = games.select(F.get_json_object("publishers", "$[0]").alias("publisher_name")).distinct()
        dim = store.work("x", "names", names.withColumn("publisher_key", F.xxhash64("publisher_name")))[0]
        pairs = bridge(games, dim_games, dim, "publishers", "publisher_name", "publisher_key")
        rows = pairs.collect()
        assert len(rows) == 60000
        assert "skew=true" in plan_of(pairs)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keys_come_from_one_scan_and_shuffle(spark, shuffled, store):
    rows, _ = store.work("x", "names", spark.range(5000).withColumn("name", F.concat(F.lit("n"), "id")).select("name"))
    keyed = assign_keys(rows, "name", "key")
    keyed.collect()
    plan = plan_of(keyed)
    assert "ReusedExchange" in plan
    assert "hashpartitioning(_bucket" in plan and exchanges(final_plan(plan)) == 1


def test_one_game_series_does_not_shuffle_the_facts(published, shuffled):
    found = analytics.game_series(
        published.read(FACT), published.read("dim_games"), published.read("dim_date"), 2, D(2024, 3, 31), 60
    )
    assert "hashpartitioning" not in plan_of(found)


def test_sql_over_the_views(spark, published):
    published.register_views("v_")
    found = spark.sql("""
        SELECT g.name, avg(f.ccu) AS mean FROM v_fact_game_metrics f
        JOIN v_dim_games g ON g.game_key = f.game_key
        JOIN v_dim_date d ON d.date_key = f.date_key AND d.ym = f.ym
        WHERE d.full_date >= DATE '2024-03-31' - INTERVAL '60 days' GROUP BY g.name ORDER BY g.name
    """)
    assert [tuple(r) for r in found.collect()] == [("g1", 2.5), ("g2", 5.0), ("g3", 7.5), ("g4", 10.0)]


def test_weekdays_of_all_games_shuffle_the_facts_once(published, shuffled):
    found = analytics.games_by_weekday(
        published.read(FACT), published.read("dim_games"), published.read("dim_date"), D(2024, 3, 31), 60
    )
    plan = plan_of(found)
    # Sums by game, the dimension by game, the result by name and weekday.
    assert exchanges(plan) == 3 and len(re.findall(r"Exchange hashpartitioning\(game_key", plan)) == 2
    # The tenth of February is a Saturday, that of March a Sunday.
    expected = [(f"g{g}", 6, g * 2.0) for g in range(1, 5)] + [(f"g{g}", 0, g * 3.0) for g in range(1, 5)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
