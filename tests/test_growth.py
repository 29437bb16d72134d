"""What the loads do with more rows than a task should hold: dealt, landed and written once."""

import datetime as dt
import os
import threading

import pytest
from conftest import DATA, T1, T2, rows_of
from pyspark.sql import functions as F

from starload import registry
from starload.operators.checks import unique_violations
from starload.plans import analytics
from starload.plans.ingest import ingest
from starload.plans.warehouse import create_warehouse, load_dimensions, load_facts, load_warehouse
from starload.schemas import FACT
from starload.sources import standin, store as stored
from starload.sources.payloads import parse_app_details, parse_player_count, parse_top_list, read_payloads
from starload.sources.store import Store


@pytest.fixture
def one_file(spark, tmp_path):
    """Parts in one file with one row group."""
    key = F.col("id").cast("string")
    parts = spark.range(2000).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("part "), key).alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("STANDARD").alias("p_type"), F.lit(7).alias("p_size"), F.lit(1.5).alias("p_retailprice"),
    )
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return standin.table(spark, str(tmp_path), "part")


@pytest.mark.parametrize(
    "parse, responses",
    [
        (parse_top_list, standin.list_payloads),
        (parse_app_details, standin.detail_responses),
        (parse_player_count, standin.count_responses),
    ],
)
def test_responses_made_of_one_file_are_parsed_by_many_tasks(spark, one_file, parse, responses):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        by_task = parse(responses(one_file)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert sum(n for _, n in by_task) == 2000
    assert len(by_task) > 1 and max(n for _, n in by_task) < 1500


def test_lists_are_landed_one_to_a_file_of_one_folder(spark, one_file, tmp_path):
    standin.land(one_file, f"{tmp_path}/day", entries=100)
    entries = list((tmp_path / "day" / "list").iterdir())
    assert all(e.is_file() for e in entries) and sum(e.suffix == ".txt" for e in entries) == 20
    lists = read_payloads(spark, f"{tmp_path}/day/list")
    games = parse_top_list(lists).groupBy("payload_id").agg(F.count("*").alias("n"), F.min("appid").alias("first"))
    assert sorted((r.first, r.n) for r in games.collect()) == [(k, 100) for k in range(0, 2000, 100)]


def test_facts_of_an_overlapping_load_are_written_once(store, make):
    """Only the months the new days lie in are merged; a load behind the bookmark is told from the state alone."""

    def put(run_id, *rows):
        rows = [{"appid": a, "recorded_date": d, "ccu": c, "created_at": T1, "ym": d.year * 100 + d.month} for a, d, c in rows]
        store.publish(run_id, [store.stage(run_id, "snapshots", make("snapshots", *rows), True)])

    create_warehouse(store, T1)
    games = [{"appid": a, "name": f"g{a}", "created_at": T1, "updated_at": T1} for a in (1, 2)]
    store.publish("games", [store.stage("games", "games", make("games", *games))])
    load_dimensions(store, "dims", T1, "initial")
    put("s1", (1, dt.date(2024, 1, 5), 1), (1, dt.date(2024, 2, 5), 2))
    load_facts(store, "f1", T1)
    january = [e.path for e in store._state.entries if e.table_name == FACT and e.part == 202401]
    back = make("etl_bookmark", {"table_name": FACT, "last_loaded_date": dt.date(2024, 1, 31), "updated_at": T1})
    store.publish("back", [store.stage("back", "etl_bookmark", back)])
    put("s2", (2, dt.date(2024, 2, 5), 3), (1, dt.date(2024, 3, 1), 4))
    staged = load_facts(store, "f2", T2)
    assert {s.table: s.rows for s in staged}[FACT] == 3
    written = [n for n in os.listdir(f"{store.root}/{FACT}") if n.startswith("run=f2-")]
    assert len(written) == 1
    assert [e.path for e in store._state.entries if e.table_name == FACT and e.part == 202401] == january
    appids = store.read("dim_games").select("game_key", "appid")
    assert rows_of(store.read(FACT).join(appids, "game_key"), "appid", "date_key", "ccu", "created_at") == [
        (1, 20240105, 1, T1), (1, 20240205, 2, T1), (1, 20240301, 4, T2), (2, 20240205, 3, T2),
    ]


def test_the_second_delivery_lands_while_the_first_is_loaded(spark, monkeypatch):
    stage, load = Store.stage, registry.load_warehouse
    landing, loads = threading.Event(), []

    def noted(self, run_id, *more, **named):
        if run_id == "raw-2":
            landing.set()
        return stage(self, run_id, *more, **named)

    def loaded(store, run_id, load_ts):
        assert landing.wait(30)
        loads.append((run_id, store.is_published("raw-2")))
        return load(store, run_id, load_ts)

    monkeypatch.setattr(Store, "stage", noted)
    monkeypatch.setattr(registry, "load_warehouse", loaded)
    registry.queries()["c5_fact_two_batches"](spark, DATA)
    assert loads == [("load-1", False), ("load-2", True)]


def test_appended_keys_are_counted_with_the_stored_ones(store, make):
    """In one grouping; keys that only stored rows repeat are not the fault of the new ones."""
    day = dt.date(2024, 1, 5)
    row = lambda appid: {"appid": appid, "recorded_date": day, "ccu": 1, "created_at": T1, "ym": 202401}
    store.publish("s1", [store.stage("s1", "snapshots", make("snapshots", row(1), row(2)), True)])
    more = store.stage("s2", "snapshots", make("snapshots", row(2), row(3), row(4), row(4)), True)
    (found,) = [broken for what, broken in store._violations([more]) if "more than one row" in what]
    assert rows_of(found, "appid", "n") == [(2, 2), (4, 2)]
    stored = make("snapshots", row(1), row(1), row(2), row(None), row(None))
    new = make("snapshots", row(2), row(3), row(5), row(5), row(None))
    assert rows_of(unique_violations(new, ["appid", "recorded_date"], stored), "appid", "n") == [(2, 2), (5, 2)]


@pytest.mark.parametrize("most, sent", [(0, False), (10**6, True)])
def test_tables_that_grow_with_the_games_are_sent_to_the_driver_only_while_they_are_few(
    spark, store, one_file, monkeypatch, most, sent
):
    """By their rows: the files of any number of keys in order can look small enough to the planner."""
    monkeypatch.setattr(stored, "MOST_SENT", most)
    plans, stage, violations = [], Store.stage, Store._violations

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def noted(self, run_id, table, df, *more, **named):
        planned(df)
        return stage(self, run_id, table, df, *more, **named)

    def checked(self, staged):
        found = violations(self, staged)
        for _, broken in found:
            planned(broken)
        return found

    monkeypatch.setattr(Store, "stage", noted)
    monkeypatch.setattr(Store, "_violations", checked)
    create_warehouse(store, T1)
    responses = standin.list_payloads(one_file), standin.detail_responses(one_file), standin.count_responses(one_file)
    for number, day in enumerate((T1, T2)):
        ingest(store, *responses, day.date(), day, f"ingest-{number}", on_orphan="quarantine")
        load_warehouse(store, f"load-{number}", day)
    top = analytics.top_games(store.read(FACT), store.side("dim_games"), T2.date())
    planned(top)
    assert any("BroadcastHashJoin [appid" in p or "BroadcastHashJoin [game_key" in p for p in plans) == sent
    assert store.rows("games") == 2000 and store.rows(FACT) == store.read(FACT).count() == 4000
    assert [r.appid for r in top.collect()] == list(range(1999, 1989, -1))
