"""Whole runs through the store: ingest, dimensions, facts, bookmark, crashes."""

import datetime as dt
import json

import pytest
from conftest import T1, T2, T3, rows_of

from starload.operators import checks
from starload.operators.bookmark import BEGINNING, read_bookmark
from starload.operators.checks import CheckFailed
from starload.plans.ingest import EmptyBatch, ingest
from starload.plans.warehouse import create_warehouse, load_dimensions, load_facts, load_warehouse
from starload.schemas import FACT, REFERENCES, REQUIRED, UNIQUE_KEYS

D = dt.date


def payloads(spark, games):
    """games: {appid: (name, price or None, description or None, ccu, publishers)}"""
    listed = {str(a): {"name": n, "owners": "o"} for a, (n, *_) in games.items()}
    top = spark.createDataFrame([("p", json.dumps(listed))], "payload_id string, body string")
    details, counts = [], []
    for a, (name, price, text, ccu, publishers) in games.items():
        data = {"publishers": publishers, "genres": [{"description": f"G{a % 2}"}]}
        if price is not None:
            data["price_overview"] = {"initial": price, "final": price}
        if text is not None:
            data["short_description"] = text
        details.append((a, json.dumps({str(a): {"success": True, "data": data}})))
        counts.append((a, json.dumps({"response": {"result": 1, "player_count": ccu}})))
    schema = "appid int, body string"
    return top, spark.createDataFrame(details, schema), spark.createDataFrame(counts, schema)


def run(spark, store, games, now, run_id, **options):
    return ingest(store, *payloads(spark, games), now.date(), now, run_id, **options)


DAY1 = {1: ("a", 100, None, 10, ["P", " Q "]), 2: ("b", None, "text", 20, ["P"])}
DAY2 = {1: ("a", 90, None, 11, ["P"]), 3: ("c", 5, None, 30, ["R"])}


def games_of(store):
    return rows_of(
        store.read("games"), "appid", "price_final", "short_description", "created_at", "updated_at"
    )


def test_ingest_two_days(spark, store):
    run(spark, store, DAY1, T1, "d1")
    run(spark, store, DAY2, T2, "d2")
    assert games_of(store) == [
        (1, 90, None, T1, T2),
        (2, None, "text", T1, T1),
        (3, 5, None, T2, T2),
    ]
    assert rows_of(store.read("snapshots"), "appid", "recorded_date", "ccu") == [
        (1, T1.date(), 10),
        (1, T2.date(), 11),
        (2, T1.date(), 20),
        (3, T2.date(), 30),
    ]


def test_same_day_again_updates_games_and_skips_snapshots(spark, store):
    run(spark, store, DAY1, T1, "d1")
    later = T1 + dt.timedelta(hours=3)
    run(spark, store, DAY1 | {1: ("a", 1, None, 99, []), 9: ("new", 1, None, 1, [])}, later, "d1b")
    assert [(g[0], g[1]) for g in games_of(store)] == [(1, 1), (2, None), (9, 1)]
    assert rows_of(store.read("snapshots"), "appid", "ccu") == [(1, 10), (2, 20)]


def test_empty_batches_fail(spark, store):
    with pytest.raises(EmptyBatch):
        ingest(
            store,
            spark.createDataFrame([("p", '{"x": 1}')], "payload_id string, body string"),
            *payloads(spark, DAY1)[1:],
            T1.date(),
            T1,
            "d1",
        )
    top, details, counts = payloads(spark, DAY1)
    with pytest.raises(EmptyBatch):
        ingest(store, top, details.limit(0), counts, T1.date(), T1, "d2")
    assert store.read("games").isEmpty()


def test_orphan_snapshot_fails_or_is_set_aside(spark, store):
    mixed = DAY1 | {5: ("bare", None, None, 1, [])}
    with pytest.raises(CheckFailed, match="without a game"):
        run(spark, store, mixed, T1, "d1")
    assert store.read("games").isEmpty() and store.read("snapshots").isEmpty()
    run(spark, store, mixed, T1, "d1", on_orphan="quarantine")
    assert rows_of(store.read("snapshots"), "appid") == [(1,), (2,)]
    assert rows_of(store.read("rejects"), "appid", "reject_reason", "run_date") == [
        (5, "no_game", T1.date())
    ]


def test_too_long_text_fails_the_run(spark, store):
    with pytest.raises(CheckFailed, match="too long"):
        run(spark, store, {1: ("n" * 501, 1, None, 1, [])}, T1, "d1")
    assert store.read("games").isEmpty()


def test_two_entries_of_one_game(spark, store):
    """Zero-padded twins: the last one is the game; two snapshots for one day end the run."""
    _, details, counts = payloads(spark, DAY1)
    body = '{"1": {"name": "first"}, "01": {"name": "second"}}'
    top = spark.createDataFrame([("p", body)], "payload_id string, body string")
    with pytest.raises(CheckFailed, match="more than one row"):
        ingest(store, top, details, counts, T1.date(), T1, "d1")


def facts_of(store):
    names = store.read("dim_games").select("game_key", "appid")
    return rows_of(store.read(FACT).join(names, "game_key"), "appid", "date_key", "ccu", "created_at")


def bookmark_of(store):
    return read_bookmark(store.read("etl_bookmark"))


def links_of(store):
    pairs = store.read("bridge_game_publishers").join(store.read("dim_games"), "game_key")
    return rows_of(pairs.join(store.read("dim_publishers"), "publisher_key"), "appid", "publisher_name")


def test_warehouse_two_days(spark, store):
    create_warehouse(store, T1)
    assert bookmark_of(store) == BEGINNING and store.read("dim_date").count() == 4018
    run(spark, store, DAY1, T1, "d1")
    assert load_warehouse(store, "w1", T1) == "initial"
    assert facts_of(store) == [(1, 20240101, 10, T1), (2, 20240101, 20, T1)]
    assert links_of(store) == [(1, "P"), (1, "Q"), (2, "P")]
    keys = {r.appid: r.game_key for r in store.read("dim_games").collect()}
    run(spark, store, DAY2, T2, "d2")
    assert load_warehouse(store, "w2", T2) == "incremental"
    assert facts_of(store) == [
        (1, 20240101, 10, T1),
        (1, 20240102, 11, T2),
        (2, 20240101, 20, T1),
        (3, 20240102, 30, T2),
    ]
    # Q has no game any more: its link goes, its dimension row stays.
    assert links_of(store) == [(1, "P"), (2, "P"), (3, "R")]
    assert rows_of(store.read("dim_publishers"), "publisher_name") == [("P",), ("Q",), ("R",)]
    after = {r.appid: r.game_key for r in store.read("dim_games").collect()}
    assert after == keys | {3: 3}
    assert rows_of(store.read("dim_games"), "appid", "price_final", "updated_at") == [
        (1, 90, T2),
        (2, None, T1),
        (3, 5, T2),
    ]
    assert bookmark_of(store) == T2.date()
    for table, keys in UNIQUE_KEYS.items():
        for key in keys:
            assert checks.unique_violations(store.read(table), key).isEmpty()
        assert checks.null_violations(store.read(table), REQUIRED[table]).isEmpty()
        for column, parent, parent_column in REFERENCES.get(table, []):
            lost = checks.reference_violations(
                store.read(table), store.read(parent), column, parent_column
            )
            assert lost.isEmpty()


def test_create_again_changes_nothing(spark, store):
    create_warehouse(store, T1, D(2024, 1, 1), D(2024, 1, 5))
    create_warehouse(store, T2, D(2024, 1, 4), D(2024, 1, 8), run_id="more days")
    assert store.read("dim_date").count() == 8
    assert rows_of(store.read("etl_bookmark"), "last_loaded_date", "updated_at") == [(BEGINNING, T1)]


def put(store, make, run_id, *rows):
    """Publish snapshots directly: (appid, day, ccu)."""
    rows = [
        {"appid": a, "recorded_date": d, "ccu": c, "created_at": T1, "ym": d.year * 100 + d.month}
        for a, d, c in rows
    ]
    store.publish(run_id, [store.stage(run_id, "snapshots", make("snapshots", *rows), True)])


def put_games(store, make, run_id, *appids, at=T1):
    rows = [{"appid": a, "name": f"g{a}", "created_at": at, "updated_at": at} for a in appids]
    store.publish(run_id, [store.stage(run_id, "games", make("games", *rows))])


@pytest.fixture
def ready(store, make):
    create_warehouse(store, T1)
    put_games(store, make, "games", 1, 2)
    load_dimensions(store, "dims", T1, "initial")
    return store


def test_late_and_unknown_rows_are_never_loaded(ready, make):
    put_games(ready, make, "games2", 1, 2, 9, at=T2)  # 9 is not in the dimension yet
    put(ready, make, "s1", (1, D(2024, 1, 10), 1), (9, D(2024, 1, 11), 2))
    load_facts(ready, "f1", T1)
    assert bookmark_of(ready) == D(2024, 1, 11)
    put(ready, make, "s2", (2, D(2024, 1, 9), 3), (2, D(2024, 1, 11), 4), (2, D(2024, 2, 1), 5))
    load_dimensions(ready, "dims2", T2, "incremental")
    load_facts(ready, "f2", T2)
    assert [(a, d, c) for a, d, c, _ in facts_of(ready)] == [(1, 20240110, 1), (2, 20240201, 5)]


def test_bookmark_follows_all_snapshots_even_outside_the_calendar(ready, make):
    put(ready, make, "s1", (1, D(2019, 12, 31), 1), (1, D(2031, 1, 1), 2))
    load_facts(ready, "f1", T1)
    assert ready.read(FACT).isEmpty()
    assert bookmark_of(ready) == D(2031, 1, 1)


def test_missing_bookmark_row_reloads_everything_and_overwrites(ready, make):
    ready.publish("x", [ready.stage("x", "etl_bookmark", make("etl_bookmark"))])
    put(ready, make, "s1", (1, D(2024, 1, 1), 1), (2, D(2024, 2, 1), 2))
    load_facts(ready, "f1", T1)
    put(ready, make, "s2", (1, D(2024, 2, 2), 3))
    load_facts(ready, "f2", T2)
    assert facts_of(ready) == [
        (1, 20240101, 1, T1),
        (1, 20240202, 3, T2),
        (2, 20240201, 2, T1),
    ]
    assert ready.read("etl_bookmark").isEmpty()


def test_snapshots_that_arrive_during_a_load_wait_for_the_next(spark, ready, make, monkeypatch):
    from starload.plans import warehouse

    put(ready, make, "s1", (1, D(2024, 1, 1), 1))
    plain = warehouse.fact_delta

    def slow(*args):
        from starload.sources.store import Store

        put(Store(spark, ready.root), make, "meanwhile", (2, D(2024, 1, 2), 2))
        return plain(*args)

    monkeypatch.setattr(warehouse, "fact_delta", slow)
    load_facts(ready, "f1", T1)
    assert bookmark_of(ready) == D(2024, 1, 1)
    monkeypatch.setattr(warehouse, "fact_delta", plain)
    load_facts(ready, "f2", T2)
    assert [(a, c) for a, _, c, _ in facts_of(ready)] == [(1, 1), (2, 2)]
    assert bookmark_of(ready) == D(2024, 1, 2)


def test_many_small_loads_equal_one_big_load(spark, make, tmp_path):
    from starload.sources.store import Store

    days = [D(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)]
    rows = [(a, d, a * 100 + d.day) for d in days for a in (1, 2, 7)]
    results = []
    for name, batches in (("one", [rows]), ("many", [rows[i : i + 3] for i in range(0, 12, 3)])):
        store = Store(spark, str(tmp_path / name))
        create_warehouse(store, T1)
        put_games(store, make, "games", 1, 2)
        load_dimensions(store, "dims", T1, "initial")
        put_games(store, make, "games2", 1, 2, 7)  # 7 is not in the dimension
        for i, batch in enumerate(batches):
            put(store, make, f"s{i}", *batch)
            load_facts(store, f"f{i}", T1)
        results.append((facts_of(store), bookmark_of(store)))
    assert results[0] == results[1] and len(results[0][0]) == 8


def test_crash_before_publish_leaves_everything_and_a_repeat_finishes(ready, make, monkeypatch):
    from starload.sources.store import Store

    put(ready, make, "s1", (1, D(2024, 1, 1), 1))
    load_facts(ready, "f1", T1)
    before = facts_of(ready), bookmark_of(ready)
    put(ready, make, "s2", (2, D(2024, 1, 2), 2))
    publish = Store.publish
    monkeypatch.setattr(Store, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load_facts(ready, "f2", T2)
    monkeypatch.setattr(Store, "publish", publish)
    assert (facts_of(ready), bookmark_of(ready)) == before
    load_facts(ready, "f2", T3)
    assert facts_of(ready) == [(1, 20240101, 1, T1), (2, 20240102, 2, T3)]
    assert bookmark_of(ready) == D(2024, 1, 2)


def test_duplicate_snapshots_are_never_published(ready, make):
    with pytest.raises(CheckFailed, match="more than one row"):
        put(ready, make, "s1", (1, D(2024, 1, 1), 1), (1, D(2024, 1, 1), 2))
    load_facts(ready, "f1", T1)
    assert ready.read(FACT).isEmpty() and bookmark_of(ready) == BEGINNING


@pytest.mark.parametrize(
    "rows, message",
    [
        ([{"appid": 1, "name": "a"}, {"appid": 1, "name": "b"}], "games: more than one row"),
        ([{"appid": 1}], "required"),
        ([{"appid": 1, "name": "x" * 501}], "too long"),
        ([{"appid": 1, "name": "a", "genres": json.dumps(["g" * 101])}], "too long"),
    ],
)
def test_bad_games_stop_the_dimension_load(store, make, rows, message):
    with pytest.raises(CheckFailed, match=message):
        store.publish("g", [store.stage("g", "games", make("games", *rows))])
        load_dimensions(store, "dims", T1, "initial")
    assert store.read("dim_games").isEmpty() and store.read("dim_genres").isEmpty()


def test_incremental_without_a_last_update_skips_the_game_dimension(store, make):
    put_games(store, make, "g", 1)
    load_dimensions(store, "dims", T1, "incremental")
    assert store.read("dim_games").isEmpty()


def test_a_failed_step_is_finished_by_the_same_call(spark, store, monkeypatch):
    from starload.plans import warehouse

    create_warehouse(store, T1)
    create_warehouse(store, T2)
    run(spark, store, DAY1, T1, "d1")
    snapshots = rows_of(store.read("snapshots"))
    assert run(spark, store, DAY2, T2, "d1") == [] and rows_of(store.read("snapshots")) == snapshots
    plain = warehouse.fact_delta
    monkeypatch.setattr(warehouse, "fact_delta", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load_warehouse(store, "w1", T1)
    assert store.read("dim_games").count() == 2 and store.read(FACT).isEmpty()
    monkeypatch.setattr(warehouse, "fact_delta", plain)
    for _ in range(2):
        load_warehouse(store, "w1", T2)
        assert facts_of(store) == [(1, 20240101, 10, T2), (2, 20240101, 20, T2)]
        assert bookmark_of(store) == T1.date()
        assert rows_of(store.read("dim_games"), "updated_at") == [(T1,), (T1,)]


def test_responses_that_landed_twice_count_once(spark, store):
    top, details, counts = payloads(spark, DAY1)
    failed = spark.createDataFrame([(1, "not json")], "appid int, body string")
    ingest(store, top, details.union(details).union(failed), counts.union(counts), T1.date(), T1, "d1")
    assert rows_of(store.read("snapshots"), "appid", "ccu") == [(1, 10), (2, 20)]
    assert store.read("rejects").isEmpty()


def test_the_load_tells_its_rows(spark, store):
    create_warehouse(store, T1)
    run(spark, store, DAY1, T1, "d1")
    loaded = load_warehouse(store, "w1", T1)
    assert loaded == "initial" and loaded.rows == {
        "dim_games": 2, "dim_publishers": 2, "bridge_game_publishers": 3, "dim_genres": 2, "bridge_game_genres": 2,
        FACT: 2, "etl_bookmark": 1,
    }
    assert load_warehouse(store, "w1", T2).rows == {}


@pytest.mark.parametrize("buckets", [7, 5000])
def test_keys_are_dense_and_stay_with_any_number_of_buckets(spark, store, make, buckets):
    layout = {f"{t}.key_buckets": buckets for t in ("dim_games", "dim_publishers", "dim_genres")}
    create_warehouse(store, T1, layout=layout | {"games.buckets": 5, "dim_games.buckets": 3})
    rows = [{"appid": a, "name": f"g{a}", "publishers": json.dumps([f"p{a % 40}"]), "updated_at": T1} for a in range(300)]
    store.publish("g1", [store.stage("g1", "games", make("games", *rows[:200]))])
    load_dimensions(store, "d1", T1, "initial")
    assert store.months("games") == list(range(5)) and store.months("dim_games") == list(range(3))

    def keys(table, natural, key):
        return dict(rows_of(store.read(table), natural, key))

    games, names = keys("dim_games", "appid", "game_key"), keys("dim_publishers", "publisher_name", "publisher_key")
    assert sorted(games.values()) == list(range(1, 201)) and sorted(names.values()) == list(range(1, 41))
    load_dimensions(store, "d2", T2, "initial")
    assert keys("dim_games", "appid", "game_key") == games
    store.publish("g2", [store.stage("g2", "games", make("games", *[r | {"updated_at": T3} for r in rows]))])
    load_dimensions(store, "d3", T3, "incremental")
    after = keys("dim_games", "appid", "game_key")
    assert {a: after[a] for a in games} == games and sorted(after.values()) == list(range(1, 301))
    assert keys("dim_publishers", "publisher_name", "publisher_key") == names


def test_a_number_of_buckets_must_name_a_table(store):
    for layout in ({"games.key_buckets": 3}, {"dim_games.buckets": 0}):
        with pytest.raises(ValueError, match="no number of buckets"):
            create_warehouse(store, T1, layout=layout)
