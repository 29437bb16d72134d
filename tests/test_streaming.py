import datetime as dt

from conftest import T1, T2, rows_of

from starload.operators.bookmark import read_bookmark
from starload.plans.warehouse import create_warehouse, load_dimensions, load_facts
from starload.schemas import FACT
from starload.streaming.arrivals import ARRIVING, load_arrivals, store_arrivals

D = dt.date


def land(spark, folder, *rows):
    full = [(a, None, 0, 0, None, 0, 0, c, d) for a, d, c in rows]
    spark.createDataFrame(full, ARRIVING).coalesce(1).write.mode("append").parquet(folder)


def test_arrivals(spark, store, make, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    create_warehouse(store, T1)
    games = [{"appid": a, "name": f"g{a}", "updated_at": T1} for a in (1, 2)]
    store.publish("games", [store.stage("games", "games", make("games", *games))])
    load_dimensions(store, "dims", T1, "initial")

    land(spark, landing, (1, D(2024, 1, 31), 5), (9, D(2024, 2, 1), 6))
    load_arrivals(store, landing, checkpoint, T1)
    assert rows_of(store.read(FACT), "date_key", "ccu") == [(20240131, 5)]
    assert read_bookmark(store.read("etl_bookmark")) == D(2024, 1, 31)
    assert rows_of(store.read("rejects"), "appid", "reject_reason") == [(9, "no_game")]

    # A stored day is skipped whole; an earlier new day is stored but past the bookmark.
    land(spark, landing, (2, D(2024, 1, 31), 7), (2, D(2024, 1, 30), 8), (2, D(2024, 2, 2), 9))
    load_arrivals(store, landing, checkpoint, T2)
    assert rows_of(store.read("snapshots"), "appid", "ccu") == [(1, 5), (2, 8), (2, 9)]
    assert rows_of(store.read(FACT), "date_key", "ccu") == [(20240131, 5), (20240202, 9)]

    before = rows_of(store.read("snapshots"))
    load_arrivals(store, landing, checkpoint, T2)
    again = spark.read.schema(ARRIVING).parquet(landing)
    store_arrivals(store, again, "arrivals-0", T2)
    assert rows_of(store.read("snapshots")) == before


def test_bad_arrivals_go_to_the_rejects(spark, store, make):
    create_warehouse(store, T1)
    store.publish("games", [store.stage("games", "games", make("games", {"appid": 1, "name": "g"}, {"appid": 2}))])
    rows = [(1, None, 0, 0, None, 0, 0, 5, D(2024, 1, 1)), (1, "n", 0, 0, None, 0, 0, 5, None)]
    rows += [(None, "m", 0, 0, None, 0, 0, 5, D(2024, 1, 1)), (9, "u", 0, 0, "x" * 500, 0, 0, 5, D(2024, 1, 1))]
    rows += [(8, None, 0, 0, None, 0, 0, 5, D(2024, 1, 1)), (2, "y" * 600, 0, 0, None, 0, 0, 5, D(2024, 1, 1))]
    batch = spark.createDataFrame(rows, ARRIVING)
    for _ in range(2):  # a repeat changes nothing
        store_arrivals(store, batch, "a", T1)
        assert rows_of(store.read("snapshots"), "appid", "recorded_date") == [(1, D(2024, 1, 1))]
        assert rows_of(store.read("rejects"), "appid", "reject_reason", "run_id") == [
            (1, "no_recorded_date", "a"),
            (2, "long_name", "a"),
            (8, "no_game", "a"),
            (9, "long_owners", "a"),
            (None, "no_appid", "a"),
        ]
    load_facts(store, "f", T1)


def test_a_repeated_row_does_not_stop_the_stream(spark, store, make, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    create_warehouse(store, T1)
    store.publish("games", [store.stage("games", "games", make("games", *[{"appid": a, "name": "g"} for a in (1, 2, 3)]))])
    load_dimensions(store, "dims", T1, "initial")
    one, two = D(2024, 1, 1), D(2024, 1, 2)
    land(spark, landing, (1, one, 5), (1, one, 7), (1, one, 7), (1, one, 7), (2, one, 1), (3, two, 2), (3, two, 2))
    load_arrivals(store, landing, checkpoint, T1)
    assert rows_of(store.read("snapshots"), "appid", "ccu") == [(1, 7), (2, 1), (3, 2)]
    assert rows_of(store.read("rejects"), "appid", "reject_reason") == [(1, "repeated")] * 3 + [(3, "repeated")]
    # The rest of a day that is stored, and a day that is not.
    land(spark, landing, (3, one, 9), (3, one, 9), (1, D(2024, 1, 3), 4))
    load_arrivals(store, landing, checkpoint, T2)
    assert rows_of(store.read(FACT), "date_key", "ccu") == [(20240101, 1), (20240101, 7), (20240102, 2), (20240103, 4)]
    late = store.read("rejects").filter("reject_reason = 'day_stored'")
    assert rows_of(late, "appid", "run_id") == [(3, "arrivals-1"), (3, "arrivals-1")]


def test_arrivals_that_are_all_rejected(spark, store, make):
    create_warehouse(store, T1)
    store.publish("games", [store.stage("games", "games", make("games", {"appid": 1, "name": "g"}))])
    batch = spark.createDataFrame([(8, None, 0, 0, None, 0, 0, 5, D(2024, 1, 1))], ARRIVING)
    store_arrivals(store, batch, "a", T1)
    store_arrivals(store, batch.limit(0), "b", T1)
    assert store.read("snapshots").isEmpty() and store.read("rejects").count() == 1
