import datetime as dt

import pytest
from conftest import T1, rows_of

from starload.operators.checks import CheckFailed
from starload.schemas import FACT
from starload.sources.store import Overlap, Store, bucket_of


def fact(make, *rows):
    return make(
        FACT,
        *[{"game_key": g, "date_key": d, "ccu": c, "created_at": T1, "ym": d // 100} for g, d, c in rows],
    )


def facts_of(store, months=None):
    return rows_of(store.read(FACT, months), "game_key", "date_key", "ccu")


def test_empty_store(store):
    assert store.read("games").isEmpty()
    assert store.read(FACT).columns[-1] == "ym"
    assert store.months(FACT) == []


def test_nothing_is_visible_before_publish(store, make):
    staged = store.stage("r1", FACT, fact(make, (1, 20240101, 5)), appended=True)
    assert store.read(FACT).isEmpty()
    assert store.read_staged(staged).count() == 1
    store.publish("r1", [staged])
    assert facts_of(store) == [(1, 20240101, 5)]


def test_append_and_replace_by_month(store, make):
    store.publish("a", [store.stage("a", FACT, fact(make, (1, 20240101, 1), (1, 20240201, 2)), True)])
    store.publish("b", [store.stage("b", FACT, fact(make, (1, 20240102, 3)), True)])
    assert facts_of(store) == [(1, 20240101, 1), (1, 20240102, 3), (1, 20240201, 2)]
    store.publish("c", [store.stage("c", FACT, fact(make, (1, 20240101, 9)))])
    assert facts_of(store) == [(1, 20240101, 9), (1, 20240201, 2)]
    store.publish("d", [store.stage("d", FACT, fact(make, (2, 20240103, 4)), True)])
    assert facts_of(store, [202401]) == [(1, 20240101, 9), (2, 20240103, 4)]
    assert store.months(FACT) == [202401, 202402]


def test_readers_of_the_old_version_keep_it(store, make):
    store.publish("a", [store.stage("a", "games", make("games", {"appid": 1}))])
    before = store.read("games")
    store.publish("b", [store.stage("b", "games", make("games", {"appid": 2}))])
    assert rows_of(before, "appid") == [(1,)]
    assert rows_of(store.read("games"), "appid") == [(2,)]


def test_a_second_store_sees_all_of_a_run_after_refresh(spark, store, make):
    other = Store(spark, store.root)
    staged = [
        store.stage("a", "games", make("games", {"appid": 1})),
        store.stage("a", FACT, fact(make, (1, 20240101, 1)), True),
    ]
    store.publish("a", staged)
    assert other.read("games").isEmpty() and other.read(FACT).isEmpty()
    other.refresh()
    assert other.read("games").count() == 1 and other.read(FACT).count() == 1


def test_an_interrupted_run_can_be_repeated(store, make):
    store.stage("a", "games", make("games", {"appid": 1}, {"appid": 2}))
    staged = store.stage("a", "games", make("games", {"appid": 3}))
    store.publish("a", [staged])
    assert rows_of(store.read("games"), "appid") == [(3,)]
    with pytest.raises(ValueError, match="already published"):
        store.stage("a", "games", make("games"))


def test_types_survive(store, make):
    row = {"appid": 1, "name": "é", "recorded_date": dt.date(2024, 1, 31), "created_at": T1, "ym": 202401}
    store.publish("a", [store.stage("a", "snapshots", make("snapshots", row), True)])
    assert store.read("snapshots").schema == make("snapshots").schema
    assert rows_of(store.read("snapshots")) == rows_of(make("snapshots", row))


def test_publishing_empty_tables(store, make):
    store.publish("a", [store.stage("a", FACT, fact(make)), store.stage("a", "games", make("games"))])
    assert store.read(FACT).isEmpty() and store.read("games").isEmpty()


def test_rows_without_a_part_or_a_required_value_are_refused(store, make):
    for table, row in [("snapshots", {"appid": 1, "ym": None}), ("games", {"name": "x"}), (FACT, {"game_key": 1, "ym": 202401})]:
        with pytest.raises(CheckFailed, match="required"):
            store.stage("a", table, make(table, row), appended=True)
    with pytest.raises(CheckFailed, match="too long"):
        store.stage("a", "games", make("games", {"appid": 1, "name": "x" * 501}))
    assert store.read("snapshots").isEmpty() and store.months("snapshots") == []


def test_an_overlapping_writer_is_refused(spark, store, make):
    other = Store(spark, store.root)
    staged = store.stage("a", "games", make("games", {"appid": 1}, {"appid": 2}))
    other.publish("b", [other.stage("b", "games", make("games", {"appid": 1}, {"appid": 3}))])
    with pytest.raises(Overlap, match="games has changed"):
        store.publish("a", [staged])
    assert rows_of(store.read("games"), "appid") == [(1,), (3,)]
    # Other tables, and other buckets of the same one, do not matter.
    ids = {r.appid: r.b for r in make("games", *[{"appid": a} for a in range(1, 9)]).select("appid", bucket_of("games").alias("b")).collect()}
    apart = next(a for a in ids if ids[a] not in (ids[1], ids[3]))
    staged = store.stage("c", "games", make("games", {"appid": apart}), whole=False)
    other.refresh()
    other.publish("d", [other.stage("d", "games", make("games", {"appid": 1, "name": "new"}), whole=False)])
    store.publish("c", [staged])
    assert (1, "new") in rows_of(store.read("games"), "appid", "name")
    assert (apart, None) in rows_of(store.read("games"), "appid", "name")


def test_rows_are_counted(store, make):
    assert store.stage("a", "games", make("games", {"appid": 1}, {"appid": 2})).rows == 2
    assert store.stage("a", FACT, fact(make, (1, 20240105, 1), (1, 20240103, 1)), True).first_day == 20240103
    assert store.stage("a", FACT, fact(make), True).rows == 0


def test_compaction_and_cleaning_bound_the_store(spark, store, make):
    for k in range(1, 13):
        store.publish(f"r{k}", [store.stage(f"r{k}", FACT, fact(make, (1, 20240100 + k, k)), True)])
    before = facts_of(store)
    assert len(store._live(FACT)[202401]) == 12
    store.compact(FACT, 202401, "c1")
    assert len(store._live(FACT)[202401]) == 1 and facts_of(store) == before
    store.work("x", "y", make("games"))
    gone = store.clean(states=1)
    assert any(g.startswith(f"{FACT}/run=r1-") for g in gone) and "_work" in gone
    assert len([g for g in gone if g.startswith("_published")]) == 12
    assert facts_of(Store(spark, store.root)) == before
    assert Store(spark, store.root).is_published("r3")
    assert store.clean(states=1) == []


def test_an_unfinished_state_is_not_read(spark, store, make, monkeypatch):
    store.publish("a", [store.stage("a", "games", make("games", {"appid": 1}))])
    with monkeypatch.context() as dying:
        dying.setattr(store, "_context", None)  # the state is written, but never gets its number
        with pytest.raises(AttributeError):
            store.publish("x", [store.stage("x", "games", make("games", {"appid": 4}))])
    assert rows_of(Store(spark, store.root).read("games"), "appid") == [(1,)]
    store.publish("b", [store.stage("b", "games", make("games", {"appid": 5}))])
    assert rows_of(store.read("games"), "appid") == [(5,)]
    assert len([g for g in store.clean() if g.startswith("_published/draft-")]) == 1


def test_a_forgotten_run_cannot_touch_published_rows(spark, store, make, monkeypatch):
    """Of three runs only two ids are remembered; the first one comes again with other rows."""
    monkeypatch.setattr("starload.sources.store.KEPT_RUNS", 2)
    days = {f"r{k}": [(g, 20240100 + k, k) for g in range(10)] for k in range(1, 4)}
    for run, rows in days.items():
        store.publish(run, [store.stage(run, FACT, fact(make, *rows), True)])
    before = facts_of(store)
    with pytest.raises(ValueError, match="already published"):
        store.stage("r1", FACT, fact(make, (1, 20240201, 9)), True)
    # Folded away, so that nothing of the run is in force: the id may be used again, in folders of its own.
    store.compact(FACT, 202401, "c")
    staged = store.stage("r1", FACT, fact(make, (1, 20240201, 9), (2, 20240201, 9), (3, 20240201, 9)), True)
    assert facts_of(store) == facts_of(Store(spark, store.root)) == before
    store.publish("r1", [staged])
    assert facts_of(store) == sorted(before + [(g, 20240201, 9) for g in (1, 2, 3)], key=lambda r: tuple(map(str, r)))


def test_a_repeated_attempt_writes_to_another_folder(store, make):
    first, second = (store.stage("a", "games", make("games", {"appid": k})) for k in (1, 2))
    assert first.path != second.path and rows_of(store.read_staged(first), "appid") == [(1,)]


def test_of_two_publishers_of_one_state_one_is_refused(spark, store, make, monkeypatch):
    other = Store(spark, store.root)
    staged = store.stage("a", "etl_bookmark", make("etl_bookmark"))
    check = Store.check

    def meanwhile(self, staged):
        check(self, staged)
        if self is store and not other.is_published("b"):  # after this one has looked at the newest state, before it takes a number
            other.publish("b", [other.stage("b", "games", make("games", {"appid": 7}))])

    monkeypatch.setattr(Store, "check", meanwhile)
    with pytest.raises(Overlap, match="state 1"):
        store.publish("a", [staged])
    store.refresh()
    assert rows_of(store.read("games"), "appid") == [(7,)] and not store.is_published("a")
    store.publish("a", [staged])
    assert store.is_published("a") and store.is_published("b")


def test_keys_and_references_are_checked_before_publishing(store, make):
    """dim_date is broadcast on the promise of one row a day, facts are joined on that of one row a game."""
    day = {
        "date_key": 20240101, "full_date": dt.date(2024, 1, 1), "day_of_week": 1, "day_name": "Monday", "month": 1,
        "month_name": "January", "quarter": 1, "year": 2024, "is_weekend": False, "ym": 202401,
    }
    with pytest.raises(CheckFailed, match="dim_date: more than one row for date_key.*full_date"):
        store.publish("a", [store.stage("a", "dim_date", make("dim_date", day, day))])
    games = make("dim_games", {"game_key": 1, "appid": 5, "name": "g"})
    staged = [store.stage("a", "dim_date", make("dim_date", day)), store.stage("a", "dim_games", games)]
    with pytest.raises(CheckFailed, match="game_key without a row of dim_games.*2"):
        store.publish("a", [*staged, store.stage("a", FACT, fact(make, (1, 20240101, 1), (2, 20240101, 1)), True)])
    store.publish("a", staged)
    with pytest.raises(CheckFailed, match="date_key without a row of dim_date"):
        store.publish("b", [store.stage("b", FACT, fact(make, (1, 20240102, 1)), True)])
    with pytest.raises(CheckFailed, match="more than one row for game_key, date_key"):
        store.publish("b", [store.stage("b", FACT, fact(make, (1, 20240101, 1), (1, 20240101, 2)), True)])
    store.publish("b", [store.stage("b", FACT, fact(make, (1, 20240101, 1)), True)])
    with pytest.raises(CheckFailed, match="more than one row for game_key, date_key"):
        store.publish("c", [store.stage("c", FACT, fact(make, (1, 20240101, 1)), True)])  # stored already
    with pytest.raises(CheckFailed, match="dim_games: more than one row for game_key"):
        twins = make("dim_games", {"game_key": 1, "appid": 5, "name": "g"}, {"game_key": 1, "appid": 6, "name": "h"})
        store.publish("c", [store.stage("c", "dim_games", twins)])
    assert facts_of(store) == [(1, 20240101, 1)]


def games(spark, make, ids, name):
    frame = spark.createDataFrame([(a,) for a in ids], "appid int")
    from pyspark.sql import functions as F

    return frame.select("appid", *[F.lit(name if c == "name" else None).alias(c) for c in make("games").columns[1:-2]])


def merged_in(store, batch, run, now=T1):
    from starload.operators.merge import upsert_current

    rows = batch.count()
    staged = store.merge(run, "games", batch, rows, lambda old: upsert_current(old, batch, now))
    store.publish(run, [staged])
    return staged


def test_a_small_batch_is_a_delta(spark, store, make):
    """200 games in a table of 100,000: the table is not written again, and reads as if it had been."""
    merged_in(store, games(spark, make, range(100_000), "old"), "a")
    ids = [*range(0, 99_500, 500), 200_000]
    staged = merged_in(store, games(spark, make, ids, "new"), "b")
    assert staged.delta and staged.rows == 200
    again = merged_in(store, games(spark, make, ids[:50], "newer"), "c")
    assert again.rows == 50 and store.deltas("games") == 2
    counts = {r.name: r["count"] for r in store.read("games").groupBy("name").count().collect()}
    assert counts == {"old": 100_001 - 200, "new": 150, "newer": 50}
    part = store.read("games", [3]).select("appid", "name").collect()
    everything = store.read("games").filter(bucket_of("games") == 3).select("appid", "name").collect()
    assert sorted(part) == sorted(everything) and len(part) > 2000
    before = rows_of(store.read("games").filter("name <> 'old'"), "appid", "name", "created_at")
    with pytest.raises(ValueError, match="deltas"):
        store.publish("x", [store.stage("x", "games", store.read("games", [3]), whole=False)])
    store.compact("games", None, "fold")
    assert store.deltas("games") == 0 and store.read("games").count() == 100_001
    assert rows_of(store.read("games").filter("name <> 'old'"), "appid", "name", "created_at") == before


def test_deltas_are_folded_when_there_are_many_or_they_are_large(spark, store, make, monkeypatch):
    monkeypatch.setattr("starload.sources.store.DELTAS", 3)
    merged_in(store, games(spark, make, range(1000), "old"), "a")
    kinds = [merged_in(store, games(spark, make, [k], f"n{k}"), f"b{k}").delta for k in range(5)]
    assert kinds == [True, True, True, False, True]
    assert not merged_in(store, games(spark, make, range(100), "many"), "c").delta
    counts = {r.name: r["count"] for r in store.read("games").groupBy("name").count().collect()}
    assert counts == {"many": 100, "old": 900} and store.deltas("games") == 0


def test_two_deltas_of_one_state_are_an_overlap(spark, store, make):
    merged_in(store, games(spark, make, range(100), "old"), "a")
    other = Store(spark, store.root)
    staged = store.stage("b", "games", make("games", {"appid": 1, "name": "x"}), delta=True)
    merged_in(other, games(spark, make, [1], "y"), "c")
    with pytest.raises(Overlap):
        store.publish("b", [staged])


def test_numbers_of_buckets_are_kept_with_the_store(spark, store, make):
    store.publish("a", [store.stage("a", "etl_bookmark", make("etl_bookmark"))], {"games.buckets": 7})
    merged_in(store, games(spark, make, range(100), "old"), "b")
    assert store.months("games") == list(range(7)) and Store(spark, store.root).buckets("games") == 7
    with pytest.raises(ValueError, match="games.buckets is 7 already"):
        store.publish("c", [store.stage("c", "etl_bookmark", make("etl_bookmark"))], {"games.buckets": 9})
    assert store.buckets("dim_games") == 32
