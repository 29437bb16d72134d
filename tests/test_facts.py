import datetime as dt

from conftest import T1, rows_of
from pyspark.sql import functions as F

from starload.functions.dates import date_key, day_name, month_name, weekday, year_month
from starload.operators.bookmark import (
    BEGINNING,
    changed_since,
    choose_load_mode,
    last_day,
    last_update,
    read_bookmark,
    seed_bookmark,
)
from starload.operators.facts import fact_delta, guard_days, orphans, past_bookmark, with_month
from starload.operators.names import bridge, list_names
from starload.schemas import FACT
from starload.sources.calendar import calendar, calendar_covering

D = dt.date


def snaps(make, *rows):
    return with_month(
        make("snapshots", *[{"appid": a, "recorded_date": d, "ccu": c} for a, d, c in rows]).drop("ym")
    )


def dims(make, *appids):
    return make("dim_games", *[{"game_key": 100 + a, "appid": a, "name": f"g{a}"} for a in appids])


def test_default_calendar(spark):
    days = calendar(spark)
    assert days.count() == 4018
    first, last = days.agg(F.min("full_date"), F.max("full_date")).first()
    assert (first, last) == (D(2020, 1, 1), D(2030, 12, 31))
    assert days.select("date_key").distinct().count() == 4018


def test_calendar_row(spark):
    days = {r.full_date: r for r in calendar(spark, D(2024, 9, 1), D(2024, 9, 7)).collect()}
    sunday, saturday = days[D(2024, 9, 1)], days[D(2024, 9, 7)]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.day_name) == (0, True, "Sunday   ")
    assert (saturday.day_of_week, saturday.is_weekend, saturday.day_name) == (6, True, "Saturday ")
    assert days[D(2024, 9, 4)].is_weekend is False
    assert (sunday.month, sunday.month_name, sunday.quarter, sunday.year) == (9, "September", 3, 2024)
    assert (sunday.date_key, sunday.ym) == (20240901, 202409)
    plain = calendar(spark, D(2024, 5, 1), D(2024, 5, 1), padded=False).first()
    assert (plain.day_name, plain.month_name) == ("Wednesday", "May")


def test_calendar_covering_a_table(spark, make):
    s = snaps(make, (1, D(2024, 2, 27), 0), (1, D(2024, 3, 2), 0))
    assert calendar_covering(s, F.col("recorded_date")).count() == 5


def test_date_expressions_agree_with_python(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1899-12-25', DATE'2101-01-05', INTERVAL 13 DAY)) d")
    c = F.col("d")
    for r in days.select("d", date_key(c), year_month(c), weekday(c), day_name(c), month_name(c)).collect():
        d = r[0]
        assert r[1] == int(d.strftime("%Y%m%d")) and r[2] == d.year * 100 + d.month
        assert r[3] == d.isoweekday() % 7
        assert r[4] == d.strftime("%A").ljust(9) and r[5] == d.strftime("%B").ljust(9)


def test_past_bookmark_is_strict(make):
    s = snaps(make, (1, D(2024, 1, 31), 1), (1, D(2024, 2, 1), 2), (1, D(2024, 3, 1), 3))
    assert rows_of(past_bookmark(s, D(2024, 1, 31)), "ccu") == [(2,), (3,)]
    assert rows_of(past_bookmark(s, D(2024, 1, 31), D(2024, 2, 1)), "ccu") == [(2,)]
    assert rows_of(past_bookmark(s, BEGINNING), "ccu") == [(1,), (2,), (3,)]


def test_fact_delta_and_orphans_split_the_rows(spark, make):
    s = snaps(
        make,
        (1, D(2019, 12, 31), 1),
        (1, D(2020, 1, 1), 2),
        (1, D(2030, 12, 31), 3),
        (1, D(2031, 1, 1), 4),
        (2, D(2024, 1, 1), 5),
        (2, D(2031, 1, 1), 6),
    )
    days = calendar(spark)
    facts = fact_delta(s, dims(make, 1), days)
    assert rows_of(facts, "game_key", "date_key", "ccu", "ym") == [
        (101, 20200101, 2, 202001),
        (101, 20301231, 3, 203012),
    ]
    assert rows_of(orphans(s, dims(make, 1), days)) == [
        (1, D(2019, 12, 31), "no_day"),
        (1, D(2031, 1, 1), "no_day"),
        (2, D(2024, 1, 1), "no_game"),
        (2, D(2031, 1, 1), "no_game_no_day"),
    ]


def test_guard_skips_stored_days_whole(make):
    offered = snaps(make, (1, D(2024, 1, 1), 1), (2, D(2024, 1, 1), 2), (1, D(2024, 1, 2), 3))
    stored = snaps(make, (9, D(2024, 1, 1), 0))
    assert rows_of(guard_days(offered, stored), "appid", "ccu") == [(1, 3)]
    assert guard_days(offered, stored.limit(0)).count() == 3


def test_bookmark_reading(spark, make):
    marks = seed_bookmark(spark, T1)
    assert read_bookmark(marks) == BEGINNING
    assert read_bookmark(marks.limit(0)) == BEGINNING
    moved = make("etl_bookmark", {"table_name": FACT, "last_loaded_date": D(2024, 5, 1)})
    assert read_bookmark(moved) == D(2024, 5, 1)
    assert read_bookmark(moved, "other") == BEGINNING
    assert last_day(snaps(make, (1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 3))) == D(2024, 1, 2)
    assert last_day(snaps(make).limit(0)) is None


def test_load_mode(make):
    facts = make(FACT, {"game_key": 1, "date_key": 20240101, "ym": 202401})
    games = dims(make, 1)
    assert choose_load_mode(facts, games) == "incremental"
    assert choose_load_mode(facts.limit(0), games) == "initial"
    assert choose_load_mode(facts, games.limit(0)) == "initial"


def test_changed_since_is_strict(make):
    later = T1 + dt.timedelta(seconds=1)
    games = make("games", {"appid": 1, "updated_at": T1}, {"appid": 2, "updated_at": later})
    assert rows_of(changed_since(games, T1), "appid") == [(2,)]
    assert changed_since(games, None).count() == 2
    assert last_update(games) == later and last_update(games.limit(0)) is None


def names_games(make):
    return make(
        "games",
        {"appid": 1, "publishers": '["A"," A ","",null,"  "]'},
        {"appid": 2, "publishers": '["A","B"]'},
        {"appid": 3, "publishers": "[]"},
        {"appid": 4},
        {"appid": 5, "publishers": '["B","\\tA"]'},
    )


def test_list_names(make):
    assert rows_of(list_names(names_games(make), "publishers", "n", "appid")) == [
        (1, "A"),
        (2, "A"),
        (2, "B"),
        (5, "\tA"),
        (5, "B"),
    ]


def test_bridge_needs_game_and_name(make):
    dim = make(
        "dim_publishers",
        {"publisher_key": 1, "publisher_name": "A"},
        {"publisher_key": 2, "publisher_name": "B"},
    )
    games = names_games(make)
    doubled = games.unionByName(games)
    for source in (games, doubled):
        pairs = bridge(source, dims(make, 1, 2), dim, "publishers", "publisher_name", "publisher_key")
        assert rows_of(pairs) == [(101, 1), (102, 1), (102, 2)]
