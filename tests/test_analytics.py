import datetime as dt
from collections import defaultdict

import pytest
from conftest import rows_of

from starload.plans import analytics, trends
from starload.schemas import FACT
from starload.sources.calendar import calendar

D = dt.date
AS_OF = D(2024, 1, 31)


@pytest.fixture(scope="module")
def days(spark):
    return calendar(spark, D(2023, 12, 1), D(2024, 12, 31)).cache()


def facts(make, *rows):
    """(game, day, ccu)"""
    return make(
        FACT,
        *[
            {"game_key": g, "date_key": d.year * 10000 + d.month * 100 + d.day, "ccu": c, "ym": d.year * 100 + d.month}
            for g, d, c in rows
        ],
    )


def games(make, **names):
    """a1="x": game_key 1, appid 10, name x"""
    return make(
        "dim_games",
        *[{"game_key": int(k[1:]), "appid": int(k[1:]) * 10, "name": n} for k, n in names.items()],
    )


def test_game_series(make, days):
    f = facts(make, (1, D(2024, 1, 31), 5), (1, D(2024, 1, 1), 4), (1, D(2023, 12, 31), 3), (2, AS_OF, 9),
              (1, D(2024, 2, 5), 6))
    got = analytics.game_series(f, games(make, a1="x", a2="y"), days, 10, AS_OF)
    assert [tuple(r) for r in got.collect()] == [
        ("x", 4, D(2024, 1, 1)),
        ("x", 5, D(2024, 1, 31)),
        ("x", 6, D(2024, 2, 5)),
    ]


def test_top_games_null_first_and_ties_by_appid(make):
    f = facts(make, (1, AS_OF, 5), (2, AS_OF, 7), (3, AS_OF, None), (4, AS_OF, 5), (5, D(2024, 1, 30), 99))
    dim = games(make, a1="a", a2="b", a3="c", a4="d", a5="e")
    got = analytics.top_games(f, dim, AS_OF, 3)
    assert [(r.appid, r.ccu) for r in got.collect()] == [(30, None), (20, 7), (10, 5)]


def test_top_games_by_weekday_merges_equal_names(make, days):
    f = facts(
        make,
        (1, AS_OF, 9), (2, AS_OF, 8), (3, AS_OF, 1),
        (1, D(2024, 1, 24), 1), (2, D(2024, 1, 23), 4), (3, D(2024, 1, 24), 100),
        (1, D(2023, 12, 27), 1000),
    )
    dim = games(make, a1="same", a2="same", a3="other")
    got = analytics.top_games_by_weekday(f, dim, days, AS_OF, n=2)
    assert [tuple(r) for r in got.collect()] == [("same", 2, 4.0), ("same", 3, 6.0)]
    everyone = analytics.games_by_weekday(f, dim, days, AS_OF)
    assert rows_of(everyone) == [("other", 3, 50.5), ("same", 2, 4.0), ("same", 3, 6.0)]


def test_averages_ignore_nulls_and_may_be_null(make, days):
    f = facts(make, (1, AS_OF, None), (2, AS_OF, 4), (2, D(2024, 1, 24), None))
    dim = games(make, a1="x", a2="y")
    assert rows_of(analytics.games_by_weekday(f, dim, days, AS_OF)) == [("x", 3, None), ("y", 3, 4.0)]
    assert rows_of(trends.rollup(f, days).filter("grain = 'day'"), "rows", "total_ccu", "avg_ccu") == [
        (1, None, None),
        (2, 4, 4.0),
    ]


def links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "game_key bigint, genre_key bigint")


@pytest.fixture
def genres(make):
    return make(
        "dim_genres", {"genre_key": 1, "genre_name": "rpg"}, {"genre_key": 2, "genre_name": "fps"}
    )


def test_genre_performance_counts_a_game_in_each_genre(spark, make, genres):
    f = facts(make, (1, AS_OF, 10), (1, D(2024, 1, 30), 20), (2, AS_OF, 30), (3, AS_OF, 99))
    got = analytics.genre_performance(f, links(spark, (1, 1), (1, 2), (2, 2)), genres)
    assert rows_of(got) == [("fps", 2, 60, 20.0, 30), ("rpg", 1, 30, 15.0, 20)]


def test_drill_down_does_not_multiply(spark, make, days, genres):
    f = facts(make, (1, AS_OF, 10), (2, AS_OF, 30), (1, D(2024, 2, 1), 11))
    chosen = analytics.games_named(links(spark, (1, 1), (1, 2)), genres, "genre_key", "genre_name", ["rpg", "fps"])
    got = analytics.drill_down(f, games(make, a1="x", a2="y"), days, D(2024, 1, 1), AS_OF, chosen)
    assert rows_of(got, "appid", "full_date", "ccu") == [(10, AS_OF, 10)]


def test_monthly_trend(spark, make):
    f = facts(make, (1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 2), (2, D(2024, 1, 2), 6), (2, D(2024, 2, 2), 4))
    pairs = spark.createDataFrame([(1, "g"), (2, "g"), (2, "h")], "game_key bigint, genre string")
    assert rows_of(trends.monthly_trend(f, pairs, "genre")) == [
        ("g", 202401, 2, 9, 3.0),
        ("g", 202402, 1, 4, 4.0),
        ("h", 202401, 1, 6, 6.0),
        ("h", 202402, 1, 4, 4.0),
    ]


def test_rollup_against_plain_python(make, days):
    rows = [(g, D(2024, 1, 1) + dt.timedelta(days=i), g * i % 7) for g in (1, 2, 3) for i in range(0, 70, g)]
    expected = defaultdict(list)
    for _, d, c in rows:
        expected["day", d].append(c)
        expected["week", d - dt.timedelta(days=d.weekday())].append(c)
        expected["month", d.replace(day=1)].append(c)
    got = {(r.grain, r.period_start): r for r in trends.rollup(facts(make, *rows), days).collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        r = got[key]
        assert (r.rows, r.total_ccu, r.peak_ccu) == (len(values), sum(values), max(values))
        assert r.avg_ccu == pytest.approx(sum(values) / len(values))


def test_risers(make):
    f = facts(
        make,
        (1, AS_OF, 10), (1, D(2024, 1, 25), 20), (1, D(2024, 1, 24), 1), (1, D(2024, 1, 17), 999),
        (2, AS_OF, 1), (2, D(2024, 1, 18), 5),
        (3, AS_OF, 1),
    )
    dim = games(make, a1="up", a2="down", a3="new")
    got = [tuple(r) for r in trends.risers(f, dim, AS_OF).collect()]
    assert got == [(10, "up", 15.0, 1.0, 14.0), (20, "down", 1.0, 5.0, -4.0)]
    assert [r.appid for r in trends.risers(f, dim, AS_OF, n=1, rising=False).collect()] == [20]


def test_moving_average(make):
    f = facts(make, *[(1, D(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(9)], (2, AS_OF, 5))
    got = rows_of(trends.moving_average(f, games(make, a1="x", a2="y")))
    assert got[0] == (10, 20240101, 0, 0.0, None)
    assert got[8] == (10, 20240109, 8, 5.0, 1)
    assert got[9] == (20, 20240131, 5, 5.0, None)


def test_peak_compare_total(make, days):
    f = facts(make, (1, AS_OF, 4), (1, D(2024, 1, 1), 8), (2, AS_OF, 7))
    dim = games(make, a1="x", a2="y")
    assert rows_of(trends.peak_and_average(f, dim)) == [(10, "x", 8, 6.0, 2), (20, "y", 7, 7.0, 1)]
    assert [r.appid for r in analytics.compare_games(f, dim, n=1).collect()] == [20]
    total = analytics.total_series(f, days, last=AS_OF)
    assert [tuple(r) for r in total.collect()] == [(D(2024, 1, 1), 1, 8), (AS_OF, 2, 11)]


def test_most_active(spark):
    events = spark.createDataFrame(
        [(u, dt.datetime(2024, 1, d, 23, 59)) for u, d in [(1, 31), (1, 18), (2, 30), (2, 17), (3, 31), (3, 30)]],
        "user_id bigint, ts timestamp_ntz",
    )
    got = trends.most_active(events, "user_id", "ts", AS_OF, n=2)
    assert [tuple(r) for r in got.collect()] == [(1, 2), (3, 2)]


