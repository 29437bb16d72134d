import pytest
from conftest import rows_of

from starload.operators import checks


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ab", 5), (1, "abcd", None), (2, None, 2**31), (None, "x", 7), (None, "x", 8)],
        "k int, name string, big bigint",
    )


def test_unique(people):
    assert rows_of(checks.unique_violations(people, ["k"])) == [(1, 2)]
    assert checks.unique_violations(people, ["k", "name"]).isEmpty()


def test_not_null(people):
    assert rows_of(checks.null_violations(people, ["k", "name"])) == [("k", 2), ("name", 1)]
    assert checks.null_violations(people.limit(0), ["k"]).isEmpty()


def test_length(people):
    assert rows_of(checks.length_violations(people, {"name": 3})) == [("name", 1, 4)]
    assert checks.length_violations(people, {"name": 4}).isEmpty()


def test_range(people):
    assert rows_of(checks.range_violations(people, ["big", "k"])) == [("big", 1)]


def test_reference(spark, people):
    parents = spark.createDataFrame([(2,)], "id int")
    assert rows_of(checks.reference_violations(people, parents, "k", "id")) == [(1, 2)]


def test_cascade(spark, people):
    gone = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows_of(checks.cascade_delete(people, gone, ["k"]), "big") == [(2**31,), (7,), (8,)]


def test_required(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (2, None, None), (3, "c", None)], "appid int, name string, ccu int"
    )
    assert rows_of(checks.required_violations(df), "appid", "missing") == [(2, "name"), (3, "ccu")]


def test_require_none(people):
    checks.require_none(people.limit(0), "fine")
    with pytest.raises(checks.CheckFailed, match="broken"):
        checks.require_none(people, "broken")
