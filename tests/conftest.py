import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starload.schemas import SCHEMAS  # noqa: E402
from starload.session import local_session  # noqa: E402
from starload.sources.store import Store  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def make(spark):
    """make("games", {...}, {...}): rows of a stored table, NULL where nothing is said."""

    def build(table, *rows):
        schema = SCHEMAS[table]
        names = spark.createDataFrame([], schema).columns
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)

    return build


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(str, r)))


T1 = dt.datetime(2024, 1, 1, 6)
T2 = dt.datetime(2024, 1, 2, 6)
T3 = dt.datetime(2024, 1, 3, 6)
