import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratamart.clock import RunClock  # noqa: E402
from stratamart.session import build_session, new_database  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "stratamart-tests", "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(root / "shared"),
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    name = new_database(spark, "t")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def clock():
    return RunClock.at("2023-06-30T08:04:11")


def rows(df, *order):
    """All rows as tuples, in a fixed order, for exact comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
