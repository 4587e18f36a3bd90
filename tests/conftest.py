from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corridor.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 4, "4g", **{"spark.checkpoint.dir": folder})
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    from corridor.session import new_database

    return new_database(spark)


def rows(df):
    """The rows as a sorted list of tuples, None first."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])
