import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import local_session
    session = local_session(8, app="tests", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database of its own in a folder that lives as long as the test."""
    name = "db_" + os.urandom(4).hex()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
