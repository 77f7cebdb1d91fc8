import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from farevalue.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "farevalue-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="5000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def shuffle_partitions(request):
    """The command line sizes the shuffles of its session, which all tests share."""
    session = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if session is not None:
        session.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    changed = {}

    def change(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
