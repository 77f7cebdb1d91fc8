import os
from pathlib import Path

import pytest

import __spark_entry__ as registry


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    """Python workers can import the package wherever the tests are started."""
    registry._send_package(spark.sparkContext.applicationId, spark)


@pytest.fixture
def documents(spark):
    """Make a documents table from ids and texts, with columns whose names clash."""

    def make(rows, extra=True):
        table = spark.createDataFrame(rows, "doc_id long, text string")
        if not extra:
            return table
        return table.selectExpr(
            "doc_id", "text", "'x' AS grade", "1 AS toxic", "2 AS gone", "3 AS kept", "4 AS `key`",
            "5 AS size", "6 AS spans", "7 AS `a.b`", "8 AS graded", "9 AS n_chars",
        )

    return make


@pytest.fixture(scope="session")
def tables_folder():
    """The folder with the test tables; ``FAREVALUE_TABLES`` names another one."""
    folder = os.environ.get("FAREVALUE_TABLES", "/root/testdata/sf0.001")
    if not Path(folder).is_dir():
        pytest.skip("no test tables")
    return folder
