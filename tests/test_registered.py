"""Every registered query against its SQL on DuckDB.

``FAREVALUE_TABLES`` names the folder with the tables.
"""

import os
from pathlib import Path

import pytest

import __spark_entry__ as registry
from check_results import connect, differences

TABLES = os.environ.get("FAREVALUE_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(TABLES).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = connect(TABLES)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_its_sql(spark, database, name):
    result = registry.queries()[name](spark, TABLES)
    assert result.count() > 0
    assert differences(result, database, registry.oracle_sql()[name]) is None


def test_flagship_query(spark):
    best = registry.entry(spark).collect()
    assert len(best) == 100
    values = [r["cpp_cents_per_point"] for r in best]
    assert values == sorted(values, reverse=True)
