from collections import Counter

import pytest
from data import plan_of
from farevalue.sources.files import contents, folders
from farevalue.sources.versions import Versions, period_text
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window



def schema():
    return StructType.fromDDL("id string, v bigint")


def rows(spark, *values):
    """Rows of id, value and day."""
    return spark.createDataFrame(values, "id string, v bigint, period string").withColumn(
        "period", F.col("period").cast("date")
    )


def store(table, df, periods=None, **bucketing):
    run = table.begin()
    table.write(df, run, **bucketing)
    return table.commit(run, table.periods_in(run), periods, bucketing.get("buckets", 0))


def content(spark, path, key=None, upto=None):
    found = Versions(spark, path).read(schema(), key=key, upto=upto)
    return Counter((r["id"], r["v"], str(r["period"])) for r in found.collect())


@pytest.mark.parametrize("bucketing", [{}, {"key": "id", "buckets": 3}])
def test_the_newest_run_of_a_period_counts(spark, tmp_path, bucketing):
    path, key = f"{tmp_path}/it's a table", bucketing.get("key")
    table = Versions(spark, path)
    first = [("a", 1, "2026-01-01"), ("b", 2, "2026-01-02"), ("c", 3, None), ("c", 3, None)]
    store(table, rows(spark, *first), **bucketing)
    assert content(spark, path, key) == Counter((i, v, str(p)) for i, v, p in first)

    store(table, rows(spark, ("d", 4, "2026-01-02")), {"2026-01-02"}, **bucketing)
    after = Counter({("a", 1, "2026-01-01"): 1, ("d", 4, "2026-01-02"): 1, ("c", 3, "None"): 2})
    assert content(spark, path, key) == after
    # A period can lose all its rows, and null is a period like any other.
    store(table, rows(spark, ("e", 5, None)), {None, "2026-01-01"}, **bucketing)
    assert content(spark, path, key) == Counter([("d", 4, "2026-01-02"), ("e", 5, "None")])
    assert content(spark, path, key, upto=2) == after
    assert Versions(spark, path).changed_since(1) == {None, "2026-01-01", "2026-01-02"}
    assert Versions(spark, path).changed_since(3) == set()

    store(table, rows(spark, ("f", 6, "2026-01-09")), **bucketing)
    assert content(spark, path, key) == Counter([("f", 6, "2026-01-09")])
    assert Versions(spark, path).changed_since(3) is None


def test_an_unfinished_run_is_not_read(spark, tmp_path):
    table = Versions(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        table.read(schema())
    run = table.begin()
    table.write(rows(spark, ("a", 1, "2026-01-01")), run)
    with pytest.raises(FileNotFoundError):
        Versions(spark, str(tmp_path)).read(schema())
    store(table, rows(spark, ("b", 2, "2026-01-01")))
    table.write(rows(spark, ("c", 3, "2026-01-01")), table.begin())
    assert content(spark, str(tmp_path)) == Counter([("b", 2, "2026-01-01")])


def test_stored_rows_are_joined_grouped_and_ranked_without_a_shuffle(spark, tmp_path, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    days = ["2026-01-01", "2026-01-02"]
    many = rows(spark, *((str(n % 40), n, days[n % 2]) for n in range(200))).repartition(4, "id")
    tables = [Versions(spark, f"{tmp_path}/{name}") for name in "ab"]
    for table in tables:
        store(table, many, key="id", buckets=4)
        store(table, many.where("period = '2026-01-02'"), {"2026-01-02"}, key="id", buckets=4)
    one, two = (Versions(spark, t.path).read(schema(), key="id") for t in tables)
    order = Window.partitionBy("id").orderBy("v")
    plans = {
        "join on more keys": one.join(two, ["id", "period"]),
        "group": one.groupBy("id").count(),
        "rank": one.withColumn("r", F.row_number().over(order)).where("r = 1"),
    }
    for name, df in plans.items():
        assert "Exchange" not in plan_of(df), name
    assert plans["join on more keys"].count() == 40 * 5 * 5 and plans["rank"].count() == 40


def test_prune_keeps_what_the_last_complete_runs_need(spark, tmp_path):
    table = Versions(spark, str(tmp_path))
    for n in range(3):
        store(table, rows(spark, ("a", n, "2026-01-01")))
        store(table, rows(spark, ("b", n, "2026-01-02")), {"2026-01-02"})
    removed = table.prune(keep=2)
    assert removed == [c.run for c in table.log[:2]]
    assert set(folders(spark, f"{tmp_path}/runs")) == {c.run for c in table.log[2:]}
    assert content(spark, str(tmp_path), upto=3) == Counter([("a", 1, "2026-01-01")])
    assert content(spark, str(tmp_path)) == Counter([("a", 2, "2026-01-01"), ("b", 2, "2026-01-02")])


def test_period_text():
    assert period_text("2026-07-09", "month") == "2026-07-01"
    assert period_text("2026-07-09", "year") == "2026-01-01"
    assert period_text(None, "year") is None and period_text("2026-07-09") == "2026-07-09"


def test_contents(spark, tmp_path):
    assert contents(spark, f"{tmp_path}/nowhere").size == 0
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("12345")
    (tmp_path / "b").write_text("123")
    before = contents(spark, f"{tmp_path}/*")
    assert (before.size, before.files) == (8, 2)
    (tmp_path / "a" / "y").write_text("")
    assert contents(spark, f"{tmp_path}/*").mark() != before.mark()
