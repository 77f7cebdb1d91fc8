"""Fares of the star schema: narrow before the joins, stored by flight, and joined without a shuffle."""

from collections import Counter
from datetime import datetime

import pytest
from data import gold, plan_of
from farevalue.operators import valuation
from farevalue.operators.pricing import price_awards
from farevalue.operators.valuation import find_hot, value_fares
from farevalue.plans import catalog, medallion
from farevalue.plans.medallion import Layout, run_job
from farevalue.plans.star_schema import cash_fares
from farevalue.sources.files import Contents
from pyspark.sql import functions as F

LAYOUTS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_tax double, l_returnflag string, l_shipdate timestamp",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_size int",
}
DAY = datetime(1998, 6, 1)
LINE = (1, 1, 1, 1, 9.0, 90.5, 0.1, "R", DAY)


def line(**changes):
    names = [c.split()[0][2:] for c in LAYOUTS["lineitem"].split(", ")]
    return tuple(changes.get(name, value) for name, value in zip(names, LINE, strict=True))


def star(spark, folder, lines):
    """Tables with the given order lines; nations, sizes and days of every kind."""
    rows = {
        "lineitem": lines,
        "orders": [(1, 1, DAY), (2, 2, datetime(1969, 1, 1)), (3, 3, None), (4, None, DAY), (4, 1, DAY)],
        "customer": [(1, 0), (2, -2), (3, None), (3, 7)],
        "supplier": [(1, 0), (2, 1), (3, -1), (4, None), (4, 2)],
        "part": [(n, n - 1) for n in range(1, 9)] + [(9, None), (10, -3)],
    }
    for name, ddl in LAYOUTS.items():
        spark.createDataFrame(rows[name], ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


ODD = [
    line(),
    line(quantity=50.0, shipdate=None),
    line(quantity=None, returnflag=None, tax=None),
    line(quantity=-9.0, shipdate=datetime(1955, 2, 3), tax=0.0),
    line(quantity=15.7, linenumber=None),
    line(quantity=50.0, linenumber=-(2**31), extendedprice=None, returnflag="A"),
    line(orderkey=None),
    line(partkey=99),
    *(line(orderkey=n % 4 + 1, partkey=n % 10 + 1, suppkey=n % 4 + 1, linenumber=n) for n in range(40)),
]


def texts_of(spark, folder):
    """Cash fares by one plain join of all columns."""
    for name in LAYOUTS:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(f"star_{name}")
    return spark.sql(
        """SELECT concat('F', l_orderkey, '-', l_linenumber) AS flight_id,
        CASE s_nationkey % 3 WHEN 0 THEN 'LAX' WHEN 1 THEN 'SFO' ELSE 'JFK' END AS origin_airport,
        CASE c_nationkey % 3 WHEN 0 THEN 'JFK' WHEN 1 THEN 'SFO' ELSE 'LAX' END AS destination_airport,
        CASE p_size % 7 WHEN 0 THEN 'Delta' WHEN 1 THEN 'American Airlines' WHEN 2 THEN 'United'
          WHEN 3 THEN 'Alaska Airlines' WHEN 4 THEN 'Frontier' WHEN 5 THEN 'Other Air' END AS airline,
        concat(date(l_shipdate), 'T10:00:00Z') AS departure_datetime,
        CASE WHEN l_quantity = 50 THEN 'not-a-time' ELSE concat(date(l_shipdate), 'T',
          lpad(cast(int(8 + l_quantity % 16) AS string), 2, '0'), ':30:00Z') END AS arrival_datetime,
        CASE l_returnflag WHEN 'R' THEN 'business' ELSE 'economy' END AS cabin_class,
        l_extendedprice AS cash_price, CASE WHEN l_tax = 0 THEN ' ' ELSE 'USD' END AS currency,
        concat(date(o_orderdate), 'T00:00:00+00:00') AS ingestion_timestamp
        FROM star_lineitem JOIN star_orders ON l_orderkey = o_orderkey
        JOIN star_customer ON o_custkey = c_custkey JOIN star_supplier ON l_suppkey = s_suppkey
        JOIN star_part ON l_partkey = p_partkey"""
    )


def test_fares_survive_the_joins_as_numbers(spark, tmp_path, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    folder = star(spark, tmp_path, ODD)
    fares, wanted = cash_fares(spark, folder, buckets=3), texts_of(spark, folder)
    assert fares.dtypes == wanted.dtypes
    assert Counter(fares.collect()) == Counter(wanted.collect())
    plan = plan_of(fares)
    assert plan.index("not-a-time") < plan.index("Exchange hashpartitioning(concat(F")


@pytest.mark.parametrize("copies", [1, 60])
def test_stored_fares_are_joined_without_a_shuffle(spark, tmp_path, settings, copies):
    """A flight with 60 of 100 rows is stored apart, which changes no result."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.requireAllClusterKeysForCoPartition", "true")
    lines = [line()] * (copies - 1) + [line(linenumber=n, orderkey=n % 2 + 1) for n in range(40)]
    folder = star(spark, tmp_path, lines)
    plain = texts_of(spark, folder)
    cash = catalog.cash_parts(spark, folder)
    assert [buckets > 0 for _, buckets in cash] == [True, False][: 1 + (copies > 1)]
    assert Counter(r for part, _ in cash for r in part.collect()) == Counter(plain.collect())
    both = price_awards(plain).unionByName(price_awards(plain, cabin="economy", program="award"))
    programs = catalog.gold_two_programs(spark, folder)
    assert Counter(programs.collect()) == Counter(value_fares(plain, both).collect())
    served = catalog.served_fares(spark, folder)
    assert served.count() == value_fares(plain, price_awards(plain)).select("flight_id").distinct().count()
    if copies == 1:
        assert "Exchange" not in plan_of(served)


def test_gold_of_two_loads_stores_no_awards_beside_it(spark, tmp_path):
    folder = star(spark, tmp_path, ODD)
    assert catalog.gold_day_wise(spark, folder).count() > 0
    assert not any(key[1:] == (folder, "awards") for key in catalog._SHARED)


def test_warm_ids_are_repeated_where_they_were_joined(spark, tmp_path):
    cash = gold(spark, *([{"flight_id": "warm", "cash_price": float(n % 3)} for n in range(30)]), {})
    award = price_awards(cash)
    find_hot(cash, award, 5).write.parquet(f"{tmp_path}/warm")
    warm = spark.read.parquet(f"{tmp_path}/warm")
    assert [(r["flight_id"], r["far"]) for r in warm.collect()] == [("warm", False)]
    valued = value_fares(cash, award, warm=warm)
    assert Counter(valued.collect()) == Counter(value_fares(cash, award).collect())
    assert "REPARTITION" not in plan_of(valued) and "REPARTITION" in plan_of(value_fares(cash, award, warm))


def test_far_ids_have_more_pairs_than_one_task_makes(spark, monkeypatch):
    monkeypatch.setattr(valuation, "PIECE", 50)
    cash = gold(spark, *([{"flight_id": "far"}] * 30), *([{"flight_id": "warm"}] * 20))
    found = find_hot(cash, price_awards(cash), 5).collect()
    assert {r["flight_id"]: r["far"] for r in found} == {"far": True, "warm": False}


def test_the_job_joins_by_bucket_in_any_session(spark, tmp_path, settings):
    settings("spark.sql.requireAllClusterKeysForCoPartition", "true")
    run_job(spark, Layout(str(tmp_path / "raw"), str(tmp_path / "tables")), steps=())
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"


def test_a_bucket_of_all_periods_fits_a_task(spark, tmp_path, monkeypatch):
    class Bronze:
        def folder(self, run):
            return run

        def live(self):
            return {f"{year}-01-01": "run" for year in range(1992, 1999)}

    monkeypatch.setattr(medallion, "contents", lambda spark, path: Contents(4 * 1024**3, 1, 1))
    buckets = medallion.choose_buckets(spark, Layout("raw", "root", period="year"), Bronze())
    assert 4 * 1024**3 / buckets <= 16 * 1024**2
    many = medallion.choose_buckets(spark, Layout("raw", "root", period="day"), Bronze())
    assert many >= spark.sparkContext.defaultParallelism
