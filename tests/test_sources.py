import pytest
from data import gold
from farevalue.session import MIN_PARTITIONS, scratch_path, shuffle_partitions
from farevalue.sources.readers import read_envelopes, read_table
from farevalue.sources.writers import overwrite, overwrite_partitions, overwrite_ranges
from pyspark.sql import functions as F


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="missing.parquet"):
        read_table(spark, str(tmp_path / "missing.parquet"))
    with pytest.raises(FileNotFoundError):
        read_envelopes(spark, str(tmp_path / "missing.json"))


def test_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(gold(spark, {}, {}), path)
    overwrite(gold(spark, {}), path)
    assert read_table(spark, path).count() == 1


def days(spark, *names):
    rows = gold(spark, *({"flight_id": n} for n in names))
    return rows.withColumn("day", F.substring("flight_id", 1, 1))


@pytest.mark.parametrize("rebalance", [True, False])
def test_partitioned_overwrite(spark, tmp_path, rebalance):
    path = str(tmp_path / "t")

    def stored():
        return sorted(r["flight_id"] for r in read_table(spark, path).collect())

    overwrite_partitions(days(spark, "a1", "b1", "b2"), path, "day", rebalance=rebalance)
    assert stored() == ["a1", "b1", "b2"]
    assert sorted(p.name for p in (tmp_path / "t").glob("day=*")) == ["day=a", "day=b"]
    overwrite_partitions(
        days(spark, "b3", "c1"), path, "day", only_present=True, rebalance=rebalance
    )
    assert stored() == ["a1", "b3", "c1"]
    overwrite_partitions(days(spark, "d1"), path, "day", rebalance=rebalance)
    assert stored() == ["d1"]


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path, settings):
    """All rows fall on one day; AQE cuts the rebalanced partition into pieces."""
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    rows = spark.range(0, 50_000, 1, 8).selectExpr("uuid() AS value", "'one' AS day")
    overwrite_partitions(rows, str(tmp_path / "t"), "day")
    assert len(list((tmp_path / "t" / "day=one").glob("*.parquet"))) > 1
    assert read_table(spark, str(tmp_path / "t")).count() == 50_000


def test_ranges_do_not_overlap_and_a_hot_value_is_split(spark, tmp_path, settings):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "'m' AS month", "if(id % 2 = 0, 5, id) AS at", "id"
    )
    overwrite_ranges(rows, str(tmp_path / "t"), by="month", order=("at", "id"))
    stored = read_table(spark, str(tmp_path / "t"))
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("at", "id")).alias("low"), F.max(F.struct("at", "id")).alias("high")
    )
    spans = sorted((tuple(r["low"]), tuple(r["high"])) for r in files.collect())
    assert len(spans) == 4 and stored.count() == 4000
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert first != second


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == MIN_PARTITIONS
    assert shuffle_partitions(1024**4) == 4096
    assert shuffle_partitions(100 * 1024**4) >= 372_530
