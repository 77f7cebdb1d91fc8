"""Resharding: near-equal sizes, fewest bytes, whole texts, files left alone."""

import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from farevalue.llm import sharding
from farevalue.llm.queries import QUERIES
from farevalue.session import scratch_path


def check_shards(rows, texts, shards=40, slack=None):
    """Every document once, with its digest; gapless slots; near-equal sizes."""
    given = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == given
    slots, sizes = defaultdict(list), dict.fromkeys(range(shards), 0)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) == set(range(shards))
    if slack is not None:
        mean = sum(sizes.values()) / shards
        assert max(abs(s - mean) for s in sizes.values()) <= slack


def test_query(spark, tables_folder):
    docs = spark.read.parquet(f"{tables_folder}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op13_sharding"](spark, tables_folder).collect()
    check_shards(rows, [tuple(r) for r in docs])
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_sizes_are_near_equal_beside_a_hot_shard_and_long_texts(spark, settings):
    settings("spark.sql.shuffle.partitions", 5)
    texts = [(n, "x" * (n * 37 % 150)) for n in range(12_000)] + [(12_000 + n, "y" * 30_000) for n in range(9)]
    texts += [(None, f"null id {n}") for n in range(3000)] + [(12_345, None), (12_346, "")] + [(5, "z" * 20)] * 200
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    rows = sharding.reshard_documents(docs).collect()
    check_shards(rows, texts, slack=2000)
    moved = sum(r["size"] for r in rows if r["shard"] != r["old_shard"])
    old = Counter()
    for r in rows:
        old[r["old_shard"]] += r["size"]
    mean = sum(old.values()) / 40
    needed = sum(max(0, size - mean) for size in old.values())
    assert moved <= needed + 32 * 2000


def cheapest_by_trial(sizes, capacities):
    """Least bytes moved, over all ways to place every unit."""
    units = [old for old, size in sizes.items() for _ in range(size)]
    best = None
    for places in itertools.product(range(len(capacities)), repeat=len(units)):
        if all(places.count(n) <= c for n, c in enumerate(capacities)):
            moved = sum(old != new for old, new in zip(units, places))
            best = moved if best is None else min(best, moved)
    return best


@pytest.mark.parametrize(
    ("sizes", "capacities"),
    [
        ({0: 4, 1: 2}, [2, 2, 2]),
        ({0: 1, 1: 5}, [3, 3]),
        ({0: 0, 1: 6}, [2, 1, 3]),
        ({3: 2, 5: 2, 0: 2}, [2, 2, 2]),
        ({0: 3, 1: 3}, [0, 4, 3]),
    ],
)
def test_flow_moves_the_fewest_bytes(sizes, capacities):
    found = sharding.fewest_bytes(sizes, capacities)
    assert sum(t.moved for t in found if t.old != t.new) == cheapest_by_trial(sizes, capacities)
    for old, size in sizes.items():
        assert sum(t.moved for t in found if t.old == old) == size
    for new, capacity in enumerate(capacities):
        assert sum(t.moved for t in found if t.new == new) <= capacity


def test_near_equal_beside_loads():
    assert sharding.near_equal(10, [0, 0, 0]) == [4, 3, 3]
    assert sharding.near_equal(10, [9, 0, 1]) == [0, 6, 4] or sharding.near_equal(10, [9, 0, 1]) == [0, 5, 5]
    assert sharding.near_equal(0, [3, 0]) == [0, 0]


def test_a_document_larger_than_a_capacity(spark):
    texts = [(1, "a" * 100_000)] + [(n, "b" * 84) for n in range(2, 500)]
    rows = sharding.reshard_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    check_shards(rows, texts)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert sorted(sizes.values())[-1] == 100_016 and sorted(sizes.values())[-2] <= 1500


def test_capacities_that_are_too_small():
    with pytest.raises(ValueError, match="capacities"):
        sharding.fewest_bytes({0: 3}, [1, 1])


def test_files_without_moved_documents_are_left_alone(spark, settings):
    settings("spark.sql.shuffle.partitions", 64)
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 20).alias("text"))
    old, new = scratch_path(spark, "shards"), scratch_path(spark, "resharded")
    sharding.write_shards(docs, old, 4)
    schema = sharding.layout_schema(docs)
    sharding.reshard(spark, old, new, schema, 5)
    files = spark.read.parquet(f"{new}/files").groupBy("affected").count().collect()
    count = {r["affected"]: r["count"] for r in files}
    assert count[False] >= 2 * count[True] > 0
    written = spark.read.parquet(f"{new}/rows").count()
    assert written < 0.5 * docs.count()
    assert sharding.read_shards(spark, old, new, schema).count() == docs.count()


def test_block_sizes_do_not_change_the_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BYTES", 500)
    texts = [(n, "ab " * (n % 40)) for n in range(3000)]
    rows = sharding.reshard_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    check_shards(rows, texts, slack=300)


def test_clashing_columns_empty_table_and_one_row(spark):
    layout = "doc_id long, text string, shard int, slot int, size int, __at int, `a.b` int"
    empty = spark.createDataFrame([], layout)
    assert sharding.reshard_documents(empty).collect() == []
    one = spark.createDataFrame([(1, "one", 1, 2, 3, 4, 5)], layout)
    (row,) = sharding.reshard_documents(one).collect()
    assert (row["doc_id"], row["size"], row["slot"]) == (1, 19, 0)
