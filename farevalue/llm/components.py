"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import stored


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        parent = self.parent
        root = parent.setdefault(node, node)
        while parent[root] != root:
            root = parent[root]
        while parent[node] != root:
            parent[node], node = root, parent[node]
        return root

    def join(self, one: int, other: int) -> bool:
        """Merge two trees; False if they were one already."""
        one, other = self.find(one), self.find(other)
        if one == other:
            return False
        self.parent[max(one, other)] = min(one, other)
        return True


def contract(edges: DataFrame) -> DataFrame:
    """Replace the links of each partition by one link from each node to its smallest.

    Memory is bounded by the partition: its trees are given out when they are many.
    """
    most = 500_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def links() -> pa.RecordBatch:
            rows = [(n, r) for n in list(forest.parent) if (r := forest.find(n)) != n]
            return pa.record_batch(
                [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                forest.join(a, b)
            if len(forest.parent) > most:
                yield links()
                forest = Forest()
        yield links()

    return edges.mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component_id`` (the smallest node reachable) of every node of ``edges``.

    ``edges`` has two columns of ids; nulls and loops are ignored. Each round stores its
    links and stops when they are stars. A node that a third of all links share is
    reduced to its smallest neighbour before the shuffle and split by the join.
    """
    first, second = (F.col(f"`{c}`").cast("long") for c in edges.columns)
    plain = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    plain = plain.filter(first.isNotNull() & second.isNotNull() & (first != second))
    links = stored(contract(plain), "links")
    seen = None
    while True:
        both = links.union(links.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(nearest, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(lowest.select("a", F.col("m").alias("b")).union(small).distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(roots)
