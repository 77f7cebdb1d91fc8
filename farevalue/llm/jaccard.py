"""Near-duplicate documents: an n-gram Jaccard join by T-occurrence search.

A document is the set of its word n-grams; two link when their sets overlap enough.

1. Equal sets become one class before anything else.
2. Inverted lists by n-gram hash are made for a class's rarest n-grams only, as many as
   a partner cannot all miss. Rarity is counted over all classes, for the n-grams of a
   fixed share of the hash space; the rest follow in the order of their hash.
3. Members of a list that size and a parity bitmap (an exact upper bound of the
   overlap) do not rule out are grouped, and the groups' connected components gather
   each class's text once.
4. In a group every class searches the others by DivideSkip: short inverted lists are
   heap-merged, long ones probed by binary search for what the merge leaves, and those
   that reach the exact overlap are linked.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import (
    groups,
    roll,
    select_text,
    slices,
    stored,
    take_over,
    with_sieve,
    without_ids,
    words_of,
)
from farevalue.llm.components import Forest, connected_components

# Bits of the parity bitmap. Lists and groups beyond a block are compared in pairs of blocks.
BITMAP_BITS = 512
LIST_BLOCK, GROUP_BLOCK = 8_000, 1_000

# Weight of the list length in DivideSkip's choice of how many lists are long.
MU = 0.005


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of ``text``, A-Z in lower case.

    With fewer words the whole sequence is one; without words there is none.
    """
    words = words_of(text, lower=True)
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(roll(words, min(n, len(words))))


def least_overlap(size: int, percent: int) -> int:
    """The least overlap of a set of ``size`` with any partner."""
    return -(-percent * size // 100)


def needed(one, other, percent: int):
    """The overlap that links sets of two sizes; works on arrays too."""
    return -(-percent * (one + other) // (100 + percent))


def low_bound(percent: int) -> int:
    """Hashes below this have their rarity counted: 1.7 times the share that a prefix takes."""
    return min(2**64 - 1, int(2**64 * 1.7 * (100 - percent) / 100))


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles by the lowest bits of the hash."""
    counts = np.bincount((shingles % np.uint64(BITMAP_BITS)).astype(np.int64), minlength=BITMAP_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def set_key(shingles: np.ndarray) -> bytes | None:
    if not len(shingles):
        return None
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, size, key, low, rest, bits`` of every row; the empty set has no key.

    Equal keys are equal sets. ``low`` are the hashes whose rarity is counted. If a
    prefix may need more, ``rest`` has the lowest of the others.
    """
    bound = np.uint64(low_bound(percent))
    longs = pa.list_(pa.int64())
    kinds = (pa.int64(), pa.binary(), longs, longs, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("jaccard")
        for batch in slices(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, n)
                prefix = len(found) - least_overlap(len(found), percent) + 1
                low = int(np.searchsorted(found, bound))
                row = (
                    len(found), set_key(found), found[:low].view(np.int64),
                    found[low : max(low, prefix)].view(np.int64), bitmap(found),
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                names=["doc_id", "size", "key", "low", "rest", "bits"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, size long, key binary, low array<long>, rest array<long>, bits binary",
    )


def in_blocks(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """``rows`` of keys with several members, dealt to tasks by pairs of blocks.

    A key of at most ``block`` rows is one group. A larger one is cut by the hash of
    ``member``, and a row goes to every pair that has its block.
    """
    counted = rows.groupBy(key).count().filter("count > 1")
    blocks = F.ceil(F.col("count") / block).cast("int").alias("blocks")
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    met = (
        rows.join(counted.select(key, blocks), key)
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left", F.least("own", "with"))
        .withColumn("right", F.greatest("own", "with"))
    )
    order = [key, "left", "right"]
    return met.select(*order, *(c for c in rows.columns if c != key)).repartition(
        *order
    ).sortWithinPartitions(*order, member)


def inverted_rows(classes: DataFrame, percent: int) -> DataFrame:
    """``gram, doc_id, size, bits``: one row per class and n-gram of its prefix.

    N-grams of a single class come first in the order and are left out: no partner has
    them. So only their number is needed, and unlike texts have no rows.
    """
    postings = classes.select(F.explode("low").alias("gram"), "doc_id")
    common = postings.groupBy("gram").count().filter("count > 1")
    shared = (
        postings.join(common, "gram")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("count", "gram"))).alias("shared"))
    )
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    single = F.col("counted") - F.coalesce(F.size("shared"), F.lit(0))
    wanted = F.least(F.greatest(prefix - single, F.lit(0)), F.size("shared")).cast("int")
    rare = F.transform(F.slice("shared", F.lit(1), wanted), lambda s: s["gram"])
    grams = F.concat(F.coalesce(rare, F.array().cast("array<bigint>")), "rest")
    return (
        classes.select("doc_id", "size", F.size("low").alias("counted"), "rest", "bits")
        .join(shared, "doc_id", "left")
        .select(F.explode(grams).alias("gram"), "doc_id", "size", "bits")
    )


def possible_partners(
    at: int, among: np.ndarray, sizes: np.ndarray, bits: np.ndarray, percent: int
) -> np.ndarray:
    """Those of ``among`` that size and bitmap allow to link with row ``at``."""
    other = sizes[among]
    size = sizes[at]
    fits = (100 * np.minimum(other, size) >= percent * np.maximum(other, size)).nonzero()[0]
    among, other = among[fits], other[fits]
    apart = np.bitwise_count(bits[among] ^ bits[at]).sum(axis=1, dtype=np.int64)
    return among[(size + other - apart) // 2 >= needed(size, other, percent)]


def group_members(lists: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join all members of a list which may link, directly or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("jaccard")
        # A worker meets the same small groups in many lists.
        told: set[tuple[int, int]] = set()
        for group in groups(batches, 3):
            ids = group.column("doc_id").to_numpy()
            sizes = group.column("size").to_numpy()
            raw = b"".join(group.column("bits").to_pylist())
            bits = np.frombuffer(raw, dtype=np.uint64).reshape(len(ids), -1)
            rest = np.arange(len(ids))
            links = []
            while len(rest) > 1:
                root, rest = rest[0], rest[1:]
                waiting = [root]
                while waiting and len(rest):
                    found = possible_partners(waiting.pop(), rest, sizes, bits, percent)
                    if len(found):
                        rest = rest[~np.isin(rest, found)]
                        waiting += found.tolist()
                        links += [(int(ids[f]), int(ids[root])) for f in found]
            links = [link for link in links if link not in told]
            if len(told) > 200_000:
                told.clear()
            told.update(links)
            if links:
                yield pa.record_batch(
                    [pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
                )

    return lists.mapInArrow(run, "a long, b long")


class Index:
    """Inverted lists over the sets of some rows, searched by DivideSkip."""

    def __init__(self, sets: list[list[int]], rows: list[int], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets])
        self.alive = set(rows)
        self.build()

    def build(self) -> None:
        self.lists: dict[int, list[int]] = defaultdict(list)
        self.arrays: dict[int, np.ndarray] = {}
        for row in sorted(self.alive):
            for gram in self.sets[row]:
                self.lists[gram].append(row)
        self.built = len(self.alive)

    def take(self, rows: list[int]) -> None:
        """Leave ``rows`` out of later answers."""
        self.alive.difference_update(rows)
        if 2 * len(self.alive) < self.built:
            self.build()

    def probe(self, gram: int, rows: np.ndarray) -> np.ndarray:
        """Which of ``rows`` a list has, by binary search."""
        found = self.arrays.get(gram)
        if found is None:
            found = self.arrays[gram] = np.array(self.lists[gram])
        place = np.minimum(np.searchsorted(found, rows), len(found) - 1)
        return found[place] == rows

    def search(self, at: int) -> list[int]:
        """Rows still in the index whose sets link with the set of row ``at``."""
        own = self.sets[at]
        least = least_overlap(len(own), self.percent)
        lists = sorted((len(x), g) for g in own if (x := self.lists.get(g)))
        if len(lists) < least:
            return []
        longest = lists[-1][0]
        long = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
        short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
        merged = groupby(heapq.merge(*(self.lists[g] for _, g in short)))
        counted = [(row, n) for row, run in merged if (n := sum(1 for _ in run)) + long >= least]
        counted = [(row, n) for row, n in counted if row in self.alive]
        if not counted:
            return []
        rows, counts = np.array(counted).T
        goals = needed(len(own), self.sizes[rows], self.percent)
        for left, (_, gram) in zip(range(long - 1, -1, -1), probed, strict=True):
            counts = counts + self.probe(gram, rows)
            able = counts + left >= goals
            if not able.all():
                rows, counts, goals = rows[able], counts[able], goals[able]
                if not len(rows):
                    break
        return rows[counts >= goals].tolist()


def link_group(sets: list[list[int]], percent: int) -> list[tuple[int, int]]:
    """Pairs of rows that connect all that linked sets connect."""
    index = Index(sets, list(range(len(sets))), percent)
    links = []
    for root in range(len(sets)):
        if root not in index.alive:
            continue
        index.take([root])
        waiting = [root]
        while waiting and index.alive:
            found = index.search(waiting.pop())
            index.take(found)
            waiting += found
            links += [(row, root) for row in found]
    return links


def verified_links(placed: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a, b`` of the classes in each group of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("jaccard")
        for group in groups(batches, 3):
            ids = group.column("doc_id").to_pylist()
            sets = [shingle_set(t.as_py(), n).tolist() for t in group.column("text")]
            links = link_group(sets, percent)
            if links:
                yield pa.record_batch(
                    [pa.array([ids[p[k]] for p in links], pa.int64()) for k in (0, 1)],
                    names=["a", "b"],
                )

    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the threshold is in whole percent.

    A document without words, or without an id, links with nothing and is its own
    component. Repeated rows are equal sets; ids should be unique, as one id is one node.
    Other columns are ignored, and an empty table gives an empty result.
    """
    rows = select_text(docs, id_column, text_column)
    found = stored(signatures(rows, n, percent), "signatures")
    sizes = found.select("doc_id", F.col("size").alias("n_shingles"), "key")
    usable = found.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    first = stored(usable.groupBy("key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = first.select(F.col("node").alias("doc_id"))
    copies = (
        usable.select("doc_id", "key")
        .join(first, "key")
        .filter("doc_id != node")
        .select("doc_id")
        .join(nodes, "doc_id", "left_anti")
    )
    classes = without_ids(usable, "doc_id", stored(copies, "copies"))
    lists = stored(inverted_rows(classes, percent), "lists")
    # Links are stored before they are contracted, so that no task has two Python workers.
    partners = group_members(in_blocks(lists, "gram", "doc_id", LIST_BLOCK), percent)
    partners = stored(partners, "partners")
    gathered = stored(connected_components(partners), "gathered")
    grouped = gathered.withColumnRenamed("node", "doc_id")
    sieved, found_in = with_sieve(rows, "doc_id", grouped.select("doc_id"))
    texts = (
        sieved.filter(F.col(found_in))
        .join(grouped, "doc_id")
        .select(F.col("component_id").alias("group"), "doc_id", "text")
    )
    links = verified_links(in_blocks(texts, "group", "doc_id", GROUP_BLOCK), n, percent)
    parts = connected_components(stored(links, "verified"))
    known = first.join(parts, "node", "left").select(
        "key", F.coalesce("component_id", "node").alias("component")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return sizes.join(known, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce(own, "doc_id").alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component.

    Rows without an id stay, and all rows of an id that stays.
    """
    found = near_duplicates(docs, n, percent, id_column, text_column)
    lost = found.filter("doc_id != component_id").select("doc_id").distinct()
    return without_ids(docs, id_column, stored(lost, "lost"))
