"""Near-duplicate embeddings: sign hashing in several tables, exact cosine, components.

Equal vectors are one class from the start. The bucket numbers of a class in all tables
together are a sketch of its direction. A class is sent to one bucket per table with its
sketch only; in a bucket all pairs of sketches are compared, in blocks. Vectors are then
fetched for the members that may link there, and those are compared by their exact
cosine; only counts of links and one link per vector leave the task. A pair that meets in
several tables counts in the first of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import groups, stored
from farevalue.llm.components import connected_components

LEAST_COSINE = 0.9

# Tables and bits of each. Vectors at the least cosine differ in a bit with probability
# 0.144, so a pair is missed with (1 - 0.856 ** 12) ** 24 = 1.7 %, and one at 0.95 with
# 0.04 %.
TABLES, BITS = 24, 12
SEED = 20_240_607

# Vectors of a bucket that are compared in one task; larger buckets are cut into blocks
# and all pairs of blocks.
BLOCK = 2_000

# Pairs of a group that are looked at in one step.
PAIRS = 200_000

# Sketches may differ in as many bits as vectors at the least cosine do on average, and so
# many standard deviations more: fewer than one such pair in ten million differs in more.
DEVIATIONS = 6


def planes(dimension: int, tables: int, bits: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, dimension])
    return rng.standard_normal((dimension, tables * bits))


def codes_of(unit: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket numbers, rows by tables, of unit vectors."""
    signs = (unit @ planes(unit.shape[1], tables, bits) > 0).reshape(len(unit), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def unit_vectors(vectors: pa.ListArray) -> list[bytes | None]:
    """The unit vectors in double precision, None where there is no direction."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    starts = np.cumsum(lengths) - lengths
    units: list[bytes | None] = [None] * len(lengths)
    for width in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == width)
        values = flat[starts[rows, None] + np.arange(width)]  # nulls are not a number here
        largest = np.abs(values).max(axis=1)
        good = np.isfinite(largest) & (largest > 0)
        values = values[good] / largest[good, None]
        values /= np.sqrt((values * values).sum(axis=1))[:, None]
        for row, value in zip(rows[good].tolist(), values, strict=True):
            units[row] = value.tobytes()
    return units


def hash_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, key`` of every row, and the unit vector; no key if it cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                named = zip(batch.column(0).to_pylist(), unit_vectors(batch.column(1)), strict=True)
                units = [None if i is None else u for i, u in named]
                keys = [
                    None if u is None else hashlib.blake2b(u, digest_size=16).digest() for u in units
                ]
                yield pa.record_batch(
                    [batch.column(0), pa.array(keys, pa.binary()), pa.array(units, pa.binary())],
                    names=["vec_id", "key", "unit"],
                )

    return vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).mapInArrow(run, "vec_id long, key binary, unit binary")


def codes_of_units(units: list[bytes], tables: int, bits: int) -> np.ndarray:
    """``codes_of`` vectors given as bytes, of any dimensions."""
    codes = np.empty((len(units), tables), dtype=np.int32)
    widths = np.array([len(u) for u in units])
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        codes[rows] = codes_of(np.array([np.frombuffer(units[i]) for i in rows]), tables, bits)
    return codes


def sketches_of(codes: np.ndarray, bits: int) -> list[bytes]:
    """The bucket numbers of each row as bytes, filled up to whole words of 8 bytes."""
    small = codes.astype(np.uint16 if bits <= 16 else np.uint32)
    spare = -small.shape[1] % (8 // small.itemsize)
    return [row.tobytes() for row in np.pad(small, ((0, 0), (0, spare)))]


def with_codes(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """``key, vec_id, size, unit`` with ``dimension``, the bucket numbers and their sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                units = batch.column("unit").to_pylist()
                codes = codes_of_units(units, tables, bits)
                ends = np.arange(len(units) + 1, dtype=np.int32) * tables
                yield pa.record_batch(
                    [
                        *batch.columns,
                        pa.array([len(u) // 8 for u in units], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel())),
                        pa.array(sketches_of(codes, bits), pa.binary()),
                    ],
                    names=[*batch.schema.names, "dimension", "codes", "sketch"],
                )

    return classes.select("key", "vec_id", "size", "unit").mapInArrow(
        run,
        "key binary, vec_id long, size long, unit binary, "
        "dimension int, codes array<int>, sketch binary",
    )


def most_apart(bits: int, least: float) -> int:
    """So many of ``bits`` signs may differ between vectors of at least this cosine."""
    share = np.arccos(np.clip(least, -1.0, 1.0)) / np.pi
    return int(np.ceil(bits * share + DEVIATIONS * np.sqrt(bits * share * (1 - share))))


def may_link(group: pa.Table, tables: int, bits: int, least: float) -> np.ndarray:
    """The rows of one pair of blocks that may have links which count here, by their sketches.

    Half of each sketch is looked at first, which tells almost all pairs apart that do not
    link. Memory is bounded by ``PAIRS`` at a time.
    """
    kind = np.dtype(np.uint16 if bits <= 16 else np.uint32)
    codes = np.array([np.frombuffer(s, dtype=kind) for s in group.column("sketch").to_pylist()])
    words = codes.view(np.uint64)
    half = (words.shape[1] + 1) // 2
    half_limit = most_apart(bits * min(tables, half * 8 // kind.itemsize), least)
    limit = most_apart(bits * tables, least)
    lane = group.column("lane")[0].as_py()
    left, right = (group.column(c)[0].as_py() for c in ("left", "right"))
    own = group.column("own").to_numpy()
    rows, others = np.flatnonzero(own == left), np.flatnonzero(own == right)
    found = np.zeros(len(own), dtype=bool)
    step = max(1, PAIRS // max(1, len(others)))
    for start in range(0, len(rows), step):
        some = rows[start : start + step]
        against = others[start:] if left == right else others
        apart = np.zeros((len(some), len(against)), dtype=np.uint16)
        for word in range(half):
            apart += np.bitwise_count(words[some, word][:, None] ^ words[against, word])
        one, other = np.nonzero(apart <= half_limit)
        one, other = some[one], against[other]
        near = one != other
        near &= np.bitwise_count(words[one] ^ words[other]).sum(axis=1) <= limit
        if lane:
            near &= ~(codes[one, :lane] == codes[other, :lane]).any(axis=1)
        found[one[near]] = True
        found[other[near]] = True
    return found


def join(lowest: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Take in links: ``lowest`` names the smallest member of each row's set, in place."""
    while True:
        one, other = lowest[one], lowest[other]
        different = one != other
        if not different.any():
            return
        one, other = one[different], other[different]
        np.minimum.at(lowest, np.maximum(one, other), np.minimum(one, other))
        while (lowest[lowest] != lowest).any():
            lowest[:] = lowest[lowest]


def compare_bucket(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, links, roots)`` of the vectors that have links in one pair of blocks.

    A pair counts here only if no earlier table has it in one bucket too. Rows of equal
    blocks are compared with each other, others with the other block only. Memory is
    bounded by ``PAIRS`` at a time, however many of them are linked.
    """
    lane = group.column("lane")[0].as_py()
    ids = group.column("vec_id").to_numpy()
    sizes = group.column("size").to_numpy()
    own = group.column("own").to_numpy()
    unit = np.array([np.frombuffer(u) for u in group.column("unit").to_pylist()])
    codes = np.array([np.frombuffer(c, dtype=np.int32) for c in group.column("codes").to_pylist()])
    apart = group.column("left")[0].as_py() != group.column("right")[0].as_py()
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    links = np.zeros(len(ids), dtype=np.int64)
    lowest = np.arange(len(ids))  # by rank: the smallest rank known to be reached
    rows = max(1, PAIRS // len(ids))
    for start in range(0, len(ids), rows):
        linked = unit[start : start + rows] @ unit.T >= least
        if apart:
            linked &= own[start : start + rows, None] != own
        one, other = np.nonzero(linked)
        one += start
        new = one != other
        if lane:
            new &= ~(codes[one, :lane] == codes[other, :lane]).any(axis=1)
        one, other = one[new], other[new]
        np.add.at(links, one, sizes[other])
        join(lowest, rank[one], rank[other])
    roots = ids[order[lowest[rank]]]
    has = links > 0
    return ids[has], links[has], roots[has]


PLACE = ["dimension", "lane", "code"]
KEYS = [*PLACE, "left", "right"]


def possible_members(classes: DataFrame, tables: int, bits: int, least: float) -> DataFrame:
    """``KEYS, own, vec_id`` of the members of each pair of blocks that ``may_link`` there."""
    lane = F.posexplode("codes").alias("lane", "code")
    counted = classes.select("dimension", lane).groupBy(PLACE).count().filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    dealt = (
        classes.select("dimension", "vec_id", "sketch", lane)
        .join(counted.withColumn("blocks", blocks).drop("count"), PLACE)
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            *PLACE,
            F.least("own", "with").alias("left"),
            F.greatest("own", "with").alias("right"),
            "own", "vec_id", "sketch",
        )
        .repartition(*KEYS)
        .sortWithinPartitions(*KEYS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, len(KEYS)):
            found = may_link(group, tables, bits, least)
            if found.any():
                chosen = group.filter(pa.array(found)).drop_columns("sketch")
                yield from chosen.combine_chunks().to_batches()

    # Rows of one id that differ have one name here; fetching it brings them all.
    return dealt.mapInArrow(
        run, "dimension int, lane int, code int, left int, right int, own int, vec_id long"
    )


def find_links(
    members: DataFrame, classes: DataFrame, tables: int, bits: int, least: float
) -> DataFrame:
    """``vec_id, links, root`` rows: links found in one bucket, and the smallest id there.

    The vectors of ``members`` are fetched by id, so a class that shares its id with
    another may come to a bucket that is not its own, where it is left out.
    """
    fetched = (
        members.join(classes.select("vec_id", "size", "unit"), "vec_id")
        .select(*KEYS, "own", "vec_id", "size", "unit")
        .repartition(*KEYS)
        .sortWithinPartitions(*KEYS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, len(KEYS)):
            dimension, lane, code = (group.column(c)[0].as_py() for c in PLACE)
            group = group.filter(pc.equal(pc.binary_length(group.column("unit")), 8 * dimension))
            codes = codes_of_units(group.column("unit").to_pylist(), tables, bits)
            group = group.append_column("codes", pa.array([c.tobytes() for c in codes], pa.binary()))
            group = group.filter(pa.array(codes[:, lane] == code))
            found = compare_bucket(group, least)
            if len(found[0]):
                yield pa.record_batch([pa.array(c) for c in found], names=["vec_id", "links", "root"])

    return fetched.mapInArrow(run, "vec_id long, links long, root long")


def deduplicate(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    least: float = LEAST_COSINE,
    tables: int = TABLES,
    bits: int = BITS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    without an id, link with nothing; vectors of other lengths are never compared.
    Equal vectors link, also under one repeated id. Other columns are ignored.
    """
    named = stored(hash_vectors(vectors, id_column, vector_column), "vectors")
    equal = (
        named.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("vec_id"),
            F.count("*").alias("size"),
            F.any_value("unit").alias("unit"),
        )
    )
    classes = stored(with_codes(equal, tables, bits), "classes")
    members = stored(possible_members(classes, tables, bits, least).distinct(), "members")
    found = stored(find_links(members, classes, tables, bits, least), "found")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("vec_id", "root"))
    told = (
        classes.select("key", F.col("vec_id").alias("node"), "size")
        .join(links.withColumnRenamed("vec_id", "node"), "node", "left")
        .join(parts, "node", "left")
    )
    component = F.coalesce("component_id", "node", "vec_id")
    return (
        named.select("vec_id", "key")
        .join(told, "key", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
