"""Resharding of a stored corpus that moves the fewest bytes.

The old shards have sizes, the new ones capacities. A minimum-cost flow between them, in
which a byte that stays costs nothing, says how many bytes go from each old shard to each
new one. Every old shard is an ordered run of blocks of documents; a transfer is a stretch
of that run, so whole blocks move and a handful are cut between two documents. Documents
that are large beside a capacity are placed one by one before. Only files that hold a
moved document are written anew.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from farevalue.contracts import literal_rows
from farevalue.llm.common import stored
from farevalue.session import scratch_path

SHARDS = 40
OLD_SHARDS = 32
ROW_BYTES = 16  # what a document counts beside its text

# Bytes of text in a block; a document over a capacity divided by ``LARGE`` is large.
BLOCK_BYTES = 8_000_000
LARGE = 1000

# Columns that a layout adds; ``__at`` numbers the rows of a layout.
LAYOUT = ("__size", "__spot", "__at", "__home")
_SPOT_BITS = 31


@dataclass(frozen=True)
class Transfer:
    """``moved`` bytes that go from an old shard to a new one; both may be the same."""

    old: int
    new: int
    moved: int


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def write_shards(
    docs: DataFrame, folder: str, shards: int = OLD_SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write ``docs`` below ``folder``, one folder per shard, by a hash of the id.

    A row without an id goes by its text. Inside a shard rows are sorted by another part of
    the hash, and a shard is cut over several files by ranges of it, which keeps a hot
    shard from being one task. The table must not have a column ``shard``, or one of
    ``LAYOUT``; see ``with_free_names``.
    """
    text = F.col(f"`{text_column}`").cast("string")
    own = F.coalesce(F.xxhash64(F.col(f"`{id_column}`")), F.lit(0))
    key = F.when(F.col(f"`{id_column}`").isNull(), F.xxhash64(text)).otherwise(own)
    marked = docs.withColumns(
        {
            "shard": F.pmod(key, F.lit(shards)).cast("int"),
            "__spot": F.shiftrightunsigned(F.xxhash64(key), 64 - _SPOT_BITS),
            "__size": text_bytes(text),
        }
    )
    dealt = marked.repartitionByRange("shard", "__spot").sortWithinPartitions("shard", "__spot")
    numbered = dealt.withColumns({"__at": F.monotonically_increasing_id(), "__home": F.col("shard")})
    numbered.write.partitionBy("shard").parquet(folder)


def with_free_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns under neutral names, and the names they had."""
    names = {f"c{n}": name for n, name in enumerate(docs.columns)}
    return docs.toDF(*names), names


def layout_schema(docs: DataFrame) -> StructType:
    """The schema of the files that ``write_shards`` makes of ``docs``, with the shard last."""
    own = StructType.fromDDL("__spot long, __size long, __at long, __home int")
    return StructType([*docs.schema, *own, StructField("shard", IntegerType())])


def near_equal(total: int, loads: list[int]) -> list[int]:
    """What every shard takes of ``total`` more bytes beside its load, so that all sizes differ by
    one byte at most; a load beyond the common size takes none."""
    low, high = 0, total + max(loads)
    while low < high:
        level = (low + high + 1) // 2
        fits = sum(max(0, level - load) for load in loads) <= total
        low, high = (level, high) if fits else (low, level - 1)
    takes = [max(0, low - load) for load in loads]
    for n in sorted(range(len(loads)), key=lambda n: (loads[n] > low, n))[: total - sum(takes)]:
        takes[n] += 1
    return takes


def fair_capacity(total: int, large: list[int], shards: int) -> int:
    """The mean size of the shards that no single document of ``large`` overfills."""
    for size in sorted(large, reverse=True):
        if shards == 1 or size * shards <= total:
            break
        total, shards = total - size, shards - 1
    return total // shards


def place_large(large: list[tuple[int, int, int]], capacity: int, shards: int) -> tuple[dict[int, int], list[int]]:
    """New shards of those (shard, at, size) that have to move, by ``at``, and the load of every
    new shard. A document stays where its shard still has room; the others go, the largest
    first, to the shard with the most room."""
    loads, moved, waiting = [0] * shards, {}, []
    for shard, at, size in sorted(large, key=lambda row: (-row[2], row[1])):
        if shard < shards and loads[shard] + size <= capacity:
            loads[shard] += size
        else:
            waiting.append((at, size))
    for at, size in waiting:
        moved[at] = loads.index(min(loads))
        loads[moved[at]] += size
    return moved, loads


def fewest_bytes(sizes: dict[int, int], capacities: list[int]) -> list[Transfer]:
    """Transfers of least cost that empty every old shard into the capacities.

    Minimum-cost flow by successive cheapest augmenting paths. A byte costs 1 unless old and
    new shard have the same number. The graph has one node per shard, so it is small
    whatever the corpus holds. The capacities must hold all sizes.
    """
    if sum(sizes.values()) > sum(capacities):
        raise ValueError("The capacities do not hold all documents.")
    source, sink = ("source", 0), ("sink", 0)
    left: dict[tuple, dict[tuple, int]] = defaultdict(dict)  # what an edge can still carry
    price: dict[tuple[tuple, tuple], int] = {}

    def edge(a: tuple, b: tuple, room: int, cost: int) -> None:
        left[a][b], left[b][a] = room, 0
        price[a, b], price[b, a] = cost, -cost

    for old, size in sizes.items():
        edge(source, ("old", old), size, 0)
        for new in range(len(capacities)):
            edge(("old", old), ("new", new), size, int(old != new))
    for new, capacity in enumerate(capacities):
        edge(("new", new), sink, capacity, 0)

    while (path := _cheapest_path(left, price, source, sink)) is not None:
        amount = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= amount
            left[b][a] += amount
    moved = (
        Transfer(old, new, left["new", new]["old", old])
        for old in sizes
        for new in range(len(capacities))
    )
    return [t for t in moved if t.moved]


def _cheapest_path(left, price, source, sink) -> list[tuple] | None:
    """Edges of the cheapest path with room from ``source`` to ``sink``."""
    cost, before = {source: 0}, {}
    waiting = [source]
    while waiting:
        a = waiting.pop(0)
        for b, room in left[a].items():
            if room and cost[a] + price[a, b] < cost.get(b, float("inf")):
                cost[b], before[b] = cost[a] + price[a, b], a
                if b not in waiting:
                    waiting.append(b)
    if sink not in cost:
        return None
    path = [(before[sink], sink)]
    while path[-1][0] != source:
        path.append((before[path[-1][0]], path[-1][0]))
    return path


def block_of(blocks: int, large: int) -> Column:
    """The block of a row of a layout: 0 for large documents, for the others by their spot."""
    by_spot = F.shiftright(F.col("__spot") * blocks, _SPOT_BITS).cast("long") + 1
    return F.when(F.col("__size") > large, F.lit(0).cast("long")).otherwise(by_spot)


def plan_cuts(rows: DataFrame, transfers: list[Transfer], block: Column) -> DataFrame:
    """``shard, cuts``: per old shard the places where its run of ``rows`` is cut, each an
    array of ``block, at, new``: rows from there on go to ``new``.

    Blocks are summed first. Documents are looked at only in blocks that hold a cut, of
    which there are fewer than two per shard. A document goes where its middle lies.
    """
    spark = rows.sparkSession
    narrow = rows.select("shard", block.alias("block"), "__size", "__at")
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.groupBy("shard", "block").agg(F.sum("__size").alias("bytes")).withColumn(
        "start", F.coalesce(F.sum("bytes").over(order), F.lit(0))
    )
    wanted, begin = [], defaultdict(int)
    for t in sorted(transfers, key=lambda t: (t.old, t.old != t.new, t.new)):
        wanted.append((t.old, begin[t.old], t.new))
        begin[t.old] += t.moved
    layout = StructType.fromDDL("shard int, cut long, new int")
    cuts = F.broadcast(literal_rows(spark, layout, wanted))
    inside = (F.col("cut") >= F.col("start")) & (F.col("cut") < F.col("start") + F.col("bytes"))
    blocks = stored(starts.join(cuts, "shard").where(inside).drop("bytes"), "cut-blocks")
    before = Window.partitionBy("shard", "block", "new").orderBy("__at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per cut: its block is bounded, and cuts of one block each see their own copy.
    looked = narrow.join(F.broadcast(blocks), ["shard", "block"])
    middle = F.col("start") + F.coalesce(F.sum("__size").over(before), F.lit(0)) + F.col("__size") / 2
    first = (
        looked.withColumn("middle", middle)
        .groupBy("shard", "new", "block", "cut")
        .agg(F.min(F.when(F.col("middle") >= F.col("cut"), F.col("__at"))).alias("at"))
    )
    # Without such a document the stretch begins with the next block.
    place = F.struct(
        F.when(F.col("at").isNull(), F.col("block") + 1).otherwise(F.col("block")).alias("block"),
        F.coalesce("at", F.lit(0)).alias("at"),
        F.col("cut").alias("cut"),
        F.col("new").alias("new"),
    )
    return first.groupBy("shard").agg(F.array_sort(F.collect_list(place)).alias("cuts"))


@dataclass(frozen=True)
class Plan:
    """Where documents go: the cuts of every old shard, the new shards of large documents that
    move, by their number, and the block of a row."""

    cuts: DataFrame
    moved: DataFrame
    block: Column


def assigned(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` with ``__target``, the new shard.

    Both tables are broadcast: the cuts are a few numbers per shard, and there are at most
    ``LARGE`` large documents per shard.
    """
    passed = F.filter(
        "cuts",
        lambda c: (c["block"] < F.col("__block"))
        | ((c["block"] == F.col("__block")) & (c["at"] <= F.col("__at"))),
    )
    joined = (
        rows.withColumn("__block", plan.block)
        .join(F.broadcast(plan.cuts), "shard", "left")
        .join(F.broadcast(plan.moved), "__at", "left")
    )
    # The first stretch begins with the shard, whatever its cut found.
    last = F.coalesce(F.try_element_at(passed, F.lit(-1)), F.get("cuts", F.lit(0)))
    target = F.when(F.col("__block") > 0, last["new"]).otherwise(F.coalesce("__to", "shard"))
    return joined.withColumn("__target", target).select(*rows.columns, "__target")


def make_plan(old: DataFrame, shards: int) -> Plan:
    """Plan from the sizes of the old shards and of the large documents; reads no texts."""
    sizes = dict(old.groupBy("shard").agg(F.sum("__size")).collect())
    total = sum(sizes.values())
    large = max(1, total // (shards * LARGE))
    blocks = max(1, -(-total // (BLOCK_BYTES * max(1, len(sizes)))))
    block = block_of(blocks, large)
    found = old.where(F.col("__size") > large).select("shard", "__at", "__size").collect()
    capacity = fair_capacity(total, [r["__size"] for r in found], shards)
    places, loads = place_large([tuple(r) for r in found], capacity, shards)
    for shard, _, size in found:
        sizes[shard] -= size
    transfers = fewest_bytes(sizes, near_equal(sum(sizes.values()), loads))
    cuts = stored(plan_cuts(old.where(F.col("__size") <= large), transfers, block), "cuts")
    moved = old.sparkSession.createDataFrame(list(places.items()), "__at long, __to int")
    return Plan(cuts, moved, block)


def reshard(
    spark: SparkSession, old_folder: str, new_folder: str, schema: StructType, shards: int = SHARDS
) -> Plan:
    """Move the documents of a layout of ``write_shards`` into ``shards`` shards of near-equal bytes.

    Writes the affected files anew below ``new_folder/rows``, and the names of all files, with
    whether each is affected, to ``new_folder/files``; ``read_shards`` reads the whole. The
    driver sees one number per shard, at most ``LARGE`` large documents per shard, and the
    names of files, which it lists anyway. Sizes differ by the halves of documents at the
    cuts, each of at most a thousandth of a capacity. Only large documents that together
    outgrow a capacity, which are never cut, can make a shard larger.
    """
    old = spark.read.schema(schema).parquet(old_folder)
    plan = make_plan(old, shards)
    files = old.select("shard", "__size", "__spot", "__at", F.col("_metadata.file_path").alias("file"))
    moves = F.max(F.col("__target") != F.col("shard")).alias("affected")
    assigned(files, plan).groupBy("file").agg(moves).write.parquet(f"{new_folder}/files")
    names = _files(spark, new_folder, affected=True)
    if names:
        opened = spark.read.schema(schema).option("basePath", old_folder).parquet(*names)
        written = assigned(opened, plan).withColumn("shard", F.col("__target")).drop("__target")
        written.hint("rebalance", "shard").write.partitionBy("shard").parquet(f"{new_folder}/rows")
    return plan


def _files(spark: SparkSession, new_folder: str, affected: bool) -> list[str]:
    found = spark.read.schema("file string, affected boolean").parquet(f"{new_folder}/files")
    return sorted(unquote(row["file"]) for row in found.where(F.col("affected") == affected).collect())


def read_shards(spark: SparkSession, old_folder: str, new_folder: str, schema: StructType) -> DataFrame:
    """All rows after ``reshard``: the files left alone, and those written anew."""
    parts = []
    if kept := _files(spark, new_folder, affected=False):
        parts.append(spark.read.schema(schema).option("basePath", old_folder).parquet(*kept))
    if _files(spark, new_folder, affected=True):
        parts.append(spark.read.schema(schema).parquet(f"{new_folder}/rows"))
    if not parts:
        return spark.read.schema(schema).parquet(old_folder)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_slots(rows: DataFrame, block: Column) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in every shard.

    A shard may hold a large part of all rows, so it is numbered block by block: rows
    inside a block, plus the rows of the blocks before, which are counted first.
    """
    part = ["shard", "__home", "__block"]
    marked = rows.withColumn("__block", block)
    before = Window.partitionBy("shard").orderBy("__home", "__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = marked.groupBy(*part).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counted.select(*part, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*part).orderBy("__at")) - 1
    numbered = marked.withColumn("__inside", inside).join(offsets, part)
    return numbered.withColumn("slot", F.col("__before") + F.col("__inside")).drop(
        "__block", "__inside", "__before"
    )


def reshard_documents(
    docs: DataFrame,
    old_shards: int = OLD_SHARDS,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Lay out ``docs`` in ``old_shards`` shards by id, reshard them into ``shards``, and read the
    result: ``doc_id, size, text_crc32, shard, slot, old_shard``.

    Text that is null counts as empty. Rows without an id are dealt by their text; repeated rows
    are rows of their own. Further columns are stored with the documents, whatever their
    names, and not returned. An empty table has no rows in any shard.
    """
    spark = docs.sparkSession
    given, names = with_free_names(docs)
    here = {name: neutral for neutral, name in names.items()}
    doc_id, text = here[id_column], here[text_column]
    old, new = scratch_path(spark, "shards"), scratch_path(spark, "resharded")
    write_shards(given, old, old_shards, doc_id, text)
    schema = layout_schema(given)
    plan = reshard(spark, old, new, schema, shards)
    rows = read_shards(spark, old, new, schema).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.crc32(F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8")).alias("text_crc32"),
        *LAYOUT,
        "shard",
    )
    return with_slots(rows, plan.block).select(
        "doc_id",
        F.col("__size").alias("size"),
        "text_crc32",
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.col("__home").alias("old_shard"),
    )
