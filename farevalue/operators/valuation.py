"""Cash fares joined with award prices: cents per point."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.contracts import GOLD
from farevalue.functions.money import cents_per_point

# What makes a cash row and an award row the same flight.
FLIGHT_KEYS = (
    "flight_id",
    "origin_airport",
    "destination_airport",
    "airline",
    "departure_datetime",
    "arrival_datetime",
)

# Pairs of rows that one piece of a hot id makes, and rows that one task repeats at a time.
PAIRS = 1_000_000
PIECE = 100_000

# Pieces whose pairs one task may make of one id.
FAR = 10

# Ids that a sketch of frequent ids tracks, the groups in which the sketches of tasks are merged
# first, and the share of a tracked place below which an id may be missed (the sketch's a priori
# error, which is 3.5 of 4/3 places, counted twice: once for the count, once for the cut).
TRACKED = 32_768
MERGE_GROUPS = 1000
MISSED = 5.25


def value_fares(
    cash: DataFrame, awards: DataFrame, hot: DataFrame | None = None, warm: DataFrame | None = None
) -> DataFrame:
    """Inner join on the six flight keys, with cents per point.

    A null key matches nothing and is filtered out before the shuffle. Copies of
    a key multiply. Each side is cut to the columns it gives before it is shuffled.
    No hint is set: AQE broadcasts a side that turns out small, and cuts the
    partition of a hot key over several tasks otherwise.

    AQE judges by input size, but copies on both sides grow the output by their
    product. The flights of ``hot``, a stored table from ``find_hot``, are therefore
    merged where rows are equal, cut into pieces before the join, and repeated
    afterwards. ``warm`` has further flights of ``find_hot`` that are no ``far``: they are cut
    into pieces too, but what comes of one is repeated by the task that joined it and not
    shuffled again. The tables change the plan, never the result.
    """
    fares = cash.select(*FLIGHT_KEYS, "cash_price", "currency", "ingestion_timestamp")
    prices = awards.select(*FLIGHT_KEYS, "points_required", "cabin_class", "program", "award_type")
    apart = [(ids, spread) for ids, spread in ((hot, True), (warm, False)) if ids is not None]
    sides = [fares, prices]
    for ids, _ in apart:
        sides = [side.join(ids, "flight_id", "left_anti") for side in sides]
    joined = sides[0].join(sides[1], list(FLIGHT_KEYS))
    for ids, spread in apart:
        joined = joined.unionByName(_join_in_pieces(fares, prices, ids.drop("far"), spread))
    cpp = cents_per_point(F.col("cash_price"), F.col("points_required"))
    return joined.withColumn("cpp_cents_per_point", cpp).select(*GOLD.columns)


def find_hot(cash: DataFrame, awards: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``flight_id, pieces, cut_fares, far``: ids whose copies make more than ``pairs`` pairs.

    Reads one column of each side, counted in each task before the shuffle. The side
    with more copies is the one to cut. ``pieces`` grows with the product. ``far`` are ids
    with more pairs than one task should make (``FAR``).
    """
    fares, prices = (
        side.where(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(F.count(F.lit(1)).cast("decimal(20,0)").alias(name))
        for side, name in ((cash, "fares"), (awards, "prices"))
    )
    product = F.col("fares") * F.col("prices")
    return (
        fares.join(prices, "flight_id")
        .where(product > pairs)
        .select(
            "flight_id",
            F.ceil(product / pairs).cast("bigint").alias("pieces"),
            (F.col("fares") >= F.col("prices")).alias("cut_fares"),
            (product > FAR * PIECE).alias("far"),
        )
    )


def candidates(df: DataFrame, key: str = "flight_id", tracked: int = TRACKED) -> DataFrame:
    """One column of at most ``tracked`` ids: all that hold over ``MISSED / tracked`` of the rows,
    and some that hold less.

    Every task keeps a sketch of its frequent ids. Sketches are merged in groups, then the
    groups' ones, so ids that are not frequent never leave their task and no task merges
    more than the square root of their number.
    """
    group = (F.spark_partition_id() % MERGE_GROUPS).alias("group")
    state = F.expr(f"approx_top_k_accumulate(id, {tracked})").alias("state")
    counted = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), group)
    # One group, as a group: without any row there is nothing to merge, and no state.
    merged = counted.groupBy("group").agg(state).groupBy(F.lit(0).alias("all"))
    merged = merged.agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"))
    found = merged.select(F.expr(f"inline(approx_top_k_estimate(state, {tracked}))"))
    return found.select(F.col("item").alias(key))


def frequent_ids(
    df: DataFrame, least: int, key: str = "flight_id", tracked: int = TRACKED
) -> DataFrame:
    """``key, copies`` of the ids with more than ``least`` rows, counted exactly.

    Complete as long as ``least`` is at least ``MISSED / tracked`` of the rows. Only candidates of
    the sketch are counted, at most ``tracked`` of them, which bounds what is broadcast.
    """
    some = df.select(key).join(F.broadcast(candidates(df, key, tracked)), key, "left_semi")
    return some.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > least)


def find_hot_by_sketch(
    cash: DataFrame, awards: DataFrame, pairs: int = PAIRS, tracked: int = TRACKED
) -> DataFrame:
    """``find_hot`` for tables that are not stored by id, without shuffling all their ids.

    Ids that are frequent on one side are candidates, and only they are counted. An id that both
    sketches may miss has fewer pairs than the product of what they may miss, so the result
    is ``find_hot``'s while that product is at most ``pairs``.
    """
    ids = candidates(cash, tracked=tracked).union(candidates(awards, tracked=tracked)).distinct()
    sides = [side.join(F.broadcast(ids), "flight_id", "left_semi") for side in (cash, awards)]
    return find_hot(*sides, pairs)


def count_joinable(df: DataFrame) -> DataFrame:
    """Rows that can match (``kept``) and rows that a null key excludes (``dropped``)."""
    has_null = reduce(or_, (F.col(key).isNull() for key in FLIGHT_KEYS))
    outcome = F.when(has_null, "dropped").otherwise("kept").alias("outcome")
    return df.groupBy(outcome).agg(F.count(F.lit(1)).alias("records"))


def _join_in_pieces(fares: DataFrame, prices: DataFrame, hot: DataFrame, spread: bool) -> DataFrame:
    """The inner join for the ids of ``hot``.

    Only their rows are merged where equal, mostly before the shuffle, and counted. One side's
    distinct rows are dealt to the pieces of their id by their content, and the other side's
    go to every piece. Result rows that stand for many are cut and spread again with
    ``spread``, and every task repeats its own.
    """
    whole = [
        _merged(fares.join(hot, "flight_id"), "__fares"),
        _merged(prices.join(hot, "flight_id"), "__prices"),
    ]
    dealt = []
    for side, is_cut in zip(whole, (F.col("cut_fares"), ~F.col("cut_fares")), strict=True):
        own = F.pmod(F.xxhash64(*side.columns), F.col("pieces"))
        every = F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)
        piece = F.explode(F.when(is_cut, F.array(own)).otherwise(every))
        dealt.append(side.withColumn("__part", piece).drop("pieces", "cut_fares"))
    if spread:
        # Also tables that are stored by flight: there all pieces of an id would meet in one task.
        dealt = [side.repartition("__part", *FLIGHT_KEYS) for side in dealt]
    joined = dealt[0].join(dealt[1], [*FLIGHT_KEYS, "__part"]).drop("__part")
    cut = joined.withColumn("__copies", F.col("__fares") * F.col("__prices"))
    if spread:
        cut = _cut(_cut(cut, 1000 * PIECE, "__block"), PIECE, "__piece")
        # An explicit number: AQE would merge the pieces again, which are small until repeated.
        tasks = int(fares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cut = cut.repartition(tasks, *cut.columns)
    repeated = cut.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.drop("__fares", "__prices", "__copies", "__block", "__piece", "__copy")


def _cut(df: DataFrame, size: int, number: str) -> DataFrame:
    """Rows that stand for ``__copies`` equal ones as numbered rows for at most ``size``."""
    last = F.expr(f"(__copies - 1) div {size}")
    return df.withColumn(number, F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn(
        "__copies", F.least(F.lit(size), F.col("__copies") - F.col(number) * size)
    )


def _merged(df: DataFrame, count_as: str) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_as))
