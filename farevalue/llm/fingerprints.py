"""Document fingerprints from hashed byte triplets, and a bounded likeness.

A fingerprint counts the text's byte triplets in 128 buckets and keeps, of each
bucket, only the quartile it falls in, with the text's length on a log scale and the
ratios of the quartiles. Small edits move few buckets across a quartile.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import select_text, slices

BUCKETS = 128
MULTIPLIER = np.uint32(0x9E3779B1)
SHIFT = np.uint32(32 - 7)

# A difference in the score: of two buckets by steps between their quartiles, of the
# length and of each ratio by steps; scores end at the bound, where likeness is 0.
STEP_COST = np.array([0, 1, 2, 6], dtype=np.int64)
FREE_LENGTH_STEPS, LENGTH_COST = 1, 4
SCORE_BOUND = 320

LOWEST = -(2**63)


def digest(data: bytes) -> str:
    """The fingerprint of ``data``: length, quartile ratios and bucket quartiles in hex.

    Fewer than three bytes have no triplet and differ by length alone.
    """
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(raw) >= 3:
        triplets = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
        counts = np.bincount((triplets * MULTIPLIER) >> SHIFT, minlength=BUCKETS)
    else:
        counts = np.zeros(BUCKETS, dtype=np.int64)
    ordered = np.sort(counts)
    low, middle, high = ordered[BUCKETS // 4 - 1], ordered[BUCKETS // 2 - 1], ordered[-BUCKETS // 4 - 1]
    codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = min(255, round(math.log1p(len(data)) / math.log(1.1)))
    ratios = (15 * low // max(high, 1)) << 4 | 15 * middle // max(high, 1)
    return bytes([length, int(ratios)]).hex() + packed.astype(np.uint8).tobytes().hex()


def unpack(fingerprint: str) -> tuple[int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)
    codes = np.empty(BUCKETS, dtype=np.int64)
    for place in range(4):
        codes[place::4] = raw[2:] >> (2 * place) & 3
    return int(raw[0]), int(raw[1]), codes


def difference(one: str, other: str) -> int:
    """The difference score of two fingerprints, from 0 to ``SCORE_BOUND``."""
    length, ratios, codes = unpack(one)
    length2, ratios2, codes2 = unpack(other)
    score = int(STEP_COST[np.abs(codes - codes2)].sum())
    score += LENGTH_COST * max(0, abs(length - length2) - FREE_LENGTH_STEPS)
    score += abs((ratios >> 4) - (ratios2 >> 4)) + abs((ratios & 15) - (ratios2 & 15))
    return min(score, SCORE_BOUND)


def likeness(one: str, other: str) -> float:
    """1 for equal fingerprints down to 0 at the bound of the difference."""
    return 1.0 - difference(one, other) / SCORE_BOUND


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row, of the UTF-8 of its whole text.

    A null text is empty; ids may be null or repeat; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [digest((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"]
            )

    return select_text(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def map_with_next(
    docs: DataFrame,
    function: Callable[[int | None, str, str], tuple],
    schema: str,
    arrow_schema: pa.Schema,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Apply ``function(id, text, next text)`` to every row in ascending order of id.

    The row after the last is the first. Null ids come first and null texts are
    empty; rows with the same id go by text. The texts are shuffled once, by ranges of
    the id: the driver learns one smallest id for each range, and the row that has it
    is also sent, as a copy, to the range before.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = select_text(docs, id_column, text_column).select(
        F.coalesce("doc_id", F.lit(LOWEST)).alias("place"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    places = rows.select("place")
    shares = [i / ranges for i in range(1, ranges)]
    cuts = places.stat.approxQuantile("place", shares, 0.2 / ranges) if shares else []
    bounds = sorted({int(c) for c in cuts})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranged = np.searchsorted(bounds, batch.column(0).to_numpy(), side="right")
            yield pa.record_batch(
                [pa.array(ranged, pa.int64()), batch.column(0)], names=["range", "place"]
            )

    first = {
        r["range"]: r["place"]
        for r in places.mapInArrow(number, "range long, place long")
        .groupBy("range")
        .agg(F.min("place").alias("place"))
        .collect()
    }
    present = sorted(first)
    sent_to = {first[r]: present[i - 1] for i, r in enumerate(present)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = [c.to_pylist() for c in batch.columns]
            ranged = [bisect_right(bounds, place) for place in columns[0]]
            copied = [i for i, place in enumerate(columns[0]) if place in sent_to]
            ranged += [sent_to[columns[0][i]] for i in copied]
            columns = [c + [c[i] for i in copied] for c in columns]
            copies = [False] * batch.num_rows + [True] * len(copied)
            yield pa.record_batch(
                [
                    pa.array(ranged, pa.int64()),
                    pa.array(copies),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                ],
                names=["range", "copy", "place", "doc_id", "text"],
            )

    dealt = (
        rows.mapInArrow(deal, "range long, copy boolean, place long, doc_id long, text string")
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "copy", "place", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in slices(batches, "text"):
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting is not None:
                    found.append(function(waiting[1], waiting[2], row[2]))
                waiting = None if row[0] else row
            columns = list(zip(*found, strict=True)) or [()] * len(arrow_schema)
            yield pa.record_batch(
                [pa.array(list(c), f.type) for c, f in zip(columns, arrow_schema, strict=True)],
                schema=arrow_schema,
            )

    return dealt.select("copy", "doc_id", "text").mapInArrow(run, schema)
