"""Importance resampling of documents towards a target distribution.

Every document gets a weight, the mean gain of its hashed n-grams: how much more frequent
a bucket is in the target texts than in the corpus. Weight plus Gumbel noise of its id is
its score, and the highest scores are drawn, which samples without replacement in
proportion to the exponential of the weight. The cutoff is found by bisection on counts,
and only the drawn rows are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from farevalue.llm.common import slices, stored

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7

# Bytes of a text that are cut into words at a time.
CHUNK = 1_000_000

# Bisection steps that one pass over the scores takes: it counts at 15 values between.
STEPS = 4

# What separates words, and A-Z with their lower case. All else stays.
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_TABLE = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())

# Places of a stored row: the number of its task above 33 bits, and its place in the task below.
_PLACE_BITS = 33


@dataclass(frozen=True)
class Gains:
    """The gain of each bucket, in thousandths of a natural logarithm."""

    values: np.ndarray


def feature_hashes(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """Words and CRC-32 hashes of all runs of one and two words, in chunks of the text.

    A run over the border of two chunks is in the second one. The hash of a pair goes on
    from that of its first word, so no pair is put together.
    """
    data = (text or "").encode().translate(_TABLE)
    crc = zlib.crc32
    before = None
    at = 0
    while at < len(data):
        to = len(data) if at + CHUNK >= len(data) else data.find(b" ", at + CHUNK)
        to = len(data) if to < 0 else to
        words = data[at:to].split()
        at = to
        if not words:
            continue
        single = list(map(crc, words))
        firsts = single if before is None else [before, *single]
        seconds = words[1:] if before is None else words
        pairs = [crc(b" " + w, h) for w, h in zip(seconds, firsts, strict=False)]
        before = single[-1]
        yield len(words), np.array(single + pairs, dtype=np.uint32)


def bucket_counts(docs: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    A task sends at most one number per bucket, and the driver gets ``buckets`` rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in slices(batches, "text"):
            for text in part.column("text").to_pylist():
                for _, hashes in feature_hashes(text):
                    total += np.bincount(hashes % np.uint32(buckets), minlength=buckets)
        (used,) = np.nonzero(total)
        yield pa.record_batch({"bucket": used.astype(np.int32), "features": total[used]})

    texts = docs.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    counted = texts.mapInArrow(count, "bucket int, features long").groupBy("bucket").agg(F.sum("features"))
    totals = np.zeros(buckets, dtype=np.int64)
    for bucket, features in counted.collect():
        totals[bucket] = features
    return totals


def fit_gains(corpus: np.ndarray, target: np.ndarray) -> Gains:
    """Gains from the counts of the corpus and of the target, each smoothed by one a bucket."""
    n = len(corpus)
    all_corpus, all_target = float(corpus.sum() + n), float(target.sum() + n)
    ratios = (
        (t + 1.0) * all_corpus / ((s + 1.0) * all_target)
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    )
    return Gains(np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64))


def gumbel(doc_id: int, seed: int) -> int:
    """Gumbel noise of an id, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame,
    gains: Gains,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row, and ``carried``, a struct
    of the columns named in ``carry``, if any.

    Text that is null or has no words has weight 0. A null id has no score. Repeated rows
    are scored each. The gains, one number per bucket, go to the tasks with the function.
    """
    values = gains.values
    carried = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried")] if carry else []
    given = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        *carried,
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids = part.column("doc_id").to_pylist()
            rows = [weigh(text) for text in part.column("text").to_pylist()]
            words, features, weights = (np.array(column, dtype=np.int64) for column in zip(*rows, strict=True))
            scores = [
                None if i is None else int(w) + gumbel(i, seed) for i, w in zip(ids, weights, strict=True)
            ]
            columns = {
                "doc_id": part.column("doc_id"),
                "n_words": pa.array(words),
                "n_features": pa.array(features),
                "weight": pa.array(weights),
                "score": pa.array(scores, type=pa.int64()),
            }
            if carry:
                columns["carried"] = part.column("carried")
            yield pa.record_batch(columns)

    def weigh(text: str | None) -> tuple[int, int, int]:
        words = features = total = 0
        for n, hashes in feature_hashes(text):
            words += n
            features += len(hashes)
            total += int(values[hashes % np.uint32(len(values))].sum())
        return words, features, total // features if features else 0

    layout = StructType.fromDDL("doc_id long, n_words long, n_features long, weight long, score long")
    if carry:
        layout = StructType([*layout, StructField("carried", given.schema["carried"].dataType)])
    return given.mapInArrow(score, layout)


def bisect(rows: DataFrame, column: str, wanted: int) -> int:
    """The smallest value of a whole-number ``column`` below which, itself included, lie at
    least ``wanted`` of ``rows``, a stored table; ``wanted`` is at least 1 and at most its rows.

    A bisection of the interval of values: each pass counts the rows up to 15 values between,
    which is four halvings, so that a hot value costs no more than any other.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = high - low
        tried = sorted({low + width * k // 2**STEPS for k in range(1, 2**STEPS)} | {low})
        counts = rows.agg(*(F.count_if(F.col(column) <= F.lit(v)) for v in tried)).first()
        reached = [v for v, n in zip(tried, counts, strict=True) if n >= wanted]
        missed = [v for v, n in zip(tried, counts, strict=True) if n < wanted]
        high = reached[0] if reached else high
        low = missed[-1] + 1 if missed else low
    return low


def up_to_rank(rows: DataFrame, order: tuple[str, ...], wanted: int) -> Column:
    """A test that is true for the first ``wanted`` rows in ascending ``order`` of whole-number
    columns, the last of which is unique: the cutoff, column by column, ties by the next."""
    tests, equal = [], []
    left = wanted
    for column in order:
        cutoff = bisect(rows, column, left)
        tests.append(reduce(and_, [*equal, F.col(column) < cutoff]))
        left -= rows.where(F.col(column) < cutoff).count()
        equal.append(F.col(column) == cutoff)
        rows = rows.where(F.col(column) == cutoff)
        if rows.count() == left:  # all that tie here are among the first
            break
    return reduce(or_, [*tests, reduce(and_, equal)])


def ranked(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with their ``rank`` from 1 in ascending ``order``, which must tell all apart.

    Rows are dealt to ranges of the order. Each row's number in its range is added to the
    number of rows in the ranges before; one count per range goes to the driver and back, and
    there are no more ranges than shuffle partitions.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", _PLACE_BITS)
    counts = dict(numbered.groupBy(part).count().collect())
    offsets, before = [], 0
    for number in sorted(counts):
        offsets.append((number, before))
        before += counts[number]
    spark = rows.sparkSession
    starts = spark.createDataFrame(offsets, "__part long, __before long")
    inside = F.col("__at").bitwiseAND(F.lit(2**_PLACE_BITS - 1))
    joined = numbered.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return joined.withColumn("rank", F.col("__before") + inside + 1).drop("__at", "__part", "__before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Draw ``percent`` of the documents with ``min_words`` words, towards ``target``'s texts.

    Returns every row's ``doc_id, n_features, weight, score, rank`` and ``carried``, a struct of
    the columns named in ``carry`` (the text, for one), if any. ``rank`` counts the drawn rows from 1
    by descending score, then ascending id; it is null for the others. Rows of one id and one
    score follow in the order in which they were stored, so exactly the wanted number is drawn.

    Null and empty texts have no features, weight 0, and are not drawn. Rows without an id have
    no score, are not drawn and are not among the documents that ``percent`` is taken of, but
    their texts count in the corpus. An empty target, or an empty table, is allowed.
    """
    gains = fit_gains(bucket_counts(docs, text_column, buckets), bucket_counts(target, target_text, buckets))
    scored = score_documents(docs, gains, id_column, text_column, carry, seed)
    place = F.monotonically_increasing_id()
    # Ascending order is wanted below, hence the negative score.
    scores = stored(scored.withColumns({"__lost": -F.col("score"), "__place": place}), "scores")
    order = ("__lost", "doc_id", "__place")
    eligible = scores.where((F.col("n_words") >= min_words) & F.col("score").isNotNull())
    wanted = percent * eligible.count() // 100
    kept = ["doc_id", "n_features", "weight", "score", "rank", *(["carried"] if carry else [])]
    nothing = F.lit(None).cast("long")
    if not wanted:
        return scores.withColumn("rank", nothing).select(*kept)
    among = up_to_rank(eligible.select(*order), order, wanted)
    drawn = (F.col("n_words") >= min_words) & F.col("score").isNotNull() & among
    first = ranked(scores.where(drawn), order)
    rest = scores.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", nothing)
    return first.select(*kept).unionByName(rest.select(*kept))
