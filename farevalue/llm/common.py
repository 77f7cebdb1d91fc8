"""Helpers of the text operators: stored intermediate tables and word patterns."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farevalue.session import scratch_path

# Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

# Word hashes that one Python worker remembers; the memory starts anew when full.
REMEMBERED = 250_000

# Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 1_000_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Later steps then start from files that outlive a lost executor, and a plan
    that uses the table twice computes it once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of ``text`` in UTF-8, with A-Z in lower case if wanted.

    Bytes split at ASCII white space, which is just what ``WORD`` leaves out.
    """
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


class WordHashes(dict):
    """64-bit hashes of words; a worker keeps them from batch to batch."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


WORKER_HASHES = WordHashes()


# Functions that empty the memories which operators keep in a worker, and who used it last.
MEMORIES: list[Callable[[], None]] = [WORKER_HASHES.clear]
_LAST_OPERATOR: list[str] = []


def take_over(operator: str) -> None:
    """Called where an operator's task begins: if another operator used this Python worker last,
    empty what it keeps between tasks, and give freed memory back to the system.

    A worker serves one query after the other, so what an operator leaves in it would count
    beside what the next one needs.
    """
    if _LAST_OPERATOR == [operator]:
        return
    _LAST_OPERATOR[:] = [operator]
    for empty in MEMORIES:
        empty()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library, which returns memory by its own rules
        pass


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def roll(words: list[bytes], n: int) -> np.ndarray:
    """Mixed 64-bit hashes of all n-grams of ``words``, which has n words at least."""
    hashes = WORKER_HASHES
    single = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    rolled = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        rolled = rolled * MULTIPLIER + single[j : len(words) - n + 1 + j]
    rolled ^= rolled >> np.uint64(32)
    rolled *= MIX
    return rolled ^ (rolled >> np.uint64(32))


# 64-bit words of the bitmap of ids that ``with_sieve`` broadcasts: 1 MB whatever the input.
SIEVE_WORDS = 1 << 17


def with_sieve(rows: DataFrame, id_column: str, ids: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` with a column, whose name is given too, that is false if the id is surely
    not in ``ids``, a table of one column.

    What remains for a join with ``ids`` is then mostly what it will keep. More ids make
    the sieve coarser, never larger and never wrong.
    """

    def place(column: Column) -> tuple[Column, Column]:
        number = F.pmod(F.xxhash64(column.cast("long")), F.lit(64 * SIEVE_WORDS))
        return F.floor(number / 64).cast("int"), (number % 64).cast("int")

    one = F.lit(1).cast("long")
    word, bit = place(ids[ids.columns[0]])
    key, bits, found = (fresh_name(rows, n) for n in ("sieve_word", "sieve_bits", "sieved"))
    marks = ids.groupBy(word.alias(key)).agg(F.bit_or(F.call_function("shiftleft", one, bit)).alias(bits))
    word, bit = place(F.col(f"`{id_column}`"))
    has = F.call_function("shiftright", F.col(bits), bit).bitwiseAND(one) == 1
    marked = (
        rows.withColumn(key, word)
        .join(F.broadcast(marks), key, "left")
        .withColumn(found, F.coalesce(has, F.lit(False)))
    )
    return marked.select(*(F.col(f"`{c}`") for c in rows.columns), found), found


def without_ids(rows: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is not in ``ids``, a stored table of one column; null ids stay.

    Only rows that the sieve leaves in doubt are shuffled.
    """
    sieved, doubtful = with_sieve(rows, id_column, ids)
    gone = fresh_name(sieved, "gone")
    named = ids.select(F.col(ids.columns[0]).alias(gone))
    same = F.col(f"`{id_column}`").cast("long") == F.col(gone)
    tried = sieved.filter(F.col(doubtful)).join(named, same, "left_anti")
    kept = sieved.filter(~F.col(doubtful)).union(tried)
    return kept.select(*(F.col(f"`{c}`") for c in rows.columns))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def select_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns that a text operator reads, under names of its own."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )


def slices(
    batches: Iterator[pa.RecordBatch], column: str, width: int = 1, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column``, of text, bytes or lists of values of ``width``
    bytes, has about ``size`` bytes in each part; a longer single row is one part."""
    for batch in batches:
        values = batch.column(column)
        count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        lengths = np.asarray(pc.fill_null(count(values), 0), dtype=np.int64) * width
        ends = np.cumsum(lengths + 1)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The runs of equal values of the first ``keys`` columns, of sorted batches.

    A run may go over several batches; only one run is held beside the current batch.
    Keys must be whole numbers without nulls.
    """
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy() for k in range(keys)]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for v in values:
            changed[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            key = tuple(v[start] for v in values)
            if kept and key != last:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, end - start))
            last = key
    if kept:
        yield pa.Table.from_batches(kept)
