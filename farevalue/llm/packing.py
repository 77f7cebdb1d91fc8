"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the plan is made from a histogram
of at most ``capacity`` counts, whatever the number of documents. Pieces above a third
of the capacity are matched greedily, at most two in a sequence; smaller pieces then
go, longest first, to the tightest gap that takes them. One step of the plan serves
all sequences that look alike, and pieces of one length are dealt to the steps by
their rank.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farevalue.llm.common import MEMORIES, select_text, slices, stored, take_over

CAPACITY = 4096
END_ID = 1

# Encoded words that one Python worker remembers; the memory starts anew when full.
MEMORY = 1_500_000

# New words that the tokenizer is asked for at a time; it takes about 1 KB for each meanwhile.
PORTION = 5000

# Pieces of one length that are ranked in one group.
RANK_GROUP = 200_000


class WordIds(dict):
    """Ids of the words seen so far, as little-endian bytes.

    The tokenizer drops white space and never merges across it, nor across the border
    of letters and a full stop or comma, and lower-cases first. So a text's ids are
    those of its words in turn, and a word that ends a clause has the ids of the plain
    word and of the sign. A text that holds a special string of the file, which has an
    id of its own as it stands and in no other case, is encoded by the library as a whole.
    """

    def __init__(self, tokenizer_file: str, size: int = MEMORY):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(a.content) for a in added) or "(?!)")
        self.tokenizer.encode_special_tokens = True  # words have none, whatever their case was
        self.size = size
        self.signs = {sign: self.ask([sign])[0] for sign in (b".", b",")}

    def ask(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(
            [w.decode() for w in words], add_special_tokens=False
        )
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def learn(self, words: list[list[bytes]]) -> None:
        new = set(filterfalse(self.__contains__, chain.from_iterable(words)))
        if len(self) + len(new) > self.size:
            self.clear()
            new = set(chain.from_iterable(words))
        new = iter(new)
        while portion := list(islice(new, PORTION)):
            self.add(portion)

    def add(self, new: list[bytes]) -> None:
        ended, plain = [], set()
        for word in new:
            if word[-1:] in self.signs and word[:-1].isalpha():  # ASCII letters only
                ended.append(word)
                plain.add(word[:-1])
            else:
                plain.add(word)
        unknown = [w for w in plain if w not in self]
        self.update(zip(unknown, self.ask(unknown), strict=True))
        for word in ended:
            self[word] = self[word[:-1]] + self.signs[word[-1:]]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        words = [None if self.special.search(t) else lower_latin(t).split() for t in texts]
        self.learn([w for w in words if w is not None])
        for text, found in zip(texts, words, strict=True):
            yield self.whole(text) if found is None else b"".join(map(self.__getitem__, found))

    def whole(self, text: str) -> bytes:
        """The ids of a text with special strings."""
        self.tokenizer.encode_special_tokens = False
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.tokenizer.encode_special_tokens = True
        return np.array(ids, dtype="<u4").tobytes()


def lower_latin(text: str) -> bytes:
    """UTF-8 of ``text``, with A-Z in lower case if no character could then combine."""
    data = text.encode()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return data
    return data.lower()


@lru_cache(maxsize=2)
def load_word_ids(tokenizer_file: str, memory: int) -> WordIds:
    return WordIds(tokenizer_file, memory)


MEMORIES.append(load_word_ids.cache_clear)


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
    memory: int = MEMORY,
) -> DataFrame:
    """Cut every document's ids, with ``end_id`` behind them, into pieces of ``capacity``.

    Returns ``doc_id, piece, start, length, ids_crc32`` and with ``keep_ids`` the ids
    as bytes. A null or empty text is the end id alone; repeated rows are documents
    of their own. A worker remembers the ids of ``memory`` words, at some 150 bytes each.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("packing")
        words = load_word_ids(tokenizer_file, memory)
        for batch in slices(batches, "text"):
            ids, numbers, starts, lengths, sums, raw = [], [], [], [], [], []
            encoded = words.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc, found in zip(batch.column(0).to_pylist(), encoded, strict=True):
                whole = found + end
                for number, at in enumerate(range(0, len(whole), width)):
                    part = whole[at : at + width]
                    ids.append(doc)
                    numbers.append(number)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if keep_ids:
                        raw.append(part)
            columns = {
                "doc_id": pa.array(ids, pa.int64()),
                "piece": pa.array(numbers, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(raw, pa.binary())
            yield pa.record_batch(columns)

    schema += ", ids binary" if keep_ids else ""
    return select_text(docs, id_column, text_column).mapInArrow(run, schema)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Deal ``counts`` pieces of each length to sequences.

    Returns rows ``(length, first rank, end rank, first sequence, pieces per sequence,
    offset)``: the pieces of a length with ranks from the first to the end go in
    groups of that many to consecutive sequences, starting at that offset.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    plan: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, number)
    sequences = 0

    def place(length: int, first: int, number: int, each: int, offset: int) -> None:
        plan.append((length, used[length], used[length] + number * each, first, each, offset))
        used[length] += number * each
        left[length] -= number * each

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    while large:
        longest = large[0]
        rest = capacity - longest
        mate = next((n for n in large if n <= rest and (n != longest or left[n] > 1)), None)
        if mate is None:
            number = left[longest]
        elif mate == longest:
            number = left[longest] // 2
        else:
            number = min(left[longest], left[mate])
        if mate == longest:
            place(longest, sequences, number, 2, 0)
        else:
            place(longest, sequences, number, 1, 0)
            if mate is not None:
                place(mate, sequences, number, 1, longest)
        gap = rest - (mate or 0)
        if gap:
            gaps[gap].append((sequences, number))
        sequences += number
        large = [n for n in large if left[n]]

    open_gaps = sorted(gaps)
    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = int(np.searchsorted(open_gaps, length))
            if at == len(open_gaps):
                each = min(capacity // length, left[length])
                number = left[length] // each
                place(length, sequences, number, each, 0)
                gap, first = capacity - each * length, sequences
                sequences += number
            else:
                tight = open_gaps[at]
                first, number = gaps[tight].pop()
                each = min(tight // length, left[length])
                fit = min(number, left[length] // each)
                if fit < number:
                    gaps[tight].append((first + fit, number - fit))
                if not gaps[tight]:
                    open_gaps.pop(at)
                place(length, first, fit, each, capacity - tight)
                gap, number = tight - each * length, fit
            if gap:
                if not gaps[gap]:
                    open_gaps.insert(int(np.searchsorted(open_gaps, gap)), gap)
                gaps[gap].append((first, number))
    return plan


STEP_SCHEMA = (
    "step_length long, step_block long, step_first long, step_last long, "
    "step_sequence long, step_each long, step_offset long"
)


def stepped(plan: list[tuple[int, ...]]) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """The plan as tables to join with: ``(length, width of a block of ranks)``, and a step for
    each block that it reaches into.

    A length has as many blocks as steps, so there are at most twice as many rows as in the
    plan, and a piece meets two of them on average, one of which has its rank.
    """
    steps: dict[int, int] = defaultdict(int)
    count: dict[int, int] = defaultdict(int)
    for length, _, end, *_ in plan:
        steps[length] += 1
        count[length] = max(count[length], end)
    widths = {n: -(-count[n] // steps[n]) for n in steps}
    rows = [
        (length, block, first, end - 1, sequence, each, offset)
        for length, first, end, sequence, each, offset in plan
        for block in range(first // widths[length], (end - 1) // widths[length] + 1)
    ]
    return sorted(widths.items()), rows


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with ``doc_id, piece, length``.

    ``pieces`` is read three times: give a stored table. The driver gets one count per
    length. Ranks are taken in groups of bounded expected size, so that a length which
    many pieces share is not one task's work, and the plan is broadcast: its rows are
    bounded by the capacity, not by the number of pieces. Token ids never meet Python again.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = make_plan(counts, capacity)
    groups = max([1, *(-(-c // RANK_GROUP) for c in counts.values())])
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("part")
    offsets = (
        salted.groupBy("length", "part")
        .count()
        .withColumn("base", F.sum("count").over(before) - F.col("count"))
        .drop("count")
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("part", "base", "place")
    )
    spark = pieces.sparkSession
    widths, steps = stepped(plan)
    step = F.broadcast(spark.createDataFrame(steps, STEP_SCHEMA))
    width = F.broadcast(spark.createDataFrame(widths, "length long, step_width long"))
    same = (
        (F.col("length") == F.col("step_length"))
        & (F.expr("rank div step_width") == F.col("step_block"))
        & F.col("rank").between(F.col("step_first"), F.col("step_last"))
    )
    return (
        ranked.join(width, "length")
        .join(step, same)
        .select(
            *pieces.columns,
            F.expr("step_sequence + (rank - step_first) div step_each").alias("sequence_id"),
            F.expr("step_offset + (rank - step_first) % step_each * length").alias("offset"),
        )
    )


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Tokenise, cut and place all documents; one row per piece.

    An empty table gives an empty table. Rows that repeat a document id and piece are
    placed each; which of them comes first is not defined. A null id is an id.
    """
    pieces = stored(tokenize_pieces(docs, tokenizer_file, capacity, **options), "pieces")
    return assign(pieces, capacity)
