"""Substring dedup: remove passages that already stand earlier in the corpus.

Suffix automata of reference shards find the passages. A reference grows with the
corpus, so it is not broadcast whole: shards are made by content, every window of
words meets all its possible earlier copies in one shard, and the text that streams
through a shard's automaton is only what may repeat.

1. The rarest-hash n-gram of a window, its anchor, depends on the window alone.
   Windows in a row with one anchor are a run; runs up to the next anchor of a chosen
   hash are a chunk. One aggregation finds the anchors that occur once, whose windows
   cannot repeat, and the first document of every chunk; a chunk seen before is removed
   without looking further, so copies and common passages are gone at this point.
2. The other runs are sent to the shard of their anchor in the order of the corpus.
   There each run streams through the automaton of the runs before it. The matching
   statistics give the maximal spans of at least the window length.
   Runs of very frequent anchors become single windows, whose first places are found in
   two steps by hash, so that no group grows with the copies of a window.
3. The spans return to their documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import WORD_RE, slices, stored, take_over  # noqa: F401 (WORD_RE is used from here)
from farevalue.llm.wordspans import Words, roll_hashes, span_keys

LENGTH = 20

# Words of an anchor's n-gram, and the share of anchors that begin a chunk, as one in so many.
ANCHOR = 6
CHUNK = 8

# Anchors that occur more often have their runs cut into single windows, which are dealt
# by their own content and, as one window may be all there is, by their place as well.
HOT = 20_000
DEALS = 1024

# Positions share a number with the hash in the search for anchors.
POSITION_BITS = 24


class Runs:
    """The runs and chunks of a batch of texts, by the numbers of its words.

    Run ``r`` is of text ``texts[r]`` and has the words ``starts[r]`` to ``stops[r]``, which
    overlap those of the next run; it stands ``at[r]`` words behind the text's first one.
    Chunk ``c`` has the runs ``begins[c]`` to ``begins[c + 1]`` and the two hashes ``keys[c]``.
    """

    def __init__(self, words: Words, length: int):
        hashes = words.hashes()
        windows = len(hashes) - length + 1
        n = min(ANCHOR, length)
        inside = np.empty(0, dtype=np.int64)
        if windows > 0:
            last = np.repeat(words.bounds[1:], np.diff(words.bounds))[:windows]
            inside = np.flatnonzero(np.arange(length, length + windows) <= last)
        if not len(inside):
            self.texts = self.starts = self.stops = self.at = inside
            self.anchors, self.begins = np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
            self.keys = np.empty((0, 2), dtype=np.int64)
            return
        rolled = roll_hashes(hashes, n)
        chosen = leftmost_lowest(rolled, length - n + 1)[inside]
        first = np.flatnonzero(np.diff(chosen, prepend=-1))  # texts never share a chosen place
        self.starts = inside[first]
        self.stops = inside[np.append(first[1:], len(inside)) - 1] + length
        self.anchors = rolled[chosen[first]]
        self.texts = np.searchsorted(words.bounds, self.starts, side="right") - 1
        self.at = self.starts - words.bounds[self.texts]
        other = np.diff(self.texts, prepend=-1) != 0
        begins = np.flatnonzero(other | (self.anchors % np.uint64(CHUNK) == 0))
        self.begins = np.append(begins, len(self.starts))
        self.keys = span_keys(hashes, self.starts[begins], self.stops[self.begins[1:] - 1])

    def old_chunks(self, new: pa.Array) -> np.ndarray:
        """Whether each chunk stands earlier in the corpus; ``new`` lists the first hashes of
        each text's other chunks, which are new at their first place in it."""
        left = set(zip(*flat(new), strict=True))
        old = np.ones(len(self.keys), dtype=bool)
        places = zip(self.texts[self.begins[:-1]].tolist(), self.keys[:, 0].tolist(), strict=True)
        for c, place in enumerate(places):
            if place in left:
                left.remove(place)
                old[c] = False
        return old


def flat(lists: pa.Array) -> tuple[list[int], list[int]]:
    """``(row, value)`` of all values of a column of lists of numbers."""
    return pc.list_parent_indices(lists).to_pylist(), pc.list_flatten(lists).to_pylist()


def leftmost_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values, where its lowest is, by the upper 40 bits.

    Of equal ones the leftmost counts, so the choice depends on the window alone.
    """
    upper = values >> np.uint64(POSITION_BITS)
    if len(values) >> POSITION_BITS:
        inside = np.lib.stride_tricks.sliding_window_view(upper, width)
        return np.arange(len(inside)) + inside.argmin(axis=1)
    places = np.arange(len(values), dtype=np.uint64)
    lowest = upper << np.uint64(POSITION_BITS) | places
    reach = 1
    while 2 * reach <= width:
        lowest = np.minimum(lowest[:-reach], lowest[reach:])
        reach *= 2
    if reach < width:
        lowest = np.minimum(lowest[: len(lowest) - width + reach], lowest[width - reach :])
    return (lowest & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)


def marks(rows: DataFrame, length: int) -> DataFrame:
    """``kind, one, two, doc_id, at``: anchors (kind 0) and chunks (kind 1) of all documents.

    A chunk that a document repeats is given once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("repeats")
        for batch in slices(batches, "text"):
            runs = Runs(Words(batch.column("text")), length)
            docs, given = ids_of(batch)
            kept = given[runs.texts]
            texts = runs.texts[runs.begins[:-1]]
            order = np.lexsort((runs.keys[:, 1], runs.keys[:, 0], texts))
            triples = np.column_stack([texts, runs.keys])[order]
            once = np.ones(len(order), dtype=bool)
            once[1:] = (triples[1:] != triples[:-1]).any(axis=1)
            chunks = triples[once & given[texts[order]]]
            anchors = runs.anchors[kept].view(np.int64)
            none, nulls = np.zeros_like(anchors), np.zeros(len(chunks), dtype=np.int64)
            columns = [
                np.append(none, nulls + 1),
                np.append(anchors, chunks[:, 1]),
                np.append(none, chunks[:, 2]),
                np.append(docs[runs.texts[kept]], docs[chunks[:, 0]]),
                np.append(runs.at[kept], nulls),
            ]
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in columns],
                names=["kind", "one", "two", "doc_id", "at"],
            )

    return rows.select("doc_id", "text").mapInArrow(
        run, "kind long, one long, two long, doc_id long, at long"
    )


def ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch, and which of them are not null."""
    docs = batch.column("doc_id")
    given = docs.is_valid().to_numpy(zero_copy_only=False)
    return pc.fill_null(docs, 0).to_numpy(zero_copy_only=False), given


class Automaton:
    """A suffix automaton of several word sequences.

    States are numbers; ``paths``, ``links`` and ``lengths`` hold their transitions,
    suffix links and longest strings.
    """

    def __init__(self) -> None:
        self.paths: list[dict[str, int]] = [{}]
        self.links = [-1]
        self.lengths = [0]

    def add(self, words: list[str]) -> None:
        """Take in another sequence."""
        paths, links, lengths = self.paths, self.links, self.lengths
        last = 0
        for word in words:
            known = paths[last].get(word)
            if known is not None:
                if lengths[known] == lengths[last] + 1:
                    last = known
                else:
                    last = self.split(last, word, known)
                continue
            new = len(paths)
            paths.append({})
            lengths.append(lengths[last] + 1)
            links.append(0)
            state = last
            while state >= 0 and word not in paths[state]:
                paths[state][word] = new
                state = links[state]
            if state >= 0:
                known = paths[state][word]
                if lengths[known] != lengths[state] + 1:
                    known = self.split(state, word, known)
                links[new] = known
            last = new

    def split(self, state: int, word: str, known: int) -> int:
        """A state for the strings of ``known`` that end one word after ``state``."""
        paths, links, lengths = self.paths, self.links, self.lengths
        copy = len(paths)
        paths.append(dict(paths[known]))
        lengths.append(lengths[state] + 1)
        links.append(links[known])
        links[known] = copy
        while state >= 0 and paths[state].get(word) == known:
            paths[state][word] = copy
            state = links[state]
        return copy

    def statistics(self, words: list[str]) -> list[int]:
        """For each word, the length of the longest known string that ends there."""
        paths, links, lengths = self.paths, self.links, self.lengths
        state = size = 0
        found = []
        for word in words:
            while state and word not in paths[state]:
                state = links[state]
                size = lengths[state]
            state = paths[state].get(word, 0)
            size = size + 1 if state else 0
            found.append(size)
        return found


def covered(statistics: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal spans of words that matches of at least ``length`` cover."""
    spans: list[tuple[int, int]] = []
    for at, size in enumerate(statistics):
        if size >= length:
            if spans and at - length < spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((at + 1 - length, at + 1))
    return spans


def repeated_spans(
    sequences: Iterable[tuple[int, int, str]], length: int
) -> Iterator[tuple[int, int, int]]:
    """``(document, start, end)`` of what stands in an earlier sequence of a shard.

    ``sequences`` are documents, first word numbers and words joined by spaces, in order.
    """
    automaton = Automaton()
    last, waiting = None, None
    for doc, at, text in sequences:
        if last == (doc, at):  # the same place again, of a repeated row
            continue
        words = text.split(" ")
        if last is not None:
            if waiting is not None:  # the last sequence of a shard need not be taken in
                automaton.add(waiting)
            statistics = automaton.statistics(words)
            for start, end in covered(statistics, length):
                yield doc, at + start, at + end
            waiting = None if statistics[-1] == len(words) else words  # known as a whole
        else:
            waiting = words
        last = (doc, at)


def candidate_runs(marked: DataFrame, length: int) -> DataFrame:
    """``anchor, doc_id, at, words`` of runs in chunks that are new and with common anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("repeats")
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            runs = Runs(words, length)
            docs, given = ids_of(batch)
            row, at = (np.array(c, dtype=np.int64) for c in flat(batch.column("single")))
            single = np.isin(runs.texts << 40 | runs.at, row << 40 | at)
            old = np.repeat(runs.old_chunks(batch.column("new")), np.diff(runs.begins))
            wanted = np.flatnonzero(~single & ~old & given[runs.texts])
            places = zip(runs.starts[wanted].tolist(), runs.stops[wanted].tolist(), strict=True)
            yield pa.record_batch(
                [
                    pa.array(runs.anchors[wanted].view(np.int64)),
                    pa.array(docs[runs.texts[wanted]]),
                    pa.array(runs.at[wanted]),
                    pa.array([words.join(*p) for p in places], pa.string()),
                ],
                names=["anchor", "doc_id", "at", "words"],
            )

    return marked.mapInArrow(run, "anchor long, doc_id long, at long, words string")


def cut_hot(runs: DataFrame, hot: DataFrame, length: int) -> DataFrame:
    """Add ``one, two``: 0, and for hot anchors two hashes of each window's words.

    Their runs become single windows, which leave their words behind, so that different
    ones spread over all tasks. No Python here: this runs in the tasks of
    ``candidate_runs``, and a second worker for each would double their memory.
    """
    words = F.split("words", " ")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda k: F.struct(k.alias("behind"), F.array_join(F.slice(words, k + 1, length), " ").alias("words")),
    )
    cut = runs.join(hot, "anchor", "left").select(
        "anchor", "doc_id", "at", "words", F.explode_outer(F.when(F.col("hot"), windows)).alias("window")
    )
    whole = F.col("window").isNull()
    none = F.lit(0).cast("long")
    return cut.select(
        "anchor",
        F.when(whole, none).otherwise(F.xxhash64("window.words")).alias("one"),
        F.when(whole, none).otherwise(F.xxhash64(F.lit(length), "window.words")).alias("two"),
        "doc_id",
        (F.col("at") + F.coalesce("window.behind", F.lit(0))).alias("at"),
        F.when(whole, F.col("words")).alias("words"),
    )


class FirstPlaces:
    """First places of single windows in sorted batches; all that is kept is the last row."""

    def __init__(self) -> None:
        self.last = None

    def split(self, batch: pa.RecordBatch) -> np.ndarray:
        """0 where a window begins, 1 at its later places, 2 at its first place again."""
        columns = [batch.column(c).to_numpy() for c in ("one", "two", "doc_id", "at")]
        if self.last is None:
            same = [np.append(False, c[1:] == c[:-1]) for c in columns]
            first = None
        else:
            same = [np.append(c[0] == v, c[1:] == c[:-1]) for c, v in zip(columns, self.last)]
            first = self.last[4:]
        begins = ~(same[0] & same[1])
        # Row of the batch where the window of each row begins; -1 in an earlier batch.
        origin = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), -1))
        again = np.ones(len(begins), dtype=bool)
        firsts = []
        for column, before in zip(columns[2:], first or (0, 0)):
            firsts.append(np.where(origin < 0, before, column[origin]))
            again &= column == firsts[-1]
        self.last = (*(c[-1] for c in columns), *(f[-1] for f in firsts))
        return np.where(begins, 0, np.where(again, 2, 1))


def dealt(runs: DataFrame) -> DataFrame:
    """``runs`` in shards, sorted; the places of one hot window go to ``DEALS`` of them."""
    place = F.when(F.col("words").isNull(), F.pmod(F.xxhash64("doc_id", "at"), F.lit(DEALS)))
    return (
        runs.withColumn("deal", F.coalesce(place, F.lit(0).cast("long")))
        .repartition("anchor", "one", "two", "deal")
        .drop("deal")
        .sortWithinPartitions("anchor", "one", "two", "doc_id", "at", "words")
    )


def shard_spans(runs: DataFrame, length: int) -> DataFrame:
    """``doc_id, start, end`` of the repeats found in every shard.

    Of the places of a hot window in one task all but the first are repeats; only these
    first ones, at most ``DEALS`` of a window, meet again.
    """
    names = ["doc_id", "start", "end", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("repeats")
        places = FirstPlaces()
        shard: list[tuple[int, int, str]] = []  # runs of the last anchor so far
        last = None

        def of_windows(windows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            state = places.split(windows)
            for kind in (0, 1):
                part = windows.filter(pa.array(state == kind))
                start = part.column("at")
                none = pa.nulls(part.num_rows, pa.int64())
                keys = [none if kind else part.column(c) for c in ("one", "two")]
                yield pa.record_batch([part.column("doc_id"), start, pc.add(start, length), *keys], names=names)

        def of_shards(rest: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
            """What is found in the shards that end in this batch."""
            nonlocal last
            anchors = rest.column("anchor").to_numpy()
            rows = list(zip(*(rest.column(c).to_pylist() for c in ("doc_id", "at", "words")), strict=True))
            begins = np.flatnonzero(np.diff(anchors)) + 1
            for start, end in pairwise([0, *begins.tolist(), len(rows)]):
                if anchors[start] != last:
                    yield from of_shard()
                    last = anchors[start]
                shard.extend(rows[start:end])

        def of_shard() -> Iterator[tuple[int, int, int]]:
            if len(shard) > 1:
                yield from repeated_spans(shard, length)
            shard.clear()

        def told_spans(found: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
            if found:
                none = pa.nulls(len(found), pa.int64())
                columns = (pa.array(list(c), pa.int64()) for c in zip(*found, strict=True))
                yield pa.record_batch([*columns, none, none], names=names)

        for batch in batches:
            single = batch.column("words").is_null()
            windows, rest = batch.filter(single), batch.filter(pc.invert(single))
            if windows.num_rows:
                yield from of_windows(windows)
            if rest.num_rows:
                yield from told_spans(list(of_shards(rest)))
        yield from told_spans(list(of_shard()))

    told = stored(
        dealt(runs).mapInArrow(run, "doc_id long, start long, end long, one long, two long"), "spans"
    )
    place = F.struct("doc_id", "start", "end")
    again = (
        told.filter(F.col("one").isNotNull())
        .groupBy("one", "two")
        .agg(F.min(place).alias("first"), F.collect_list(place).alias("places"))
        .filter(F.size("places") > 1)
        .select("first", F.explode("places").alias("place"))
        .filter("place > first")
    )
    return told.filter(F.col("one").isNull()).select("doc_id", "start", "end").union(again.select("place.*"))


def cut_words(words: Words, text: int, stays: np.ndarray) -> bytes:
    """A text without the words that do not stay, each with the white space behind it."""
    first, end = words.bounds[text : text + 2]
    begins = words.starts[first:end].tolist()
    parts = [words.raw[words.offsets[text] : begins[0]]]
    ends = [*begins[1:], words.offsets[text + 1]]
    parts += [words.raw[a:b] for a, b in compress(zip(begins, ends, strict=True), stays[first:end])]
    return b"".join(parts)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    layout: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row, and the columns of ``carry``.

    A word is removed if it is in a window of ``length`` words that starts earlier too, in a
    document of smaller id or before in the same one. Windows are those of the input.
    ``kept`` are the other words, joined by single spaces, or with ``layout`` the text
    without the removed words and the white space behind each, which leaves a text
    without repeats as it was. A null text has no words.
    Rows without an id are neither changed nor used; rows that share an id never make
    each other's words repeats by standing at the same place. Carried columns may have
    any name but the four.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        F.struct(F.lit(0).alias("_0"), *(F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(carry))).alias("carried"),
    )
    counted = (
        marks(rows, length)
        .groupBy("kind", "one", "two")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("at").alias("at"))
    )
    useful = (F.col("kind") == 1) | (F.col("n") == 1) | (F.col("n") > HOT)
    known = stored(counted.filter(useful).drop("two"), "marks")
    hot = known.filter((F.col("kind") == 0) & (F.col("n") > HOT)).select(
        F.col("one").alias("anchor"), F.lit(True).alias("hot")
    )
    told = (
        known.filter((F.col("kind") == 1) | (F.col("n") == 1))
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.when(F.col("kind") == 0, F.col("at"))).alias("single"),
            F.collect_list(F.when(F.col("kind") == 1, F.col("one"))).alias("new"),
        )
    )
    marked = rows.join(told, "doc_id", "left").select("doc_id", "text", "carried", "single", "new")
    runs = cut_hot(candidate_runs(marked, length), hot, length)
    spans = (
        shard_spans(runs, length)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    joined = marked.join(spans, "doc_id", "left").select(
        "doc_id", "text", "carried", "new", "spans"
    )
    kept = joined.select("doc_id", "text", "new", "spans", "carried")
    schema = kept.drop("text", "new", "spans").schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("repeats")
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            runs = Runs(words, length)
            _, given = ids_of(batch)
            old = np.flatnonzero(runs.old_chunks(batch.column("new")) & given[runs.texts[runs.begins[:-1]]])
            row = pc.list_parent_indices(batch.column("spans")).to_numpy()
            span = pc.list_flatten(batch.column("spans"))
            # One more cover begins at each start and ends at each end.
            covers = np.zeros(len(words.starts) + 1, dtype=np.int64)
            for step, chunks, name in (
                (1, runs.starts[runs.begins[old]], "start"),
                (-1, runs.stops[runs.begins[old + 1] - 1], "end"),
            ):
                np.add.at(covers, chunks, step)
                np.add.at(covers, words.bounds[row] + span.field(name).to_numpy(zero_copy_only=False), step)
            stays = np.cumsum(covers)[:-1] == 0
            gone = np.concatenate([[0], np.cumsum(~stays)])[words.bounds]
            totals, removed = np.diff(words.bounds), np.diff(gone)
            texts = []
            for t, cut in enumerate(removed.tolist()):
                first, end = words.bounds[t : t + 2]
                if layout:
                    texts.append(cut_words(words, t, stays) if cut else batch.column("text")[t].as_py())
                elif cut:
                    texts.append(b" ".join(compress(words.join(first, end).split(b" "), stays[first:end])))
                else:
                    texts.append(words.join(first, end))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("carried"),
                    pa.array(totals, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "carried", "n_words", "n_removed", "kept"],
            )

    result = kept.mapInArrow(run, f"{fields}, n_words long, n_removed long, kept string")
    return result.select(
        "doc_id", "n_words", "n_removed", "kept",
        *(F.col(f"carried.c{n}").alias(c) for n, c in enumerate(carry)),
    )
