"""Licence scans by diagonal voting.

Every rolling k-gram of words of every document is hashed and joined to the positions
of the templates' k-grams. Matches of one template line up on a diagonal, the
difference of the two positions; votes are counted by diagonal, neighbouring
diagonals (inserted or missing words) are merged as far as their votes carry, and the
merged span is verified against the words of the document, in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farevalue.llm.common import lower_ascii, select_text, slices, stored, with_sieve
from farevalue.llm.license_templates import NOTICES, PHRASES

# Words: letters, digits and everything outside ASCII, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_RE = re.compile(WORD)
K = 3
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Diagonals are one match with words inserted or left out if they are apart by so many words
# at most, and one more for every vote that both have, up to a share of the template.
NEIGHBOUR = 3
INSERTED_SHARE = 3
# A diagonal with less than one vote to so many of the strongest one is chance.
CHANCE = 8
# A span is verified if it is like the template to at least this degree.
LEAST_LIKENESS = 0.8

Template = tuple[str, bool, list[str]]  # label, must it stand verbatim, words


def default_notices() -> list[tuple[str, str, bool]]:
    """``(label, text, must it stand verbatim)`` of the phrases and notices."""
    phrases = [(label, text, True) for text, label in PHRASES]
    return phrases + [(label, text, False) for label, text in NOTICES]


def words_of(text: str) -> list[str]:
    return WORD_RE.findall(text.encode().lower().decode())


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode())
        return value


def grams(words: list[str], hashes: WordHashes, k: int = K) -> np.ndarray:
    """Hashes of all k-grams of ``words``, in order; none if there are fewer words."""
    if len(words) < k:
        return np.empty(0, dtype=np.int64)
    single = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    rolled = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for j in range(k):
        rolled = rolled * MULTIPLIER + single[j : len(words) - k + 1 + j]
    return rolled.view(np.int64)


def rolling_grams(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, key, grams`` of every row: the hashes of all its k-grams, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes = WordHashes()
            found = [grams(words_of(t or ""), hashes, k) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            values = pa.array(np.concatenate(found))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.ListArray.from_arrays(pa.array(ends), values),
                ],
                names=["doc_id", "key", "grams"],
            )

    return docs.mapInArrow(run, "doc_id long, key long, grams array<long>")


def template_table(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``template, exact, grams`` of the templates, which need at least K words each."""
    hashes = WordHashes()
    rows = []
    for n, (_, exact, words) in enumerate(templates):
        if len(words) < K:
            raise ValueError(f"a template has fewer than {K} words")
        rows.append((n, exact, grams(words, hashes).tolist()))
    return spark.createDataFrame(rows, "template int, exact boolean, grams array<long>")


def vote(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Votes ``doc_id, key, template, exact, size, diagonal, votes, first, last`` of all documents.

    The templates are a fixed list, so their positions are broadcast; the documents
    are not shuffled before their matches are counted in each task. A place of a
    repeated row votes once.
    """
    positions = F.broadcast(
        templates.select(
            "template", "exact", F.size("grams").alias("size"), F.posexplode("grams").alias("t_at", "gram")
        )
    )
    rolling = rolling_grams(docs).select("doc_id", "key", F.posexplode("grams").alias("at", "gram"))
    diagonal = (F.col("at") - F.col("t_at")).alias("diagonal")
    return (
        rolling.join(positions, "gram")
        .groupBy("doc_id", "key", "template", "exact", "size", diagonal)
        .agg(
            F.size(F.collect_set("at")).alias("votes"),
            F.min("at").alias("first"),
            (F.max("at") + K).alias("last"),
        )
    )


def merge_diagonals(votes: DataFrame) -> DataFrame:
    """Spans ``doc_id, key, template, first, last`` of merged neighbouring diagonals.

    Diagonals of chance are left out. The others are taken in the order of the document:
    the next one belongs to the same span if it goes on in the template and is no farther
    than the votes of both allow. Phrases are not merged: each diagonal is one place.
    """
    text = Window.partitionBy("doc_id", "key", "template")
    order = text.orderBy("first", "diagonal")
    place = F.col("first") - F.col("diagonal")
    step = F.abs(F.col("diagonal") - F.lag("diagonal").over(order))
    reach = NEIGHBOUR + F.least(
        "votes", F.lag("votes").over(order), F.floor(F.col("size") / INSERTED_SHARE).cast("int")
    )
    follows = ~F.col("exact") & (step <= reach) & (place >= F.lag(place).over(order))
    return (
        votes.withColumn("most", F.max("votes").over(text))
        .filter(F.col("exact") | (F.col("votes") * CHANCE >= F.col("most")))
        .withColumn("starts", F.when(follows, 0).otherwise(1))
        .withColumn("cluster", F.sum("starts").over(order))
        .groupBy("doc_id", "key", "template", "cluster")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("cluster")
    )


def common_in_order(found: list[str], template: list[str]) -> int:
    """Length of the longest common subsequence, kept as bits of one number."""
    places: dict[str, int] = {}
    for n, word in enumerate(template):
        places[word] = places.get(word, 0) | 1 << n
    full = (1 << len(template)) - 1
    free = full
    for word in found:
        here = free & places.get(word, 0)
        free = ((free + here) | (free - here)) & full
    return len(template) - free.bit_count()


def likeness(found: list[str], template: list[str]) -> float:
    """Share of the words of both that stand in both in one order."""
    return 2 * common_in_order(found, template) / (len(found) + len(template))


def verify(docs: DataFrame, spans: DataFrame, templates: list[Template]) -> DataFrame:
    """``doc_id, key, label, exact, at, score`` of spans that hold up against the words.

    A phrase must stand word for word; for a notice the score is its ``likeness``.
    Only documents with spans are tokenised again. Equal rows have the findings of one.
    """
    listed = spans.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("template", "first", "last")).alias("spans")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc, key, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text or "")
                for span in found:
                    label, exact, wanted = templates[span["template"]]
                    seen = words[span["first"] : span["last"]]
                    score = float(seen == wanted) if exact else likeness(seen, wanted)
                    if score >= (1.0 if exact else LEAST_LIKENESS):
                        rows.append((doc, key, label, exact, span["first"], score))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.float64())
            yield pa.record_batch(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "key", "label", "exact", "at", "score"],
            )

    # Texts without spans are left out before the join, which may shuffle.
    sieved, found_in = with_sieve(docs, "doc_id", spans.select("doc_id"))
    return (
        sieved.filter(F.col(found_in))
        .join(listed, ["doc_id", "key"])
        .select("doc_id", "key", "text", "spans")
        .mapInArrow(run, "doc_id long, key long, label string, exact boolean, at int, score double")
        .distinct()
    )


def scan(
    docs: DataFrame,
    notices: list[tuple[str, str, bool]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(documents, findings)``: ``doc_id, key, n_words`` of each row, and what ``verify`` returns.

    ``key`` is a hash of the text, which tells rows of one id apart: their findings are
    those of the row's own text, and equal rows share the findings of one. A null or empty
    text has no words. Rows without an id have no findings. Other columns are ignored.
    """
    rows = select_text(docs, id_column, text_column).withColumn("key", F.xxhash64("text"))
    templates = [
        (label, exact, words_of(text)) for label, text, exact in notices or default_notices()
    ]
    counted = rows.select(
        "doc_id",
        "key",
        F.regexp_count(
            lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORD)
        ).cast("long").alias("n_words"),
    )
    spans = stored(
        merge_diagonals(vote(rows, template_table(docs.sparkSession, templates))), "licence-spans"
    )
    return counted, verify(rows, spans, templates)
