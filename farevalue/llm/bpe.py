"""Byte-level BPE with the tiktoken library and a local rank file.

Every text is encoded whole. A long text is first cut at places where the
splitting pattern always ends a match, so that the library gets pieces of bounded
size; the ids are those of the uncut text. A very long run of white space is one match
of the pattern, at which the library's own matching fails, so its bytes are merged as
the one piece that they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from farevalue.llm.common import select_text, slices

# Characters after which the next safe boundary of a long text is looked for.
PIECE_CHARS = 50_000

# White space that follows another character: no alternative of a pattern whose
# matches are "optional space, then one class" or "white space only" crosses it.
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n\t])")

# What the pattern takes for white space; Python's own class differs.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Runs of white space from this length on are encoded without the pattern.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


@lru_cache(maxsize=4)
def load_encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, read once in each Python worker."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split_text(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe boundaries at least ``size`` characters apart."""
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def space_matches(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the pattern's match in every long run of white space.

    Before another character the pattern leaves the last one of the run to the next match.
    """
    for run in _LONG_SPACE.finditer(text):
        yield run.start(), run.end() - (run.end() < len(text))


def encode_text(encoding: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> list[int]:
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for start, end in space_matches(text):
        ids += encode_pieces(encoding, text[at:start], size)
        ids += encoding._encode_single_piece(text[start:end].encode())
        at = end
    return ids + encode_pieces(encoding, text[at:], size)


def encode_pieces(encoding: tiktoken.Encoding, text: str, size: int) -> list[int]:
    return [i for piece in split_text(text, size) for i in encoding.encode_ordinary(piece)]


def encode(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Return ``doc_id`` and ``ids``, one row per input row, in one pass without a shuffle.

    A null or empty text has no ids. Strings that look like special tokens are
    ordinary text. Repeated rows are encoded each, null ids stay null, and other
    columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file, pattern)
        for batch in slices(batches, "text"):
            ids = [encode_text(encoding, t or "") for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return select_text(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Add ``bytes``, the raw bytes of ``ids``, to the table that ``encode`` returns.

    Ids need not end at a character: nothing is decoded to text. Null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file, pattern)
        for batch in slices(batches, "ids", width=4):
            raw = [
                None if ids is None else encoding.decode_bytes(ids)
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())],
                names=["doc_id", "ids", "bytes"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, bytes binary"
    )
