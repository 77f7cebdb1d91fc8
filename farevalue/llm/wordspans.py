"""The words of a batch of texts, found and hashed in the batch's bytes at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from farevalue.llm.common import MEMORIES, MIX, MULTIPLIER

SPACES = [0x20, *range(0x09, 0x0E)]
IS_LETTER = np.ones(256, dtype=bool)
IS_LETTER[SPACES] = False

# One odd random number a byte; white space counts nothing, so it may stand behind a word.
LETTERS = np.random.default_rng(20).integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LETTERS[SPACES] = 0

# Longer words are hashed singly. A table of powers beyond so many entries is not kept.
LONG = 4096
KEPT_POWERS = 1 << 19

# Bytes or words whose hashes are computed at a time.
BLOCK = 1 << 18

SECOND = np.uint64(0xBF58476D1CE4E5B9)


class Powers:
    """Powers of an odd factor modulo 2 ** 64."""

    def __init__(self, factor: int):
        self.factor = np.uint64(factor)
        self.table = np.ones(1, dtype=np.uint64)

    def first(self, count: int) -> np.ndarray:
        if count > len(self.table):
            table = np.full(2 * count if 2 * count <= KEPT_POWERS else count, self.factor)
            table[0] = 1
            table = np.cumprod(table, dtype=np.uint64)
            if len(table) > KEPT_POWERS:
                return table
            self.table = table
        return self.table[:count]


IN_WORD = Powers(int(MULTIPLIER)).first(LONG)
FACTORS = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)
FORTH = [Powers(f) for f in FACTORS]
BACK = [Powers(pow(f, -1, 1 << 64)) for f in FACTORS]


def forget_powers() -> None:
    for powers in (*FORTH, *BACK):
        powers.table = np.ones(1, dtype=np.uint64)


MEMORIES.append(forget_powers)


def mixed(values: np.ndarray, factor: np.uint64 = MIX) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * factor
    return values ^ (values >> np.uint64(29))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text begins; nulls are empty."""
    texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(raw or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """``starts`` and ``ends`` of all words in the bytes; text ``t`` has the words from
    ``bounds[t]`` to ``bounds[t + 1]``."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = text_bytes(texts)
        size = len(self.data)
        letter = IS_LETTER[self.data]
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.offsets] = True
        begins, stops = letter.copy(), letter.copy()
        begins[1:] &= ~letter[:-1] | edge[1:size]
        stops[:-1] &= ~letter[1:] | edge[1:size]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        gaps = (self.starts[1:] - self.ends[:-1] != 1) | (self.data[self.ends[:-1]] != 0x20)
        self.odd = np.concatenate([[0], np.cumsum(gaps)])
        self.raw = self.data.tobytes()

    def join(self, first: int, end: int) -> bytes:
        """Words ``first`` to ``end`` of one text, joined by single spaces."""
        if first == end:
            return b""
        part = self.raw[self.starts[first] : self.ends[end - 1]]
        return part if self.odd[first] == self.odd[end - 1] else b" ".join(part.split())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, which depends on its bytes alone."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        lengths = self.ends - self.starts
        first = 0
        while first < len(out):
            base = self.starts[first]
            end = max(first + 1, int(np.searchsorted(self.starts, base + BLOCK)))
            own = self.starts[first:end] - base
            part = self.data[base : self.starts[end - 1] + min(LONG, lengths[end - 1])]
            place = np.arange(len(part), dtype=np.int32)
            place -= np.repeat(own.astype(np.int32), np.diff(own, append=len(part)))
            np.minimum(place, LONG - 1, out=place)
            out[first:end] = np.add.reduceat(LETTERS[part] * IN_WORD[place], own)
            first = end
        for word in np.flatnonzero(lengths > LONG):
            out[word] = xxhash.xxh3_64_intdigest(self.data[self.starts[word] : self.ends[word]].tobytes())
        return mixed(out)


def roll_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of a sequence of at least n word hashes."""
    rolled = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        rolled = rolled * MULTIPLIER + hashes[j : len(hashes) - n + 1 + j]
    return mixed(rolled)


def span_keys(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes, as signed numbers, of the words of every span.

    Spans come in order of start and of stop; they may overlap.
    """
    keys = np.empty((len(starts), 2), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        end = max(first + 1, int(np.searchsorted(starts, base + BLOCK)))
        part = hashes[base : stops[end - 1]]
        pairs = np.stack([starts[first:end] - base, stops[first:end] - base], axis=1)
        sizes = (pairs[:, 1] - pairs[:, 0]).astype(np.uint64)
        for k, values in enumerate((part, mixed(part, SECOND))):
            terms = np.append(values * FORTH[k].first(len(values)), np.uint64(0))
            sums = np.add.reduceat(terms, pairs.ravel())[::2]
            sums *= BACK[k].first(int(pairs[-1, 0]) + 1)[pairs[:, 0]]
            keys[first:end, k] = mixed(sums + sizes * MULTIPLIER)
        first = end
    return keys.view(np.int64)
