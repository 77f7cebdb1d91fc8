import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from farevalue.llm import packing
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")


def filled(plan):
    """The pieces of each sequence of a plan."""
    sequences = defaultdict(list)
    for length, first, end, start, each, offset in plan:
        for behind in range(end - first):
            sequences[start + behind // each].append((offset + behind % each * length, length))
    return sequences


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_gapless_and_places_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 4096])
    lengths = [min(capacity, int(rng.lognormvariate(3, 1.5)) + 1) for _ in range(rng.choice([0, 1, 40, 3000]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    sequences = filled(packing.make_plan(counts, capacity))
    placed = [n for pieces in sequences.values() for _, n in pieces]
    assert sorted(placed) == sorted(lengths)
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in pieces) <= 2
    # Few sequences: within a fifth of what the sum or the number of halves asks for.
    bound = max(-(-sum(lengths) // capacity), sum(2 * n > capacity for n in lengths))
    assert len(sequences) <= 1.2 * bound + 1


TEXTS = [
    "Word, WORD. word.. a.b, don't I'LL", "L'Été, ÜBER. ñ. ﬁ Å K", "H̱ É É İ ΣΑΣ", "<|endoftext|> x",
    "hello <|endoftext|> world", "<|ENDOFTEXT|> x<|startoftext|>Y. <|endoftext", "a\x1cb c\x85d e\xa0f　g\x0bh", "中文 テスト", " \n", "x" * 3000,
]


def test_word_ids_equal_the_tokenizer():
    plain = Tokenizer.from_file(FILE)
    words = packing.WordIds(FILE, size=6)
    for text, found in zip(TEXTS * 2, words.encode(TEXTS * 2), strict=True):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == expected


def test_special_strings_have_their_own_ids():
    (found,) = packing.WordIds(FILE).encode(["hello <|endoftext|> world"])
    assert np.frombuffer(found, "<u4").tolist() == [3306, 49407, 1002]


def test_pack_against_the_tokenizer(spark, documents):
    plain = Tokenizer.from_file(FILE)
    rows = [(n, t) for n, t in enumerate([*TEXTS, None, "", "word " * 700])] + [(None, "x"), (0, "x")]
    found = packing.pack(documents(rows), FILE, capacity=64).collect()
    texts = defaultdict(list)
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], dtype="<u4")
            texts[doc].append((piece, at, len(part), zlib.crc32(part.tobytes())))
    given = defaultdict(list)
    sequences = defaultdict(list)
    for r in found:
        given[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in given.items()} == {k: sorted(v) for k, v in texts.items()}
    for pieces in sequences.values():
        ends = np.cumsum([0, *(n for _, n in sorted(pieces))]).tolist()
        assert [o for o, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 64


def test_ranks_in_many_groups_are_gapless(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 7)
    pieces = spark.range(500).selectExpr("id AS doc_id", "0 AS piece", "1 + id % 3 AS length")
    found = packing.assign(pieces, 10).collect()
    places = {(r.sequence_id, r.offset) for r in found}
    assert len(places) == 500 and len({s for s, _ in places}) == 100


def test_empty_table(spark, documents):
    assert packing.pack(documents([]), FILE).count() == 0
