import random

import numpy as np
import pyarrow as pa
from farevalue.llm import repeats, wordspans
from farevalue.llm.wordspans import Words, span_keys

LONG = "x" * 5000


def texts(seed, count=60):
    rng = random.Random(seed)
    pool = ["a", "b", "ab", "é", "漢字", LONG, "𝄞", "a b", "\x00"]
    spaces = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c "]
    made = []
    for _ in range(count):
        words = rng.choices(pool, k=rng.randrange(0, 30))
        made.append(rng.choice(["", " "]) + "".join(w + rng.choice(spaces) for w in words).strip() + rng.choice(["", "\n"]))
    return [*made, None, "", " \n ", "end"]


def plain(text):
    return (text or "").encode().split()


def test_words_of_every_text_of_a_slice():
    rows = texts(1)
    for first, count in ((0, len(rows)), (7, 20), (len(rows) - 2, 2), (len(rows) - 3, 1)):
        words = Words(pa.array(rows).slice(first, count))
        for n, text in enumerate(rows[first : first + count]):
            start, end = words.bounds[n : n + 2]
            assert [words.raw[a:b] for a, b in zip(words.starts[start:end], words.ends[start:end])] == plain(text)
            assert words.join(start, end) == b" ".join(plain(text))


def test_hash_depends_on_the_word_alone(monkeypatch):
    rows = texts(2)
    flat = [w for t in rows for w in plain(t)]
    first = Words(pa.array(rows, pa.large_string())).hashes()
    monkeypatch.setattr(wordspans, "BLOCK", 64)
    assert (first == Words(pa.array(rows)).hashes()).all()
    assert len(set(zip(flat, first.tolist()))) == len(set(flat)) == len(set(first.tolist()))
    many = [f"{a}{b}" for a in "abcdefgh012" for b in range(3000)]
    assert len(set(Words(pa.array(many)).hashes().tolist())) == len(many)


def test_span_keys_depend_on_the_words_alone(monkeypatch):
    rng = random.Random(3)
    hashes = np.random.default_rng(3).integers(0, 1 << 60, 7).astype(np.uint64)[rng.choices(range(7), k=400)]
    starts = np.array(sorted(rng.sample(range(380), 200)))
    stops = starts + 20
    keys = list(map(tuple, span_keys(hashes, starts, stops).tolist()))
    monkeypatch.setattr(wordspans, "BLOCK", 16)
    monkeypatch.setattr(wordspans, "KEPT_POWERS", 4)
    assert keys == list(map(tuple, span_keys(hashes, starts, stops).tolist()))
    spans = [tuple(hashes[a:b].tolist()) for a, b in zip(starts, stops)]
    assert len(set(zip(spans, keys))) == len(set(spans)) == len(set(keys))
    one = span_keys(np.tile(hashes[:20], 2), np.array([0, 20]), np.array([20, 40]))
    assert (one[0] == one[1]).all()
    lengths = span_keys(np.repeat(hashes[:1], 30), np.array([0, 1]), np.array([10, 12]))
    assert (lengths[0] != lengths[1]).all()


def test_runs_stay_in_their_text_and_match_alone():
    rows = [t for t in texts(4, 40)] + ["a b c d e f g h i j k l m n o p q r s t u v w x y z"]
    together = repeats.Runs(Words(pa.array(rows)), 5)
    for n, text in enumerate(rows):
        alone = repeats.Runs(Words(pa.array([text], pa.string())), 5)
        own = together.texts == n
        for name in ("anchors", "at"):
            assert getattr(together, name)[own].tolist() == getattr(alone, name).tolist()
        assert together.keys[together.texts[together.begins[:-1]] == n].tolist() == alone.keys.tolist()
