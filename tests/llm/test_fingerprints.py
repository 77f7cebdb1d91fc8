import hashlib
import random

import pyarrow as pa
import pytest
from farevalue.llm import fingerprints as f
from farevalue.llm import queries


def test_equal_texts_and_bounds():
    rng = random.Random(2)
    texts = [b"", b"a", b"ab", b"abc", b"x" * 10_000] + [
        bytes(rng.choices(b"abcdefgh ", k=rng.randrange(1, 3000))) for _ in range(40)
    ]
    for one in texts:
        assert f.likeness(f.digest(one), f.digest(one)) == 1.0
        for other in texts:
            near = f.likeness(f.digest(one), f.digest(other))
            assert 0 <= near <= 1 and near == f.likeness(f.digest(other), f.digest(one))


def test_counts_quartiles_by_hand():
    data = bytes(range(256)) * 3
    counts = [0] * f.BUCKETS
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a << 16 | b << 8 | c) * int(f.MULTIPLIER) % 2**32) >> 25] += 1
    low, middle, high = (sorted(counts)[i] for i in (31, 63, 95))
    codes = [(c > low) + (c > middle) + (c > high) for c in counts]
    assert f.unpack(f.digest(data))[2].tolist() == codes


def test_small_edits_stay_near():
    rng = random.Random(3)
    words = [bytes(rng.choices(b"etaoinshr", k=rng.randrange(2, 8))) for _ in range(300)]
    text = rng.choices(words, k=800)
    edited = list(text)
    edited[100] = b"changed"
    other = [bytes(rng.choices(b"0123456789", k=5)) for _ in range(800)]
    near = f.likeness(f.digest(b" ".join(text)), f.digest(b" ".join(edited)))
    assert near > 0.9 > 0.5 > f.likeness(f.digest(b" ".join(text)), f.digest(b" ".join(other)))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("after", pa.string())])


@pytest.mark.parametrize("ranges", ["1", "4", "30"])
def test_every_row_meets_the_next(spark, documents, settings, ranges):
    settings("spark.sql.shuffle.partitions", ranges)
    rng = random.Random(4)
    rows = [(n, f"t{n}") for n in rng.sample(range(-10_000, 10_000), 40)]
    rows += [(None, "null id"), (20_000, None), (rows[0][0], "same id"), (2**62, "far")]
    found = f.map_with_next(
        documents(rows).repartition(5), lambda i, a, b: (i, a, b), "doc_id long, text string, after string", SCHEMA
    ).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    following = [t for _, t in ordered[1:] + ordered[:1]]
    expected = [(i, t, n) for (i, t), n in zip(ordered, following, strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_one_row_and_none(spark, documents):
    schema = "doc_id long, text string, after string"
    one = f.map_with_next(documents([(1, "a")]), lambda i, a, b: (i, a, b), schema, SCHEMA)
    assert [tuple(r) for r in one.collect()] == [(1, "a", "a")]
    assert f.map_with_next(documents([]), lambda i, a, b: (i, a, b), schema, SCHEMA).count() == 0
    assert f.fingerprint(documents([])).count() == 0


def test_fingerprint_table(spark, documents):
    found = {r.doc_id: r.fingerprint for r in f.fingerprint(documents([(1, None), (2, "abc é")])).collect()}
    assert found == {1: f.digest(b""), 2: f.digest("abc é".encode())}


def plain_query(rows):
    """The rows of op4, one after the other, as the contract words them."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        own, changed, following = map(f.digest, (text.encode(), edited, after.encode()))
        yield (
            i, len(text), hashlib.sha256(edited).hexdigest(), own, changed,
            f.likeness(own, changed), f.likeness(own, following),
        )


@pytest.mark.parametrize("case", ["many", "one", "none"])
def test_query_against_plain_rows(spark, documents, tmp_path, case):
    rng = random.Random(7)
    words = ["plain", "w\u00f6rter", "\U0001f600\U00010348", "\u6f22\u5b57", "e\u0301"]
    rows = [(n, " ".join(rng.choices(words, k=rng.randrange(0, 400)))) for n in rng.sample(range(-99, 999), 60)]
    rows += [(None, "no id"), (None, None), (2000, None), (2001, ""), (2002, "\U0001f600"), (2003, "ab"), rows[0]]
    rows += [(rows[1][0], "another text of this id"), (3000, "long " * 60_000), (3001, "long " * 60_000)]
    rows = {"many": rows, "one": [(5, "only one \U0001f600 text")], "none": []}[case]
    documents(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.quartile_fingerprints(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_query(rows), key=repr)
