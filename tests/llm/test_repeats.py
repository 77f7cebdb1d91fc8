import random

import numpy as np
import pyarrow as pa
import pytest
from farevalue.llm import repeats
from farevalue.llm.common import WORD_RE
from pyspark.sql import functions as F


def plain_removed(rows, length):
    """Words to remove by document, from all windows in the order of the corpus."""
    seen, removed = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = WORD_RE.findall(text or "")
        gone = removed.setdefault(doc, set())
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            if window in seen:
                gone.update(range(at, at + length))
            seen.add(window)
    return removed


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(50)]
    passages = [rng.choices(vocabulary, k=rng.choice([19, 20, 21, 30, 90])) for _ in range(12)]
    texts = []
    for _ in range(80):
        words = rng.choices(vocabulary, k=rng.randrange(0, 80))
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    texts += [texts[3], texts[5], "", None, "a " * 19, "a " * 20, "a " * 200, "b a " * 60, " ".join(passages[0])]
    ids = rng.sample(range(-1000, 1000), len(texts))
    return list(zip(ids, texts, strict=True))


def check(found, rows, length=20):
    removed = plain_removed(rows, length)
    said = {r.doc_id: r for r in found}
    for doc, text in rows:
        words = WORD_RE.findall(text or "")
        kept = [w for i, w in enumerate(words) if i not in removed[doc]]
        got = said[doc]
        assert (got.n_words, got.n_removed, got.kept) == (len(words), len(removed[doc]), " ".join(kept))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot", [3, 20_000])
def test_against_all_windows(spark, documents, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = corpus(seed)
    found = repeats.remove_repeats(documents(rows).repartition(4)).collect()
    assert len(found) == len(rows)
    check(found, rows)


@pytest.mark.parametrize("length", [3, 6, 50])
def test_other_lengths(spark, documents, length):
    rows = corpus(length)
    check(repeats.remove_repeats(documents(rows), length).collect(), rows, length)


def test_rows_without_id_and_rows_that_share_one(spark, documents):
    passage = " ".join(f"p{n}" for n in range(40))
    rows = [(None, passage), (7, passage), (7, passage), (9, f"x {passage} y")]
    found = repeats.remove_repeats(documents(rows), carry=("n_chars", "a.b")).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.n_chars, r["a.b"]) for r in found) == [
        ("7", 0, 9, 7), ("7", 0, 9, 7), ("9", 40, 9, 7), ("None", 0, 9, 7),
    ]


def test_layout_is_kept_around_what_is_cut(spark, documents):
    passage = " ".join(f"p{n}" for n in range(20))
    rows = [(1, f" a\n{passage}\tb"), (2, f"c\n\n{passage}\n\nd  e "), (3, "  as it  was\n")]
    found = {r.doc_id: r.kept for r in repeats.remove_repeats(documents(rows), layout=True).collect()}
    assert found == {1: rows[0][1], 2: "c\n\nd  e ", 3: "  as it  was\n"}


def test_empty_table(spark, documents):
    assert repeats.remove_repeats(documents([])).count() == 0


def test_automaton_statistics_and_size():
    rng = random.Random(12)
    for _ in range(150):
        automaton, known, total = repeats.Automaton(), set(), 0
        for _ in range(rng.randrange(1, 5)):
            words = rng.choices("abc", k=rng.randrange(1, 20))
            longest = [
                max((n for n in range(1, e + 2) if tuple(words[e + 1 - n : e + 1]) in known), default=0)
                for e in range(len(words))
            ]
            assert automaton.statistics(words) == longest
            automaton.add(words)
            total += len(words)
            known |= {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
        assert len(automaton.paths) <= 2 * total + 1


def test_covered_spans_are_maximal():
    assert repeats.covered([0, 1, 2, 3, 4, 1, 2, 3], 3) == [(1, 8)]
    assert repeats.covered([1, 2, 3, 0, 0, 1, 2, 3], 3) == [(0, 3), (5, 8)]
    assert repeats.covered([], 3) == []


def test_lowest_of_a_window_is_the_leftmost(monkeypatch):
    rng = np.random.default_rng(13)
    for width in (1, 2, 3, 15, 16):
        values = rng.integers(0, 4, 60).astype(np.uint64) << np.uint64(40)
        expected = [i + int(np.argmin(values[i : i + width])) for i in range(60 - width + 1)]
        assert repeats.leftmost_lowest(values, width).tolist() == expected
        with monkeypatch.context() as patch:
            patch.setattr(repeats, "POSITION_BITS", 5)
            assert repeats.leftmost_lowest(values, width).tolist() == expected


def test_a_common_line_in_differing_text_is_found_and_spread(spark, documents, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 50)
    line = " ".join(f"l{n}" for n in range(22))
    rows = [(n, f"{' '.join(f'a{n}x{k}' for k in range(25))} {line} {' '.join(f'b{n}x{k}' for k in range(25))}") for n in range(300)]
    check(repeats.remove_repeats(documents(rows).repartition(5)).collect(), rows)


def test_no_task_gets_all_places_of_one_window(spark, monkeypatch):
    line = " ".join(f"l{n}" for n in range(20))
    runs = spark.range(3000).select(F.lit(5).cast("long").alias("anchor"), F.col("id").alias("doc_id"), F.lit(3).cast("long").alias("at"), F.lit(line).alias("words"))
    hot = spark.sql("SELECT 5L AS anchor, true AS hot")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        tasks = repeats.dealt(repeats.cut_hot(runs, hot, 20)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(t["count"] for t in tasks) == 3000
    assert max(t["count"] for t in tasks) < 2 * 3000 / 8
    spans = repeats.shard_spans(repeats.cut_hot(runs, hot, 20), 20).collect()
    assert sorted(map(tuple, spans)) == [(n, 3, 23) for n in range(1, 3000)]


def test_first_places_over_batches():
    rng = random.Random(14)
    rows = sorted(tuple(rng.randrange(-2, 2) for _ in range(4)) for _ in range(400))
    first, expected = {}, []
    for one, two, *place in rows:
        begins = (one, two) not in first
        expected.append(0 if begins else 2 if first[one, two] == place else 1)
        first.setdefault((one, two), place)
    for size in (1, 7, 400):
        places, got = repeats.FirstPlaces(), []
        for at in range(0, 400, size):
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows[at : at + size])]
            got += places.split(pa.record_batch(columns, names=["one", "two", "doc_id", "at"])).tolist()
        assert got == expected
