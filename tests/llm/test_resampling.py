"""Resampling against a plain version; documents of every awkward kind."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from farevalue.llm import resampling
from farevalue.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain(rows, target):
    """Rows as (doc_id, n_features, weight, score, rank), with the rank by a full sort."""
    s, t = Counter(), Counter()
    parts = [features(text) for _, text in rows]
    for _, runs in parts:
        s.update(runs)
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    found = []
    for (doc_id, _), (words, runs) in zip(rows, parts):
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
            for b in runs
        ]
        weight = sum(gains) // len(gains) if gains else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(runs), weight, score, words])
    able = [r for r in found if r[4] >= 20 and r[3] is not None]
    able.sort(key=lambda r: (-r[3], r[0]))
    ranks = {id(r): n + 1 for n, r in enumerate(able[: 25 * len(able) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in found]


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_the_plain_version(spark, tables_folder):
    docs = spark.read.parquet(f"{tables_folder}/documents.parquet").select("doc_id", "text").collect()
    target = [r["text"] for r in spark.read.parquet(f"{tables_folder}/benchmark.parquet").collect()]
    found = QUERIES["op11_resampling"](spark, tables_folder).collect()
    assert as_set(found) == as_set(plain([tuple(r) for r in docs], target))
    ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 10


def test_awkward_texts(spark, settings):
    settings("spark.sql.shuffle.partitions", 3)
    long = " ".join(f"Wort{n % 977}é" for n in range(300_000))
    rows = [(1, None), (2, ""), (3, " \t-!"), (4, long), (5, "ÄB c D\U0001f600 9z" * 30), (None, "a b " * 20)]
    rows += [(n, f"same words here {n % 3} " * 10) for n in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS weight", "2 AS score", "3 AS `rank`", "4 AS `a.b`")
    target = spark.createDataFrame([("same words",), (None,)], "text string")
    found = resampling.resample(docs, target, carry=("rank", "a.b", "text"))
    kept = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert as_set(kept) == as_set(plain(rows, ["same words", None]))
    carried = {r["doc_id"]: r["carried"] for r in found.collect()}
    assert carried[4]["text"] == long and carried[4]["rank"] == 3 and carried[2]["a.b"] == 4


def test_repeated_rows_are_drawn_in_the_wanted_number(spark):
    rows = [(1, "one two " * 20)] * 50 + [(2, "three four " * 20)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("one two",)], "text string")
    found = resampling.resample(docs, target).collect()
    assert len(found) == 100
    ranks = {r["rank"]: r["score"] for r in found if r["rank"] is not None}
    assert sorted(ranks) == list(range(1, 26))
    assert len(set(ranks.values())) == 1 and set(ranks.values()) == {max(r["score"] for r in found)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(empty, empty).collect() == []
    docs = spark.createDataFrame([(n, "a b c " * 9) for n in range(8)], "doc_id long, text string")
    assert sum(r["rank"] is not None for r in resampling.resample(docs, empty).collect()) == 2


@pytest.mark.parametrize("wanted", [1, 7, 40, 99, 100])
def test_bisection_finds_the_cutoff(spark, wanted):
    values = sorted([n * n * (-1) ** n for n in range(60)] + [5] * 40)
    rows = spark.createDataFrame([(v,) for v in values], "v long").cache()
    assert resampling.bisect(rows, "v", wanted) == values[wanted - 1]
