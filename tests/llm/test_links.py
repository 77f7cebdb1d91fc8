"""Connected components and the near-duplicate operators, against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from farevalue.llm import embeddings, jaccard
from farevalue.llm.common import UPPER, WORD_RE, groups, slices
from farevalue.llm.components import Forest, connected_components


def plain_components(nodes, links):
    forest = Forest()
    for n in nodes:
        forest.find(n)
    for a, b in links:
        forest.join(a, b)
    return {n: forest.find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(9)
    links = {
        "chain": [(n, n + 1) for n in range(60)],
        "star": [(50, n) for n in range(100) if n != 50],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    rng.shuffle(links)
    given = links + [(None, 1), (2, None), (7, 7)]
    table = spark.createDataFrame(given, "from long, to long").repartition(5)
    found = {r.node: r.component_id for r in connected_components(table).collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert found == plain_components(nodes, links)


def test_slices_and_groups_keep_all_rows():
    batch = pa.record_batch([pa.array([1, 1, 2, 2, 2, 3]), pa.array(["aa", None, "", "bbbb", "c", "d"])], names=["k", "t"])
    for size in (1, 3, 100):
        parts = list(slices([batch, batch.slice(0, 0)], "t", size=size))
        assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
        assert [g.num_rows for g in groups(parts, 1)] == [2, 3, 1]


# Documents


def shingles(text, n):
    lower = str.maketrans(UPPER, UPPER.lower())
    words = WORD_RE.findall((text or "").translate(lower))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def near_texts(seed, size):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)]
    bases = [rng.choices(vocabulary, k=rng.choice([3, 12, 40, 150])) for _ in range(max(1, size // 8))]
    texts = []
    for _ in range(size):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    texts += ["", None, " \t", "one", "ONE", "one two", "x " * 400, "x " * 500, "A b C", "a B c"]
    return texts


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates_against_all_pairs(spark, documents, monkeypatch, n, percent):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 10)
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", 6)
    texts = near_texts(n, 120)
    ids = random.Random(n).sample(range(-500, 500), len(texts))
    rows = list(zip(ids, texts, strict=True))
    sets = {i: shingles(t, n) for i, t in rows}
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    parts = plain_components(ids, links)
    docs = documents([*rows, (None, texts[0]), (ids[0], texts[0])])
    found = jaccard.near_duplicates(docs, n, percent).collect()
    assert len(found) == len(rows) + 2
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), parts[r.doc_id])
    kept = jaccard.keep_one(docs, n, percent)
    assert kept.columns == docs.columns
    expected = [i for i in ids if parts[i] == i] + [None] + [ids[0]] * (parts[ids[0]] == ids[0])
    assert sorted(map(str, expected)) == sorted(str(r.doc_id) for r in kept.collect())


def test_empty_documents_table(spark, documents):
    assert jaccard.near_duplicates(documents([])).count() == 0
    assert jaccard.keep_one(documents([])).count() == 0


def test_divide_skip_against_all_pairs():
    rng = random.Random(10)
    for _ in range(60):
        base = rng.sample(range(10**6), rng.choice([1, 6, 40, 120]))
        sets = []
        for _ in range(rng.choice([2, 30])):
            own = set(base)
            for _ in range(rng.randrange(8)):
                own.discard(rng.choice(base))
                own.add(rng.randrange(10**6))
            sets.append(sorted(own))
        rows = range(len(sets))
        for percent in (70, 90):
            links = [
                (a, b) for a in rows for b in range(a)
                if 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})
            ]
            index = jaccard.Index(sets, list(rows), percent)
            for a in rows:
                assert sorted(index.search(a)) == sorted({b for p in links if a in p for b in p} | {a})
            given = plain_components(rows, jaccard.link_group(sets, percent))
            assert given == plain_components(rows, links)


# Embeddings


def vectors(seed, size, dimension=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((size // 10, dimension))
    rows = centres[rng.integers(len(centres), size=size)] + 0.18 * rng.standard_normal((size, dimension))
    rows[:20] = rows[20:40] * 3.5  # equal directions
    rows[40:60] = rows[41]  # equal vectors
    return rows.astype(np.float32)


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 15)
    matrix = vectors(11, 300)
    rows = [(n * 7 - 100, v.tolist(), n % 3) for n, v in enumerate(matrix)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(10_000 + n, v, 0) for n, v in enumerate(odd)] + [(None, matrix[0].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, `key` int")
    found = embeddings.deduplicate(table).collect()
    assert len(found) == len(rows)
    unit = matrix.astype(float) / np.linalg.norm(matrix.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    ids = [r[0] for r in rows[:300]]
    parts = plain_components(ids, [(ids[a], ids[b]) for a, b in np.argwhere(linked)])
    said = {r.vec_id: r for r in found}
    degree = dict(zip(ids, linked.sum(axis=1), strict=True))
    assert all(said[i].n_links <= degree[i] for i in ids)  # none below the least cosine
    assert sum(said[i].n_links for i in ids) >= 0.98 * sum(degree.values())
    assert np.mean([said[i].component_id == parts[i] for i in ids]) > 0.98
    for r in rows[300:-1]:
        assert (said[r[0]].n_links, said[r[0]].component_id, said[r[0]].kept) == (0, r[0], True)
    assert said[None].n_links == 0 and said[None].kept
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_each_pair_counts_once(spark):
    vectors = [(n, [1.0, 0.001 * n], 0) for n in range(30)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, x int")
    assert {r.n_links for r in embeddings.deduplicate(table).collect()} == {29}


def test_empty_embeddings(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, x int")
    assert embeddings.deduplicate(table).count() == 0


def test_a_bucket_of_near_copies_takes_bounded_memory():
    rng = np.random.default_rng(31)
    raw = rng.standard_normal(64) + 0.01 * rng.standard_normal((4000, 64))
    raw[3000:] *= -1  # a second set
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    ids = rng.permutation(4000).astype(np.int64) * 3
    codes = rng.integers(0, 1 << 30, (4000, 24)).astype(np.int32)
    codes[:2, 5] = 7  # this pair has met before
    same = pa.array(np.zeros(4000, dtype=np.int32))
    group = pa.table({
        "lane": pa.array(np.full(4000, 23, dtype=np.int32)), "vec_id": ids,
        "size": np.ones(4000, dtype=np.int64), "own": same, "left": same, "right": same,
        "unit": [u.tobytes() for u in unit], "codes": [c.tobytes() for c in codes],
    })
    tracemalloc.start()
    found, links, roots = embeddings.compare_bucket(group, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000
    assert (found == ids).all()
    expected = np.where(np.arange(4000) < 3000, 2999, 999)
    expected[:2] -= 1
    assert (links == expected).all()
    assert set(roots[:3000]) == {ids[:3000].min()} and set(roots[3000:]) == {ids[3000:].min()}


def planted(rng, pairs, dimension, cosine):
    """Pairs of unit vectors with just this cosine, one below the other."""
    a = rng.standard_normal((pairs, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((pairs, dimension))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return np.stack([a, cosine * a + np.sqrt(1 - cosine**2) * b], axis=1).reshape(-1, dimension)


def test_recall_of_planted_links_in_64_dimensions(spark):
    rng = np.random.default_rng(64)
    matrix = np.concatenate([planted(rng, 1500, 64, 0.9001), planted(rng, 300, 64, 0.89), rng.standard_normal((400, 64))])
    rows = [(n, v.tolist(), 0) for n, v in enumerate(matrix)]
    found = embeddings.deduplicate(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int")).collect()
    links = np.zeros(len(rows), dtype=int)
    for r in found:
        links[r.vec_id] = r.n_links
        assert r.component_id == r.vec_id - (r.vec_id % 2 if r.n_links else 0)
    assert 0.96 <= links[:3000].mean() <= 1
    assert not links[3000:].any()


def test_sketches_drop_no_pair_that_links():
    rng = np.random.default_rng(12)
    least = 0.9
    units = planted(rng, 3000, 64, least)
    codes = embeddings.codes_of(units, 24, 12)
    apart = np.bitwise_count(codes[::2] ^ codes[1::2]).sum(axis=1)
    assert apart.max() <= embeddings.most_apart(288, least)
    assert np.bitwise_count(codes[::2, :12] ^ codes[1::2, :12]).sum(axis=1).max() <= embeddings.most_apart(144, least)
    assert embeddings.most_apart(288, 1.0) == 0
    assert embeddings.most_apart(288, 0.9) < 80 < embeddings.most_apart(288, 0.5)


@pytest.mark.parametrize("blocks", [(0, 0), (0, 1)])
@pytest.mark.parametrize(("tables", "bits", "lane", "first"), [(24, 12, 0, 12), (24, 12, 9, 12), (5, 17, 2, 4)])
def test_members_that_may_link_against_all_pairs(monkeypatch, blocks, tables, bits, lane, first):
    monkeypatch.setattr(embeddings, "PAIRS", 700)
    rng = np.random.default_rng(tables + lane)
    centres = rng.standard_normal((30, 16))
    units = np.repeat(centres, 5, axis=0) + rng.uniform(0.2, 2, (150, 1)) * rng.standard_normal((150, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes = embeddings.codes_of(units, tables, bits)
    own = rng.integers(2, size=150).astype(np.int32) * blocks[1]
    group = pa.table({
        "lane": np.full(150, lane, dtype=np.int32), "left": np.full(150, blocks[0], dtype=np.int32),
        "right": np.full(150, blocks[1], dtype=np.int32), "own": own,
        "sketch": pa.array(embeddings.sketches_of(codes, bits), pa.binary()),
    })
    expected = np.zeros(150, dtype=bool)
    for a in range(150):
        for b in range(a):
            if blocks[1] and own[a] == own[b] or lane and (codes[a, :lane] == codes[b, :lane]).any():
                continue
            differ = np.bitwise_count(codes[a] ^ codes[b])
            if differ[:first].sum() <= embeddings.most_apart(bits * first, 0.9) and differ.sum() <= embeddings.most_apart(bits * tables, 0.9):
                expected[[a, b]] = True
    assert expected.any()
    assert tables < 24 or not expected.all()
    assert (embeddings.may_link(group, tables, bits, 0.9) == expected).all()


def test_one_id_with_different_vectors(spark):
    rng = np.random.default_rng(5)
    one, two = planted(rng, 2, 8, 0.999).reshape(2, 2, 8)
    rows = [(5, one[0]), (5, two[0]), (5, np.ones(3)), (7, one[1]), (9, two[1]), (11, -one[0])]
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], "vec_id long, embedding array<double>, x int")
    said = [(r.vec_id, r.component_id) for r in embeddings.deduplicate(table).collect()]
    assert sorted(said) == [(5, 5), (5, 5), (5, 5), (7, 5), (9, 5), (11, 11)]
    links = {r.vec_id: r.n_links for r in embeddings.deduplicate(table).collect()}
    assert links[7] == links[9] == 1 and links[11] == 0
