import random

import pytest
from farevalue.llm import licenses

FILLER = ["Licensed", "under", "the", "MIT", "cc", "by", "nc", "apache", "license,", "version", "2", "é", "-", "X1", "\n"]


def plain_places(text):
    words = licenses.words_of(text)
    places = []
    for label, phrase, exact in licenses.default_notices():
        wanted = licenses.words_of(phrase)
        if exact:
            places += [
                (label, i) for i in range(len(words)) if words[i : i + len(wanted)] == wanted
            ]
    return sorted(places)


def test_words():
    assert licenses.words_of("CC-BY_nc 4.0 ÉÀ1\x7fß") == ["cc", "by", "nc", "4", "0", "ÉÀ1", "ß"]


def test_places_and_counts_against_a_plain_search(spark, documents):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(FILLER, k=rng.randrange(0, 60))) for _ in range(120)]
    texts += [None, "", "CC BY-NC", "x " * 3000 + "under the MIT license " * 400]
    rows = list(enumerate(texts))
    counted, findings = licenses.scan(documents(rows))
    assert {r.doc_id: r.n_words for r in counted.collect()} == {
        n: len(licenses.words_of(t or "")) for n, t in rows
    }
    found = {}
    for r in findings.filter("exact").collect():
        found.setdefault(r.doc_id, []).append((r.label, r["at"]))
    for n, text in rows:
        assert sorted(found.get(n, [])) == plain_places(text or ""), n


def test_notices_with_changed_words(spark, documents):
    _, notice, _ = next(n for n in licenses.default_notices() if n[0] == "isc")
    words = notice.split()
    edited = words[:10] + ["inserted", "words"] + words[10:20] + words[21:]
    rows = [
        (1, "before " * 50 + " ".join(edited) + " after" * 50),
        (2, " ".join(words[:6])),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (None, notice),
    ]
    _, findings = licenses.scan(documents(rows))
    found = {(r.doc_id, r.label): r.score for r in findings.collect()}
    assert 0.9 < found[(1, "isc")] < 1.0
    assert found[(3, "gpl")] == 1.0
    assert {k for k in found if k[0] in (2, None)} == set()


@pytest.mark.parametrize("label", ["isc", "mit", "apache-2"])
def test_insertions_keep_the_label_and_shuffling_loses_it(spark, documents, label):
    notices = [t for n, t, exact in licenses.default_notices() if n == label and not exact]
    words = max(notices, key=len).split()
    half = len(words) // 2
    rng = random.Random(21)
    rows = [(0, " ".join(rng.sample(words, len(words))))]
    for number, count in enumerate((0, 2, 5, 8, 12), start=1):
        added = [f"other{k}" for k in range(count)]
        rows.append((number, " ".join(["x"] * 30 + words[:half] + added + words[half:] + ["y"] * 30)))
    rows.append((6, " ".join([*words[: half - 3], *words[half + 1 :], *words[:half], "z", "z", *words[half:]])))
    longest = [(n, t, e) for n, t, e in licenses.default_notices() if t in (max(notices, key=len),)]
    _, findings = licenses.scan(documents(rows), longest)
    found = {r.doc_id for r in findings.collect() if r.label == label}
    assert found == {1, 2, 3, 4, 5, 6}


def test_rows_that_repeat_or_share_an_id(spark, documents):
    one = "x under the MIT license"
    rows = [(1, one), (1, one), (2, one), (2, "y z " + one), (2, None), (3, one + " " + one)]
    counted, findings = licenses.scan(documents(rows))
    places = {}
    for r in findings.filter("exact").collect():
        places.setdefault((r.doc_id, r.key), []).append(r["at"])
    got = sorted((r.doc_id, r.n_words, sorted(places.get((r.doc_id, r.key), []))) for r in counted.collect())
    assert got == [(1, 5, [1]), (1, 5, [1]), (2, 0, []), (2, 5, [1]), (2, 7, [3]), (3, 10, [1, 6])]


def test_longest_common_subsequence():
    rng = random.Random(22)
    for _ in range(100):
        one, two = (rng.choices("abcd", k=rng.randrange(1, 25)) for _ in range(2))
        row = [0] * (len(two) + 1)
        for a in one:
            before = row[:]
            for n, b in enumerate(two, start=1):
                row[n] = before[n - 1] + 1 if a == b else max(before[n], row[n - 1])
        assert licenses.common_in_order(one, two) == row[-1]


def test_empty_table_and_short_template(spark, documents):
    counted, findings = licenses.scan(documents([]))
    assert counted.count() == 0 and findings.count() == 0
    with pytest.raises(ValueError, match="fewer"):
        licenses.scan(documents([]), notices=[("x", "two words", False)])
