"""Conversation repair against a search over all edits, and parsing with all splits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from farevalue.llm import conversations
from farevalue.llm.queries import QUERIES

WELL_FORMED = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def begins_well(initials):
    """Whether a well-formed sequence begins like this."""
    return any(WELL_FORMED.fullmatch(initials + end) for end in ("", "a", "ua"))


def cheapest(rows):
    """(cost, audit, repaired rows) by a best-first search over whole edit sequences."""
    waiting = [(0, "", 0, "", ())]
    seen = set()
    while True:
        cost, audit, at, initials, kept = heapq.heappop(waiting)
        if at == len(rows) and WELL_FORMED.fullmatch(initials):
            return cost, audit, kept
        if (audit, initials) in seen:
            continue
        seen.add((audit, initials))
        steps = [(2, "I", at, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((3, "D", at + 1, None))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                steps.append((more, "K", at + 1, (role, text)))
                steps += [(2 + more, "R", at + 1, (r, text)) for r in ("user", "assistant")]
        for price, letter, to, row in steps:
            longer = initials if row is None else initials + (row[0][:1] or "?")
            if begins_well(longer):
                out = kept if row is None else (*kept, row)
                heapq.heappush(waiting, (cost + price, audit + letter, to, longer, out))


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows, search=cheapest):
    """One row per conversation, as the query returns it."""
    found = []
    for conv, turns in damaged(rows).items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, tagged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", None), 0)
        for _, role, text in turns:
            solid = text.rstrip(SPACE)
            fault = (
                "blank" if not solid
                else "duplicate" if (role, text) in seen
                else "truncated" if solid[-1] not in ".!?"
                else None
            )
            seen.add((role, text))
            counts[fault] += 1
            tagged.append((role, text, fault))
        given = [t for t, _, _ in turns if t is not None]
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        initials = [role[:1] for role, _, _ in tagged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = search(tagged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        faults = (counts["blank"], counts["duplicate"], counts["truncated"])
        found.append((conv, gaps, *faults, illegal, cost, audit, digest))
    return found


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)


LAYOUT = "conv_id long, turn long, role string, text string"


def repaired(spark, rows, layout=LAYOUT):
    return conversations.repair_damaged(spark.createDataFrame(rows, layout)).collect()


def test_query_equals_a_search_over_all_edits(spark, tables_folder):
    rows = spark.read.parquet(f"{tables_folder}/conversations.parquet").collect()
    found = QUERIES["op12_repair"](spark, tables_folder).collect()
    assert as_set(found) == as_set(plain([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in rows]))


def test_random_conversations(spark):
    chance = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", "u", None]
    texts = ["Yes.", "no", "", " \t", "Ok!  ", None, "Why?\n", "ä.", "Yes."]
    rows = [
        (conv, chance.choice([None, *range(5)]), chance.choice(roles), chance.choice(texts))
        for conv in range(300)
        for _ in range(chance.randint(1, 7))
    ]
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (-5, None, "assistant", "x.")]
    chance.shuffle(rows)
    assert as_set(repaired(spark, rows)) == as_set(plain(rows))


def all_splits(tags):
    """CYK with every split of every span."""
    n = len(tags)
    cells = {(i, i + 1): conversations.row_cells(*tag) for i, tag in enumerate(tags)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = {}
            for k in range(i + 1, i + length):
                for pair, cell in conversations.combine(cells[i, k], cells[k, i + length]).items():
                    best[pair] = min(best.get(pair, cell), cell)
            cells[i, i + length] = best
    return cells[0, n]


def test_one_split_finds_what_all_splits_find():
    chance = random.Random(4)
    for _ in range(60):
        tags = [(chance.choice("suat"), chance.randrange(4)) for _ in range(chance.randint(1, 12))]
        tags = [(c if c in "sua" else "", f) for c, f in tags]
        assert conversations.span_cells(tags) == all_splits(tags)


def test_a_conversation_of_a_third_of_all_rows(spark, settings):
    settings("spark.sql.shuffle.partitions", 4)
    rows = [(7, n, ("user", "assistant")[n % 2], f"Text {n}.") for n in range(60_000)]
    rows += [(n % 2000 + 100, n, "user", "Same.") for n in range(120_000)]
    found = {r["conv_id"]: r for r in repaired(spark, rows)}
    assert len(found) == 2001
    one = found[7]
    dropped = sum(zlib.crc32(f"7:{n}".encode()) % 20 == 0 for n in range(60_000))
    assert len(one["audit"].replace("I", "")) == 60_000 - dropped + one["duplicate"]
    prices = {"K": 0, "R": 2, "D": 3, "I": 2}
    assert one["cost"] >= sum(prices[c] for c in one["audit"])


def test_long_texts_and_spans(spark):
    rows = [(1, n, ("user", "assistant")[n % 2], f"{n} " + "x" * 400_000 + ".") for n in range(9)]
    rows += [(2, n, ("user", "assistant")[n % 3 % 2], f"Row {n}.") for n in range(200)]
    found = {r["conv_id"]: tuple(r) for r in repaired(spark, rows)}

    def all_at_once(tagged):
        number = {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}
        tags = [(role[:1] if role[:1] in "sua" else "", number[f]) for role, _, f in tagged]
        cells = conversations.span_cells(tags)
        cost, audit = min(cells[0, q] for q in (0, 3) if (0, q) in cells)
        return cost, audit, list(conversations.edited(audit, 0, [t[:2] for t in tagged]))

    assert [found[1], found[2]] == plain(rows, search=all_at_once)


@pytest.mark.parametrize("extra", [[], ["there", "fault", "seen", "audit", "a.b"]])
def test_empty_table_and_further_columns(spark, extra):
    empty = spark.createDataFrame([], LAYOUT)
    one = spark.createDataFrame([(1, 2, "user", "Hi.")], LAYOUT)
    for name in extra:
        one, empty = (df.selectExpr("*", f"'x' AS `{name}`") for df in (one, empty))
    assert conversations.repair_damaged(empty).collect() == []
    assert conversations.repair_damaged(one).first()["audit"] == "KI"


def test_a_conversation_whose_rows_all_drop_out(spark):
    conv = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    (row,) = repaired(spark, [(conv, 0, "user", "Gone.")])
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
