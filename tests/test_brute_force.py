"""Operators against plain Python over generated rows."""

import math
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from data import FARE, awards, gold
from farevalue.operators.publish import latest_per_key
from farevalue.operators.search import facet_terms, search
from farevalue.operators.valuation import FLIGHT_KEYS, find_hot, value_fares
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st

few = examples(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
texts = st.sampled_from(["a", "b", "c", None])
prices = st.one_of(
    st.none(), st.integers(1, 10**7).map(lambda n: n / 100), st.just(float("nan"))
)
row_changes = st.lists(
    st.fixed_dictionaries(
        {
            "flight_id": texts,
            "airline": texts,
            "cash_price": prices,
            "cpp_cents_per_point": prices,
            "points_required": st.sampled_from([None, 0, 7, 8000, 17600]),
            "ingestion_timestamp": st.sampled_from(["2026-07-01", "2026-07-02", None]),
        }
    ),
    min_size=1,
    max_size=25,
)


def plain(rows):
    """Rows as comparable tuples; NaN is made equal to itself."""
    return Counter(
        tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows
    )


@few
@given(row_changes, row_changes)
def test_join_and_cpp(spark, cash_changes, award_changes):
    expected = []
    for cash in cash_changes:
        for award in award_changes:
            keys = [({**FARE, **cash}[k], {**FARE, **award}[k]) for k in FLIGHT_KEYS]
            if all(left is not None and left == right for left, right in keys):
                expected.append((cash["cash_price"], award["points_required"]))

    def cpp(price, points):
        if price is None or points is None or points <= 0:
            return None
        ratio = price * 100 / points
        if math.isnan(ratio):
            return ratio
        return float(Decimal(repr(ratio)).quantize(Decimal("0.01"), ROUND_HALF_UP))

    cash, award = gold(spark, *cash_changes), awards(spark, *award_changes)
    columns = ("cash_price", "points_required", "cpp_cents_per_point")
    wanted = plain((price, points, cpp(price, points)) for price, points in expected)
    assert plain(value_fares(cash, award).select(*columns).collect()) == wanted
    assert plain(value_fares(cash, award, find_hot(cash, award, 1)).select(*columns).collect()) == wanted


@few
@given(row_changes)
def test_newest_row_per_id(spark, changes):
    kept = latest_per_key(gold(spark, *changes)).collect()
    ids = Counter(c["flight_id"] for c in changes)
    found = Counter(r["flight_id"] for r in kept)
    assert found == Counter({name: n if name is None else 1 for name, n in ids.items()})
    for row in kept:
        times = [c["ingestion_timestamp"] or "" for c in changes if c["flight_id"] == row["flight_id"]]
        assert row["flight_id"] is None or (row["ingestion_timestamp"] or "") == max(times)


@few
@given(row_changes, st.sampled_from(["cpp", "cash_price"]), st.sampled_from(["a", "All", None]))
def test_ranking(spark, changes, sort_by, airline):
    column = "cash_price" if sort_by == "cash_price" else "cpp_cents_per_point"
    wanted = [
        c[column] for c in changes if airline in (None, "All") or c["airline"] == airline
    ]
    given_values = [v for v in wanted if v is not None and not math.isnan(v)]
    ranked = sorted(given_values, reverse=sort_by == "cpp")
    found = [
        r[column]
        for r in search(gold(spark, *changes), airline=airline, sort_by=sort_by, size=10).collect()
    ]
    assert len(found) == min(10, len(wanted))
    shown = [v for v in found if v is not None and not math.isnan(v)]
    assert shown == ranked[:10] and found[: len(shown)] == shown


@few
@given(row_changes, st.integers(1, 3))
def test_facet_terms(spark, changes, size):
    counts = Counter(c["airline"] for c in changes if c["airline"] is not None)
    top = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:size]
    found = facet_terms(gold(spark, *changes), {"airlines": "airline"}, size).collect()
    assert [(r["value"], r["records"]) for r in found] == sorted(top)
