"""Small frames for the tests."""

from datetime import datetime, timezone

from farevalue.contracts import AWARD, GOLD
from farevalue.operators.quality import Run

RUN = Run("run-1", datetime(2026, 7, 1, tzinfo=timezone.utc))

FARE = {
    "flight_id": "f1",
    "origin_airport": "LAX",
    "destination_airport": "JFK",
    "airline": "Delta",
    "departure_datetime": "2026-07-01T09:40:00Z",
    "arrival_datetime": "2026-07-01T15:25:00Z",
    "cash_price": 287.0,
    "currency": "USD",
    "points_required": 28700,
    "cpp_cents_per_point": 1.0,
    "cabin_class": "economy",
    "program": "synthetic_generic",
    "award_type": "points",
    "ingestion_timestamp": "2026-07-01T00:00:00Z",
}


def gold(spark, *changes):
    """Gold rows: ``FARE`` with the given changes."""
    rows = [{**FARE, **change} for change in changes]
    return spark.createDataFrame([[row[c] for c in GOLD.columns] for row in rows], GOLD.schema)


def awards(spark, *changes):
    rows = [{**FARE, **change} for change in changes]
    return spark.createDataFrame([[row[c] for c in AWARD.columns] for row in rows], AWARD.schema)


def plan_of(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
