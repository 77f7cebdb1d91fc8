"""Column builders for prices and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def cents(amount: Column) -> Column:
    return amount * 100


def cents_per_point(amount: Column, points: Column) -> Column:
    """Cents of fare per point, two digits, half up; null unless points are positive."""
    return F.when(points > 0, F.round(cents(amount) / points, 2))


def whole_points(base: float, *multipliers: Column) -> Column:
    """``base`` times every multiplier, rounded half to even."""
    points = F.lit(base)
    for multiplier in multipliers:
        points = points * multiplier
    return F.rint(points).cast("bigint")
